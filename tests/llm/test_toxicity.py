import random

from pyspark.sql import functions as F

from tickflow.llm.queries_free import op4
from tickflow.llm.toxicity import ToxicSpec, hits, score_toxicity, segments, train


def maximal(scores):
    """By definition: of all segments, the best (shortest, first) one, then so on its sides."""
    best = max(
        ((sum(scores[a:b]), a - b, -a) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)),
        default=(0, 0, 0),
    )
    if best[0] <= 1e-12:
        return []
    a = -best[2]
    b = a - best[1]
    left, right = maximal(scores[:a]), maximal(scores[b:])
    return [*left, (a, b), *((x + b, y + b) for x, y in right)]


def test_segments_are_the_maximal_ones():
    rng = random.Random(2)
    table = {"bad": 3.0, "worse": 5.0, "odd": 1.0, "good": -2.0}
    for _ in range(300):
        words = rng.choices([*table, "the"], weights=[1, 1, 2, 3, 4], k=rng.randint(0, 25))
        got = segments(hits(words, table), 0.37)
        scores = [table.get(w, 0.0) - 0.37 for w in words]
        assert [(a, b) for a, b, _ in got] == maximal(scores)
        assert all(abs(s - sum(scores[a:b])) < 1e-9 for a, b, s in got)


def made_up(spark, n=600):
    rng = random.Random(4)
    plain = [f"word{i}" for i in range(300)]
    rows = []
    for i in range(n):
        words = rng.choices(plain, k=rng.randint(30, 200))
        toxic = i % 5 == 0
        if toxic:
            at = rng.randrange(len(words) - 10)
            for k in range(at, at + 6, 2):
                words[k] = rng.choice(["vile", "scumbag", "hateful"])
        rows.append((i, " ".join(words), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_made_up_passages(spark, edge, empty):
    docs = made_up(spark)
    model = train(docs.filter("doc_id < 400"))
    found = score_toxicity(docs.filter("doc_id >= 400"), model).join(docs, "doc_id").collect()
    assert all((r.score >= 0.3) == bool(r.toxic) for r in found)
    assert all(bool(r.passages) == bool(r.toxic) for r in found)
    for r in found:
        for p in r.passages:
            words = r.text.split()[p.first : p.end]
            assert words[0] in ("vile", "scumbag", "hateful") and len(words) <= 6
    scores = [r.score for r in score_toxicity(edge, model).collect()]
    assert len(scores) == edge.count() and max(scores) < 0.3
    assert score_toxicity(empty, model).count() == 0


def test_a_model_too_large_to_broadcast_scores_alike(spark, edge, empty):
    docs = made_up(spark).withColumnRenamed("toxic", "label").withColumn("toxic", F.col("label"))
    learned = docs.filter("doc_id < 400").select("text", "toxic")
    small, large = train(learned), train(learned, ToxicSpec(broadcast_words=3))
    assert large.scores is None and large.table.count() == len(small.scores) > 3
    for df in (docs, edge, empty):
        one, two = (score_toxicity(df, m).collect() for m in (small, large))
        key = lambda r: (str(r.doc_id), r.n_words, round(r.score, 9), [tuple(p) for p in r.passages])
        assert sorted(map(key, one), key=str) == sorted(map(key, two), key=str) and len(one) == df.count()


def test_every_significant_word_is_in_the_model(spark):
    """More of them than any round bound: 30,000 words that are only in toxic texts."""
    words = ["".join(chr(97 + i // 26**k % 26) for k in range(4)) for i in range(30_000)]
    rows = [(" ".join(words), 1), (" ".join(f"q{w}" for w in words), 0)] * 60
    model = train(spark.createDataFrame(rows, "text string, toxic int"))
    assert model.scores.keys() >= set(words)


def test_nothing_to_learn_from(spark, empty, edge):
    for rows in ([], [("only clean", 0)], [("only toxic", 1)]):
        model = train(spark.createDataFrame(rows, "text string, toxic int"))
        assert all(0 <= r.score <= 1 for r in score_toxicity(edge, model).collect())


def test_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = op4(spark, sf_dir).filter("held_out").join(labels, "doc_id")
    n = scored.groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in n}
    assert n[1, 1] / (n[1, 1] + n[1, 0]) > 0.8
    assert n[1, 1] / (n[1, 1] + n[0, 1]) > 0.9
    assert scored.filter(F.col("score").isNull()).count() == 0
