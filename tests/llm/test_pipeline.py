from collections import defaultdict

import __spark_entry__
from pyspark.sql import functions as F
from test_near_dedup import expected as near_groups

import corpus_pipeline
from tickflow.llm.mixing import mix_sources
from tickflow.llm.pieces import decode_pieces
from tickflow.llm.quality import quality_rules
from tickflow.llm.queries_free import PIECE_MODEL
from tickflow.session import materialize

SF = "/root/testdata/sf0.001"


def test_registered():
    assert {"pipeline", *(f"op{n}" for n in range(1, 14))} <= {
        name.split("_")[0] for name in __spark_entry__.queries()
    }
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        *("quality", "exact_dedup", "near_dedup", "mix", "sentencepiece")
    ]


def test_each_stage_on_its_own_input(spark, documents):
    docs, inputs = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = docs
        docs = materialize(stage(spark, docs, SF), name)
        if name != "sentencepiece":
            assert docs.columns == documents.columns
    pairs = {
        name: [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        for name, df in inputs.items()
    }
    kept = quality_rules(documents).filter("kept").select("doc_id").collect()
    assert {i for i, _ in pairs["exact_dedup"]} == {r.doc_id for r in kept}
    largest = defaultdict(lambda: -1)
    for i, text in pairs["exact_dedup"]:
        largest[text] = max(largest[text], i)
    assert sorted(pairs["near_dedup"]) == sorted((i, text) for text, i in largest.items())
    least = {i for i, _, c in near_groups(pairs["near_dedup"]) if i == c}
    assert {i for i, _ in pairs["mix"]} == least
    uses = mix_sources(inputs["mix"]).groupBy("doc_id").count().collect()
    times = defaultdict(int)
    for i, _ in pairs["sentencepiece"]:
        times[i] += 1
    assert times == {r.doc_id: r["count"] for r in uses}
    back = decode_pieces(docs.withColumnRenamed("text", "was"), PIECE_MODEL, carry=("was",))
    assert docs.count() == len(pairs["sentencepiece"])
    assert back.filter(F.col("text") != F.col("was")).count() == 0


def test_awkward_documents(spark, edge, empty):
    for docs in (edge.drop("ids"), empty.drop("ids")):
        for _, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, SF), "stage")
        assert docs.columns[-1] == "ids"
    assert docs.count() == 0


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long"
    ).repartition(3)


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_near_drops_rows_not_ids(spark):
    """Another text under a dropped row's id stays; so do other texts without an id."""
    one, two = (" ".join(f"{x}{k}" for k in range(40)) for x in "pq")
    rows = [(3, one), (5, one + " more"), (5, two), (None, one + " tail"), (None, one.upper()), (None, "w")]
    kept = pairs(corpus_pipeline.near(spark, frame(spark, rows), SF))
    # A null id joins no bucket: only a copy of the set of a row with an id goes.
    assert kept == sorted([(3, one), (5, two), (None, one + " tail"), (None, "w")], key=str)


def test_mix_uses_each_text_of_an_id(spark):
    rows = [(5, "a b c"), (5, "d e f g"), (None, "h i"), (7, ""), (8, None), (9, "x")]
    rows += [(100 + k, f"word{k} " * 9) for k in range(40)]
    docs = frame(spark, rows)
    uses = mix_sources(docs).groupBy("doc_id", "text_hash").count().collect()
    hashes = {(r.doc_id, r.text): r.h for r in docs.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()}
    times = {(r.doc_id, r.text_hash): r["count"] for r in uses}
    want = sorted((row for row in rows for _ in range(times.get((row[0], hashes[row]), 0))), key=str)
    assert pairs(corpus_pipeline.mix(spark, docs, SF)) == want and (5, "a b c") in want and (7, "") not in want


def test_segment_numbers_copies(spark):
    rows = [(4, "some words of a text " * 30)] * 6 + [(4, "other words")] + [(None, "no id " * 40)] * 3 + [(1, None)]
    found = corpus_pipeline.segment(spark, frame(spark, rows), SF).collect()
    assert len(found) == 11 and len({tuple(r.ids) for r in found if r.doc_id == 4}) == 7
    assert len({tuple(r.ids) for r in found if r.doc_id is None}) == 3
    assert [r.ids for r in found if r.doc_id == 1] == [[]]


def test_exact_keeps_the_largest_id(spark):
    rows = [(1, "t"), (4, "t"), (4, "t"), (None, "t"), (2, None), (3, ""), (None, "u"), (None, "u")]
    kept = pairs(corpus_pipeline.exact(spark, frame(spark, rows), SF))
    assert kept == sorted([(4, "t"), (3, ""), (None, "u")], key=str)


def test_repeated_rows_leave_one(spark, edge):
    kept = corpus_pipeline.exact(spark, edge, SF).filter("doc_id = 13").count()
    assert kept == 1
