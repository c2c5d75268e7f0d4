import re
from collections import Counter, defaultdict

import duckdb
import pytest

from tickflow.llm.quality import QualitySpec, quality_filter, quality_rules
from tickflow.llm.queries_native import QUALITY_SQL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (
        *(len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines))),
        *(len(covered), failed),
    )


def measured(df):
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return sorted(((r.doc_id, *(r[c] for c in columns)) for r in df.collect()), key=str)


def test_base_measures(edge, documents):
    for docs in (edge, documents):
        rows = [(r.doc_id, *base(r.text)) for r in docs.select("doc_id", "text").collect()]
        assert measured(quality_rules(docs)) == sorted(rows, key=str)


def test_windows_that_touch_and_overlap(spark):
    w = [f"w{i}" for i in range(30)]
    texts = [
        " ".join(w[:9] + w[:9]),
        " ".join(w[:8] + ["x"] + w[1:9] + w[:8]),
        " ".join(["a"] * 40),
        " ".join(w + ["b"] * 12 + w[5:20]),
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs = docs.selectExpr("*", "'h' AS source")
    assert measured(quality_rules(docs)) == [(i, *base(t)) for i, t in enumerate(texts)]


def body(i):
    return " ".join(f"own{i}word{k}" for k in range(25))


def boilerplate(spark):
    """Host h: a line in five documents; in one of them next to much text of its own."""
    common = " ".join(f"notice{k}" for k in range(30))
    rows = [(i, f"{common}\nfew words {i}", "h") for i in range(4)]
    rows += [(10, f"  {common.upper()}\n{body(10)}\n{body(11)}", "h"), (20, body(20), "h")]
    rows += [(30, f"{common}\nfew words 30", "other")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string"), common


def test_line_frequency(spark):
    spec = QualitySpec(max_docs=4)
    docs, common = boilerplate(spark)
    got = {r.doc_id: r for r in quality_rules(docs, spec=spec).collect()}
    assert {i for i, r in got.items() if not r.kept} == {1, 2, 3}
    assert not any(r.base_failed for r in got.values())
    assert got[10].removed_words == len(common.split()) and got[0].removed_words == 0
    kept = {r.doc_id: r.text for r in quality_filter(docs, spec=spec).collect()}
    assert set(kept) == {0, 10, 20, 30}
    assert kept[10] == f"{body(10)}\n{body(11)}" and kept[0].startswith(common)


def test_copies_are_documents(spark):
    """Copies under ids of their own count each; rows that repeat an id and a text once."""
    rows = [(i, body(1), "h") for i in range(10)] + [(100, body(2), "h")] * 10
    rows += [(None, body(3), "h")] * 10
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = quality_rules(docs, spec=QualitySpec(max_docs=2)).collect()
    assert sorted(r.doc_id for r in got if r.kept and r.doc_id is not None) == [0, *[100] * 10]
    assert sum(r.kept for r in got if r.doc_id is None) == 10
    assert {r.removed_words for r in got if r.doc_id in range(1, 10)} == {25}


def shared_lines(n):
    lines = [f"line number {k} of the shared ones" for k in range(7)]
    return [
        (i, "\n".join([*(lines[(i + k) % 7] for k in range(i % 5)), body(i)]), f"h{i % 2}")
        for i in range(n)
    ]


@pytest.mark.parametrize("limit, share", [(8, 70), (8, 15), (12, 70), (1, 10)])
def test_many_documents_against_plain_count(spark, limit, share):
    rows = shared_lines(60)
    holders = defaultdict(set)
    for i, text, host in rows:
        for line in set(text.split("\n")):
            holders[host, line].add(i)
    want = {}
    for i, text, host in rows:
        own = set(text.split("\n"))
        gone = {x for x in own if len(holders[host, x]) > limit and min(holders[host, x]) < i}
        lost, whole = (sum(len(x.split()) for x in xs) for xs in (gone, own))
        want[i] = (lost, 100 * lost <= share * whole)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    spec = QualitySpec(max_docs=limit, max_removed_pct=share)
    got = quality_rules(docs, spec=spec).collect()
    assert {r.doc_id: (r.removed_words, r.kept) for r in got} == want
    assert any(n for n, _ in want.values()) == (limit < 12)
    assert all(ok for _, ok in want.values()) == (share == 70)


def test_depleted_documents_as_in_sql(spark):
    """The query's SQL, with lower limits, on documents of which some are depleted."""
    path = "/root/testdata/sf0.01/documents.parquet"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
    sql = QUALITY_SQL.replace("count(*) > 10", "count(*) > 1").replace("> 70 * total", "> 30 * total")
    columns = "doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, removed_words"
    want = sorted(con.execute(f"SELECT {columns} FROM ({sql})").fetchall())
    spec = QualitySpec(max_docs=1, max_removed_pct=30)
    got = quality_rules(spark.read.parquet(path), spec=spec).select(*columns.split(", "))
    assert sorted(map(tuple, got.collect())) == want
    assert sum(not failed and not kept for *_, failed, kept, _ in want) > 5


def test_filter_on_measures_and_columns(edge, empty):
    kept = quality_filter(edge)
    assert kept.columns == edge.columns and kept.count() > 0
    assert quality_rules(edge).filter("NOT base_failed").count() >= kept.count()
    assert quality_rules(empty).count() == 0 and quality_filter(empty).columns == empty.columns
