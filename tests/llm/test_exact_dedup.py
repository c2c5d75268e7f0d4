import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tickflow.llm.exact_dedup import exact_dedup
from tickflow.llm.text import or_empty


def expected(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[text or ""].append(i)
    for i, text in rows:
        own = groups[text or ""]
        keep = max((x for x in own if x is not None), default=None)
        digest = hashlib.sha256((text or "").encode()).hexdigest()
        yield i, keep, len(own), i == keep, digest


# With few slots, keys share them, and rows go through passes that they need not.
@pytest.mark.parametrize("slots", [1 << 24, 32768])
def test_groups(edge, slots):
    digest = {"sha": F.sha2(or_empty("text"), 256)}
    got = exact_dedup(edge, carry=digest, slots=slots, prefix_chars=4)
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept, r.sha) for r in got.collect()]
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    assert sorted(got, key=str) == sorted(expected(rows), key=str)


def test_full_hash_only_where_needed(spark):
    rows = [(1, "aaaa"), (2, "bbbb"), (3, "cc"), (4, "aaaa")]
    got = exact_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in got if r._digest} == {1, 4}


def test_equal_prefixes_differ_later(spark):
    rows = [(1, "p" * 300 + "a"), (2, "p" * 300 + "b"), (3, "p" * 300 + "a")]
    got = exact_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.keep_id) for r in got) == [(1, 3), (2, 2), (3, 3)]


def test_empty(empty):
    assert exact_dedup(empty).count() == 0
