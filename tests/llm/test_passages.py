import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tickflow.llm.passages import PassageSpec, without_repeats
from tickflow.llm.suffix_runs import front_code, front_decode, merge_runs, shared_prefix

TINY = PassageSpec(length=12, gram=4, width=3, frequent=2, per_range=50)
RARE = PassageSpec(length=12, gram=4, width=3, frequent=10**6, per_range=50)
SCHEMA = "doc_id long, text string, range long, run string, ta long, first long, kept_bytes string"


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for d, r in enumerate(raw):
        for p in range(len(r) - length + 1):
            seen.setdefault(r[p : p + length], []).append((d, p))
    gone = [np.zeros(len(r), dtype=bool) for r in raw]
    for places in seen.values():
        if len(places) > 1:
            for d, p in places:
                gone[d][p : p + length] = True
    out = []
    for r, g in zip(raw, gone, strict=True):
        spans = int((np.diff(np.concatenate([[0], g.astype(np.int8)])) == 1).sum())
        out.append((len(r), int(g.sum()), spans, bytes(b for b, x in zip(r, g, strict=True) if not x)))
    return out


def check(spark, texts, spec):
    rows = [(i, t, 1, "r", 2, 3, "k") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(without_repeats(df, spec=spec).collect())
    want = brute(texts, spec.length)
    assert [(r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept_bytes)) for r in got] == want
    return want


def mosaic(seed, n, letters="abé"):
    """Texts of a few shared passages, their parts and letters between them."""
    pick = random.Random(seed)
    word = lambda k: "".join(pick.choice(letters) for _ in range(k))
    passages = [word(pick.randrange(8, 60)) for _ in range(5)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(pick.randrange(0, 5)):
            p = pick.choice(passages)
            a = pick.randrange(len(p))
            parts += [p[a : a + pick.randrange(60)], word(pick.randrange(0, 9))]
        texts.append("".join(parts))
    return texts


@pytest.mark.parametrize("spec", [TINY, RARE])
@pytest.mark.parametrize("letters", ["abé", "abcdefghijklmnopqrstuvwxyz"])
def test_against_brute_force(spark, spec, letters):
    for seed in (1, 2):
        want = check(spark, mosaic(seed, 60, letters), spec)
        assert any(0 < n < b for b, n, _, _ in want)


@pytest.mark.parametrize("spec", [TINY, PassageSpec()])
def test_edges(spark, spec):
    long = "".join(chr(97 + x) for x in np.random.default_rng(3).integers(0, 26, 30_000))
    texts = [None, "", "\0", "short", "x" * 5000, "ab" * 900, long, "é" + long[100:900], long[:500] + "\r\n" + long[300:800]]
    texts += ["copy of a text that is long enough to go " * 12] * 3 + ["日本" * 300, "本日" * 300]
    check(spark, texts, spec)


def test_real_length_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    want = check(spark, texts, PassageSpec())
    assert sum(n > 0 for _, n, _, _ in want) > 5
    check(spark, texts, PassageSpec(frequent=2, width=16))


def test_near_copies_of_one_text(spark):
    """A frequent gram's windows go by parts; edits cut the copies anywhere."""
    pick = random.Random(5)
    base = "".join(pick.choice("abcdefgh ") for _ in range(300))
    texts = []
    for _ in range(80):
        t = list(base)
        for _ in range(pick.randrange(0, 4)):
            t[pick.randrange(len(t))] = pick.choice("xyz")
        texts.append("".join(t))
    check(spark, texts, PassageSpec(length=40, gram=8, width=5, frequent=6))


def test_spans_and_runs_change_nothing(spark, monkeypatch):
    """Small spans, and runs of few suffixes, give the same bytes."""
    monkeypatch.setattr("tickflow.llm.passages.SPAN", 17)
    monkeypatch.setattr("tickflow.llm.passages.RUN_SUFFIXES", 5)
    from tickflow.llm import passages

    texts = mosaic(7, 30)
    raw = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    windows = []
    for found, _, _ in passages.anchored(raw, offsets, TINY):
        for t, s, lo, hi in zip(found.text, found.start, found.low, found.high, strict=True):
            windows += [(t, s - offset) for offset in range(lo, hi + 1)]
    want = [(t, p) for t in range(len(texts)) for p in range(offsets[t], offsets[t + 1] - TINY.length + 1)]
    assert sorted(windows) == want
    check(spark, texts, TINY)


def test_empty(spark):
    assert without_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
    check(spark, ["too short", None], TINY)


strings = st.lists(st.text("ab\0", max_size=8).map(str.encode), max_size=12)


@settings(max_examples=200, deadline=None)
@given(st.lists(strings, max_size=9))
def test_loser_tree(lists):
    runs = [sorted(x) for x in lists]
    coded = [front_code(r) for r in runs]
    for run, (shared, rests) in zip(runs, coded, strict=True):
        lengths = np.array([len(x) for x in run], dtype=np.int64)
        assert front_decode(shared, lengths, rests) == run
    origin, shared = merge_runs([(r, c[0]) for r, c in zip(runs, coded, strict=True)])
    at, merged = [0] * len(runs), []
    for k in origin:
        merged.append(runs[k][at[k]])
        at[k] += 1
    assert merged == sorted(x for r in runs for x in r)
    before = [b"", *merged]
    assert shared == [shared_prefix(a, b) for a, b in zip(before, merged, strict=False)]
