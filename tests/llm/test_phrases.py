import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tickflow.llm import phrases
from tickflow.llm.bloom import Bloom
from tickflow.llm.phrases import PhraseSpec, collocations

SMALL = PhraseSpec(support=4, shards=3, top=40)
SCHEMA = "doc_id long, text string, lang string, phrase string, n long, key long, shard int, rank long"


def brute(rows, spec):
    f, total = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in range(1, spec.longest + 1):
                for i in range(len(words) - n + 1):
                    f[lang][tuple(words[i : i + n])] += 1
    out = []
    for lang, count in f.items():
        found = {p: a for p, a in count.items() if len(p) > 1 and a >= spec.support}
        inside = Counter()
        for p, a in found.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i : i + m]] = max(inside[p[i : i + m]], a)
        scored = []
        for p, a in found.items():
            if p in inside and 100 * inside[p] >= spec.covered_pct * a:
                continue
            cuts = [(count[p[:k]], count[p[k:]], k) for k in range(1, len(p))]
            score, _, lo, hi = min((spec.scale * a // (x + y), k, x, y) for x, y, k in cuts)
            scored.append((-score, -a, " ".join(p).encode(), lo, hi))
        for i, (s, a, p, lo, hi) in enumerate(sorted(scored)[: spec.top], 1):
            out.append((lang, i, p.decode(), -a, lo, hi, total[lang], -s))
    return sorted(out)


def found(spark, rows, spec):
    df = spark.createDataFrame([(*r, "x", 1, 1, 1, 1) for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, collocations(df, spec=spec).collect()))


def prose(seed, n):
    pick = random.Random(seed)
    words = ["The", "cat", "sat", "on", "a", "mat", "é", "日本", "New York", "x"]
    def text():
        k = pick.randrange(0, 60)
        return "".join(pick.choice(words[: pick.randrange(2, 10)]) + pick.choice([" ", " ", " ", "\t", ", ", ".\n"]) for _ in range(k))
    return [(i, text(), pick.choice(["en", "fr", None])) for i in range(n)]


def test_against_brute_force(spark):
    rows = prose(1, 120)
    want = brute(rows, SMALL)
    assert found(spark, rows, SMALL) == want and len(want) > 60


def test_blocks_and_spans_change_nothing(spark, monkeypatch):
    """Texts cut into small spans, and blocks of few texts, count the same."""
    rows = prose(2, 6)
    long = " ".join(f"{a} {b}" for _, a, _ in rows for b in (a, "far away"))
    offsets = np.array([0, 0, len(long.encode()), len(long.encode())])
    raw = np.frombuffer(long.encode(), dtype=np.uint8)
    whole = phrases.Block(raw, offsets)
    monkeypatch.setattr("tickflow.llm.shingles.SPAN_BYTES", 7)
    cut = phrases.Block(raw, offsets)
    assert len(whole.word) > 100 and (cut.text == 1).all()
    assert (whole.word == cut.word).all() and (np.diff(whole.piece) == np.diff(cut.piece)).all()
    spelled = [[words[i].as_py() for i in codes] for words, codes in (whole.dictionary(), cut.dictionary())]
    assert spelled[0] == spelled[1] and len(spelled[0]) == len(whole.word)


def test_edges(spark):
    rows = [
        (1, None, "en"), (2, "", None), (3, " \t\n.;", ""), (3, "a b a b a b", ""), (3, "a b a b a b", ""),
        (None, "a b " * 30_000, "en"), (4, "A B. a,b a;B c", "en"), (5, "\0 b \0 b \0 b \0 b", None),
        (6, "y" * 200_000 + " z", "en"),
    ]
    want = brute(rows, SMALL)
    assert found(spark, rows, SMALL) == want and len(want) > 3


@pytest.mark.parametrize("rows", [[], [(1, "too few words", "en")]])
def test_nothing_found(spark, rows):
    assert found(spark, rows, SMALL) == []


def test_products_beyond_64_bits(spark):
    spec = PhraseSpec(support=2, shards=1, scale=2**62)
    rows = [(1, "p q p q p q q", "en")]
    assert found(spark, rows, spec) == brute(rows, spec)


def test_copies_of_one_text(spark):
    rows = [(i, "one two three four five", "en") for i in range(200)] + prose(3, 20)
    spec = PhraseSpec(support=25, shards=4)
    assert found(spark, rows, spec) == brute(rows, spec)


def test_bloom_holds_its_keys(spark):
    keys = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 5000)
    bloom = Bloom(spark.createDataFrame([(int(k),) for k in keys], "key long"))
    assert bloom.holds(keys.view(np.uint64)).all()
    others = np.random.default_rng(2).integers(-(2**63), 2**63 - 1, 5000)
    assert bloom.holds(others.view(np.uint64)).mean() < 0.05
