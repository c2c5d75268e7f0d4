import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tickflow.llm import near_dedup
from tickflow.llm.links import components
from tickflow.llm.near_dedup import near_duplicates
from tickflow.llm.set_sketch import SketchSpec, estimated_jaccard, registers
from tickflow.llm.shingles import shingle_sets, string_buffers

SEPARATORS = str.maketrans({c: " " for c in "\t\n\x0b\x0c\r"})
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def shingles(text):
    words = [w for w in (text or "").translate(LOWER).translate(SEPARATORS).split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1)))


def expected(rows):
    """(doc_id, n_shingles, component_id) by comparing whatever shares a shingle."""
    classes = defaultdict(list)
    for i, text in rows:
        classes[shingles(text)].append(i)
    parent = {min(ids): min(ids) for ids in classes.values()}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders, done = defaultdict(list), {}
    for own, ids in classes.items():
        me = min(ids)
        both = Counter(x for s in own for x in holders[s])
        for other, n in both.items():
            if 100 * n >= 75 * (len(own) + len(done[other]) - n):
                a, b = sorted((root(me), root(other)))
                parent[b] = a
        done[me] = own
        for s in own:
            holders[s].append(me)
    return sorted(
        (i, len(own), root(min(ids)) if own else i) for own, ids in classes.items() for i in ids
    )


def found(df):
    rows = df.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows)


def variants(n, words, rng, most):
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    for _ in range(n):
        own = list(base)
        for k in rng.sample(range(words), rng.randint(0, most)):
            own[k] = f"x{rng.randrange(10**9)}"
        yield " ".join(own)


def test_documents(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert found(near_duplicates(documents)) == expected(rows)


@pytest.mark.parametrize("large", [2, 8, 1000])
def test_groups_of_all_distances(spark, monkeypatch, large):
    """Groups whose members are linked, nearly linked, or linked only over others."""
    monkeypatch.setattr(near_dedup, "LARGE", large)
    rng = random.Random(large)
    texts = [t for most in (1, 3, 6) for t in variants(60, 120, rng, most)]
    chain = [f"c{k}" for k in range(200)]
    texts += [" ".join(chain[k : k + 100]) for k in range(0, 100, 8)]
    texts += [texts[5], texts[70], texts[70].upper()]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(near_duplicates(docs)) == expected(rows)


def ring(n):
    """Texts of which all pairs have a similarity just below the threshold; each shares
    its own words with its neighbours alone."""
    base = " ".join(f"c{i}" for i in range(150))
    own = [" ".join(f"o{i}x{k}" for k in range(16)) for i in range(n)]
    return [(i, f"{base} {own[i]} {own[(i + 1) % n]}") for i in range(n)]


def test_pairs_of_equidistant_texts_grow_with_the_group(spark, monkeypatch):
    """Unlinked texts at one distance: candidates grow with their number, not its square."""
    counts = []
    links = near_dedup._Verifier.links

    def counted(self, pairs):
        counts[-1] += pairs.count()
        return links(self, pairs)

    monkeypatch.setattr(near_dedup._Verifier, "links", counted)
    for n in (24, 48, 96):
        rows = ring(n)
        sets = [shingles(t) for _, t in rows]
        far = [len(sets[0] & s) / len(sets[0] | s) for s in sets[2:-1]]
        assert 0.6 < min(far) and max(far) < 0.75
        counts.append(0)
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        assert found(near_duplicates(docs)) == expected(rows)
    assert counts[2] < 2.6 * counts[1] and counts[2] < 14 * 96


def test_ids_that_stand_on_several_texts(spark):
    """Each text is a node; a near copy of the second text of an id is linked to it."""
    one, two = (" ".join(f"{x}{k}" for k in range(60)) for x in "pq")
    rows = [(5, one), (5, two), (7, two + " more"), (3, one + " tail"), (9, "x y z"), (5, one)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id, r.component_id) for r in near_duplicates(docs).collect())
    assert got == [(3, 3), (5, 3), (5, 3), (5, 5), (7, 5), (9, 9)]


def test_edges(spark, edge, empty):
    rows = edge.select("doc_id", "text").collect()
    got = near_duplicates(edge).collect()
    assert len(got) == len(rows)
    named = sorted({(r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id is not None})
    assert named == sorted(set(expected([(r.doc_id, r.text) for r in rows if r.doc_id is not None])))
    nameless = {(r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is None}
    assert nameless == {(18, 1, False), (1, None, True)}
    assert near_duplicates(empty).count() == 0


def test_shingles_are_exact():
    texts = ["", None, "a", "A b", "x" * 3_000_000, "x y " * 700_000, " \n", "é ü", "a b c d e"]
    texts += ["A B C D E f", "end of one", "start of next", "  is no separator"]
    flat, bounds = shingle_sets(*string_buffers(pa.array(texts)))
    assert [int(n) for n in np.diff(bounds)] == [len(shingles(t)) for t in texts]
    same = shingle_sets(*string_buffers(pa.array(["q w", "A\tb", "a b c  d e"])))
    own = dict(zip(texts, np.split(flat, bounds[1:-1]), strict=True))
    parts = np.split(same[0], same[1][1:-1])
    assert (parts[1] == own["A b"]).all() and (parts[2] == own["a b c d e"]).all()


def test_registers_of_a_union_and_estimates():
    rng, spec = np.random.default_rng(3), SketchSpec()
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    shared = [0.0, 0.3, 0.6, 0.75, 0.9, 1.0]
    for j in shared:
        n = 1500
        both = int(2 * n * j / (1 + j))
        a, b = pool[:n], pool[n - both : 2 * n - both]
        union = np.union1d(a, b)
        flat, bounds = np.concatenate([a, b, union]), np.cumsum([0, n, n, len(union)])
        one, two, three = registers(flat, bounds, spec)
        assert (np.maximum(one, two) == three).all()
        likely = estimated_jaccard(one[None], two[None], np.array([n]), np.array([n]), spec)
        assert abs(likely[0] - j) < near_dedup.ESTIMATE_MARGIN
    assert (registers(np.zeros(0, np.uint64), np.array([0, 0]), spec) == 0).all()


def test_components(spark):
    rng = random.Random(9)
    links = [(i, i + 1) for i in range(100, 160)] + [(1, k) for k in range(500, 700)]
    links += [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(120)] + [(7, 7)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    distinct = list({tuple(sorted(x)) for x in links})
    got = components(spark.createDataFrame(distinct, "a long, b long"), "a", "b").collect()
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert {r.node: r.component for r in got} == {x: root(x) for x in linked if root(x) != x}
    assert len(got) == sum(root(x) != x for x in linked)
