import math
from collections import defaultdict

import pytest

from tickflow.llm.mixing import MixSpec, mix_sources


def corpus(spark, sizes):
    rows = [
        (k * 10_000 + i, "w " * (5 + (i * 7) % 20), name)
        for k, (name, n) in enumerate(sizes.items())
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4), rows


def measured(df):
    used, epochs = defaultdict(int), defaultdict(list)
    rows = df.collect()
    for r in rows:
        used[r.source] += r.n_tokens
        epochs[r.doc_id].append(r.epoch)
    assert all(sorted(e) == list(range(len(e))) for e in epochs.values())
    return rows, used, {r.source: r.weight for r in rows}


def weights(tokens, exponent):
    total = sum(tokens.values())
    w = {s: (n / total) ** exponent for s, n in tokens.items()}
    return {s: x / sum(w.values()) for s, x in w.items()}


def entropy(q):
    return -sum(x * math.log(x) for x in q.values())


@pytest.mark.parametrize("share, repeats", [(0.85, 99.0), (1.0, 1.5), (0.2, 9.0)])
def test_weights_and_budgets(spark, share, repeats):
    docs, rows = corpus(spark, {"big": 900, "mid": 200, "small": 60, "tiny": 20})
    spec = MixSpec(entropy_share=share, max_repeats=repeats, blocks=16)
    got, used, q = measured(mix_sources(docs, spec=spec))
    tokens = defaultdict(int)
    for _, text, source in rows:
        tokens[source] += len(text.split())
    total = sum(tokens.values())
    # The exponent by brute force over a fine grid.
    fits = [
        x
        for x in (i / 20_000 for i in range(20_001))
        if all(w * total <= repeats * tokens[s] for s, w in weights(tokens, x).items())
    ]
    reach = [x for x in fits if entropy(weights(tokens, x)) >= share * math.log(4)]
    want = weights(tokens, max(reach) if reach else min(fits))
    assert all(abs(q[s] - want[s]) < 1e-4 for s in tokens)
    for source in tokens:
        budget = math.floor(q[source] * total + 1e-6)
        assert budget - 24 < used[source] <= budget


def test_blocks_are_permuted_and_whole(spark):
    docs, _ = corpus(spark, {"a": 400, "b": 100})
    spec = MixSpec(blocks=8, max_repeats=4.0, entropy_share=1.0)
    got, _, _ = measured(mix_sources(docs, spec=spec))
    orders, cut = defaultdict(dict), defaultdict(set)
    for r in got:
        orders[r.source, r.epoch][r.block] = r.rank
    for r in got:
        cut[r.source, r.block].add(sum(x.doc_id == r.doc_id for x in got))
    order = lambda e: sorted(orders["b", e], key=orders["b", e].get)
    assert order(0) != order(1) and sorted(order(0)) == sorted(order(1))
    for source in ("a", "b"):
        assert sum(len(n) > 1 for (s, _), n in cut.items() if s == source) <= 1
    other, _, _ = measured(mix_sources(docs, spec=MixSpec(blocks=8, max_repeats=4.0, seed=3)))
    assert {(r.doc_id, r.epoch) for r in other} != {(r.doc_id, r.epoch) for r in got}


def test_edges(spark, edge, empty):
    got = mix_sources(edge).collect()
    assert not {4, 5, 6} & {r.doc_id for r in got} and {r.source for r in got} == {"", "s"}
    assert mix_sources(empty).count() == 0
    one, _ = corpus(spark, {"only": 30})
    assert mix_sources(one).count() == 30
