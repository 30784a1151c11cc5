"""PageRank on blocks and itemsets by lists of baskets, against plainly written versions."""

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from larder.operators import cooccurrence as C
from larder.operators import graph as G


def edge_rows(seed, n=40, m=90):
    rng = random.Random(seed)
    return [(a * 7 - 50, b * 7 - 50, rng.randint(1, 9)) for a, b in rng.sample(list(combinations(range(n), 2)), m)]


def plain_ranks(rows, rounds):
    nodes = sorted({x for a, b, _ in rows for x in (a, b)})
    at = {x: k for k, x in enumerate(nodes)}
    w = np.zeros((len(nodes), len(nodes)))
    for a, b, n in rows:
        w[at[a], at[b]] += n
        w[at[b], at[a]] += n
    share = w / w.sum(axis=1, keepdims=True)
    rank = np.full(len(nodes), 1 / len(nodes))
    for _ in range(rounds):
        rank = 0.15 / len(nodes) + 0.85 * (rank @ share)
    return dict(zip(nodes, rank, strict=True))


@pytest.mark.parametrize("block,rounds,residual", [(50_000, 4, 0.0), (6, 4, 0.0), (6, 200, 1e-12)])
def test_pagerank_equals_the_matrix_form(spark, block, rounds, residual):
    rows = edge_rows(3)
    found = {r.product_id: r.rank for r in G.pagerank(spark.createDataFrame(rows, "product_a long, product_b long, n_pairs long"), iterations=rounds, residual=residual, block_nodes=block).collect()}
    want = plain_ranks(rows, rounds)
    assert found.keys() == want.keys() and all(found[k] == pytest.approx(want[k], abs=1e-10) for k in want)


def test_no_edges_have_no_ranks(spark):
    assert G.pagerank(spark.createDataFrame([], "product_a long, product_b long, n_pairs long")).count() == 0


def plain_sets(baskets, least):
    count = Counter(s for b in baskets for size in range(1, len(b) + 1) for s in combinations(sorted(b), size))
    return {s: n for s, n in count.items() if n >= least}


@pytest.mark.parametrize("least,slice_baskets", [(2, 1 << 16), (4, 8), (1, 8)])
def test_itemsets_equal_brute_force(spark, monkeypatch, least, slice_baskets):
    monkeypatch.setattr(C, "SLICE_BASKETS", slice_baskets)
    rng = random.Random(least)
    baskets = [set(rng.choices(range(9), weights=range(1, 10), k=rng.randint(1, 6))) for _ in range(60)]
    rows = [(f"b{k}", i) for k, b in enumerate(baskets) for i in b]
    table = spark.createDataFrame(rows + rows[:20], "basket string, item long").repartition(3)
    sets, n = C.frequent_itemsets(table, "basket", "item", least)
    found = {tuple(r["items"]): r["n"] for r in sets.collect()}
    assert n == len(baskets) and found == plain_sets(baskets, least)
    assert max(map(len, found)) >= 3
    rules = {(r.antecedent, r.consequent): r for r in C.itemset_rules(table, "basket", "item", 0.3, min_count=least).collect()}
    want = {}
    for s, k in found.items():
        for one in s if len(s) > 1 else ():
            left = tuple(x for x in s if x != one)
            if k / found[left] >= 0.3:
                want[",".join(map(str, left)), str(one)] = (k / found[left], k * n / (found[left] * found[(one,)]), k / n)
    assert rules.keys() == want.keys()
    assert all((r.confidence, r.lift, r.support) == pytest.approx(want[key]) for key, r in rules.items())


def test_a_very_large_basket(spark):
    """100,000 items in one basket, a few of which other baskets hold too."""
    big = spark.range(100_000).selectExpr("0L AS basket", "id AS item")
    small = spark.createDataFrame([(k, i) for k in range(1, 6) for i in (1, 2, 3)], "basket long, item long")
    sets, n = C.frequent_itemsets(big.unionByName(small), "basket", "item", 3)
    assert n == 6 and {tuple(r["items"]): r["n"] for r in sets.collect()} == {s: 6 for size in (1, 2, 3) for s in combinations((1, 2, 3), size)}


def test_no_pairs(spark):
    sets, n = C.frequent_itemsets(spark.createDataFrame([(1, 1), (2, 1)], "basket long, item long"), "basket", "item", 2)
    assert n == 2 and [tuple(r["items"]) for r in sets.collect()] == [(1,)]
    sets, n = C.frequent_itemsets(spark.createDataFrame([], "basket long, item long"), "basket", "item", 1)
    assert n == 0 and sets.count() == 0
