"""Pairs of blocks by tile: what moves, and the trees that a tile leaves."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.operators import blocks as BL
from larder.operators import density as D
from larder.operators import evaluation as E
from larder.operators import hierarchy as H
from larder.session import cut, parallelism
from tests import brute
from tests.test_density import frame


def test_a_block_moves_once_for_each_group(spark):
    n = 60
    blocks = cut(spark.range(n).select(F.col("id").alias("block"), F.lit(b"x").alias("coords")))
    pairs = cut(spark.range(n).select(F.col("id").alias("a")).crossJoin(spark.range(n).select(F.col("id").alias("b"))).filter("a <= b"))
    rows = BL.in_tiles(pairs, blocks, ["coords"]).collect()
    groups = int(np.ceil(np.sqrt(4.0 * parallelism(spark))))
    assert len(rows) <= n * groups < n * (n + 1)
    met = [(r.block, b) for r in rows for b in r.meets]
    assert len(met) == len(set(met)) == n * (n + 1) // 2


@pytest.mark.parametrize("size,reach", [(300, 1e9), (90, 0.8), (400, 0.5)])
def test_a_tile_leaves_a_minimum_forest(size, reach):
    """Lattice points, so that most weights are equal; blocks that hold parts already joined; edges up to a reach."""
    rng = np.random.default_rng(size)
    x = rng.integers(0, 12, (size, 3)) * 0.3
    ids, cores, parts = rng.permutation(size), rng.choice([0.0, 0.3, 0.6], size), rng.integers(0, size, size)
    names = np.unique(parts)
    code, forest = np.searchsorted(names, parts), H._Forest(names, reach)
    forest.BUFFER = 500
    cuts = list(range(0, size, 70))
    for i in cuts:
        for j in (k for k in cuts if k >= i):
            a, b = slice(i, i + 70), slice(j, j + 70)
            forest.meet(BL.squared_distances(x[a], x[b]), x[a], x[b], ids[a], ids[b], cores[a], cores[b], code[a], code[b], i == j)
    w = np.maximum(brute.distances(x), np.maximum(cores[:, None], cores[None, :]))
    u, v = np.triu_indices(size, 1)
    lo, hi, w = np.minimum(ids[u], ids[v]), np.maximum(ids[u], ids[v]), w[u, v]
    label, want = parts.copy(), []
    for k in np.lexsort((hi, lo, np.round(w, 9))):
        if w[k] <= reach and label[u[k]] != label[v[k]]:
            label[label == label[v[k]]] = label[u[k]]
            want.append(w[k])
    found = forest.frame()
    assert len(found) == len(want) < size
    assert np.allclose(np.sort(found["w"]), np.sort(want))


def test_links_of_dense_blocks_are_few_rows(spark):
    """Two blocks of one cluster say that their components touch once, whatever the number of close pairs."""
    x = np.random.default_rng(3).normal(0, 0.1, (400, 2))
    found = D.dbscan_trials(frame(spark, x), [(0.15, 4), (0.4, 9)], block_rows=100).collect()
    for t, (eps, least) in enumerate([(0.15, 4), (0.4, 9)]):
        got = {r.row_id: r.cluster_label for r in found if r.trial == t}
        assert (np.array([got[i] for i in range(len(x))]) == brute.dbscan(x, eps, least)).all()


def test_equal_distances_are_equal_in_every_block(spark):
    """Core distances and the weights of the tree come from the same numbers, so the lightest edge of a point weighs what its core distance is."""
    x = np.random.default_rng(4).normal(0, 1, (500, 16))
    points = BL.distinct_points(frame(spark, x))
    cores, packed, diameter = H.core_distances(points, 2, block_rows=60)
    tree = H.spanning_tree(points, cores, packed, diameter).toPandas()
    core = cores.select("pid", "core").toPandas().set_index("pid")["core"]
    lightest = np.minimum(tree.groupby("u")["w"].min().reindex(core.index).fillna(np.inf), tree.groupby("v")["w"].min().reindex(core.index).fillna(np.inf))
    near = brute.distances(x).argsort(axis=1)[:, 1]
    mutual = [i for i in core.index if near[near[i]] == i]
    assert mutual and all(lightest[i] == core[i] for i in mutual)


def test_scores_by_array_and_by_row_are_the_same(spark, monkeypatch):
    """Three labellings with copies, a cluster of one row and one label alone; distances of a pair of blocks are worked out once."""
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(c, 1, (60, 3)) for c in (0, 4, 9)])
    x[100:110] = x[100]
    labels = [[int(i // 60), int(i == 7), 3] for i in range(len(x))]
    labels[100:110] = [labels[100]] * 10
    df = frame(spark, x).join(spark.createDataFrame(list(enumerate(labels)), "row_id long, labels array<long>"), "row_id")
    got = {r["trial"]: (r["silhouette"], r["n_rows"]) for r in E.silhouette_exact(df, block_rows=25).collect()}
    monkeypatch.setattr(E, "ARRAY_CLUSTERS", 0)
    want = {r["trial"]: (r["silhouette"], r["n_rows"]) for r in E.silhouette_exact(df, block_rows=25).collect()}
    assert got[2] == want[2] == (None, len(x))
    for t in (0, 1):
        assert got[t][0] == pytest.approx(want[t][0], abs=1e-12) and got[t][1] == want[t][1] == len(x)


def test_a_distance_is_worked_out_once(monkeypatch):
    made, squared = [], E.squared_distances
    monkeypatch.setattr(E, "squared_distances", lambda a, b: made.append(1) or squared(a, b))
    rng = np.random.default_rng(6)
    rows = [dict(block=i, own_group=i % 2, weights=np.ones(5).tobytes(), coords=rng.normal(size=(5, 2)).tobytes(), labels=np.zeros(5, np.int64).tobytes()) for i in range(6)]
    E._group_arrays(2, 1, [np.array([0])])((0, 1), E.pd.DataFrame(rows))
    assert len(made) == 9


def test_checks_of_the_hierarchy_look_at_distances_once(spark, monkeypatch, tmp_path):
    from larder.plans import checked as C
    from larder.plans.registry import QUERIES

    seen, near, trees = [], H.neighbour_distances, H.spanning_trees
    monkeypatch.setattr(H, "neighbour_distances", lambda *a, **b: seen.append("near") or near(*a, **b))
    monkeypatch.setattr(H, "spanning_trees", lambda *a, **b: seen.append("trees") or trees(*a, **b))
    x = np.concatenate([np.random.default_rng(7).normal(c, 0.5, (60, 2)) for c in (0, 6)])
    monkeypatch.setattr(C.B, "vectors", lambda *_: frame(spark, x))
    assert all(r.passed for r in QUERIES["hdbscan_checks"](spark, str(tmp_path)).collect())
    assert sorted(seen) == ["near", "trees"]
