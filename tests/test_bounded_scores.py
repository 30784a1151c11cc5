"""Silhouettes of many clusters, and neighbours within several distances at once."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.operators import blocks as BL
from larder.operators import clustering as K
from larder.operators import evaluation as E
from tests import brute
from tests.test_density import frame, groups


def labelled(spark, x, columns):
    rows = [(i, [int(c[i]) for c in columns]) for i in range(len(x))]
    return frame(spark, x).join(spark.createDataFrame(rows, "row_id long, labels array<bigint>"), "row_id")


@pytest.mark.parametrize("held", [60, 1 << 23])
def test_many_clusters_are_scored_by_a_stream_of_blocks(spark, monkeypatch, held):
    """No rows by point and cluster leave a task, whatever the number of clusters; with few sums held a block is cut into slices."""
    x = groups(n=180, seed=3, copies=40)
    columns = [brute.dbscan(x, 1.0, 5), np.arange(len(x)) // 3, np.arange(len(x)) % 5]
    columns = [c[np.unique(x, axis=0, return_inverse=True)[1].ravel()] if k else c for k, c in enumerate(columns)]
    monkeypatch.setattr(E, "ARRAY_CLUSTERS", 10)
    monkeypatch.setattr(E, "HELD_SUMS", held)
    seen, stream = [], E._scored_in_a_stream
    monkeypatch.setattr(E, "_scored_in_a_stream", lambda *a: seen.append(stream(*a)) or seen[-1])
    got = {r["trial"]: r["silhouette"] for r in E.silhouette_exact(labelled(spark, x, columns), block_rows=31).collect()}
    for t, c in enumerate(columns):
        assert got[t] == pytest.approx(brute.silhouette(x, c), abs=1e-9)
    assert seen[0].columns == ["trial", "score", "n"]
    assert seen[0].count() <= len(columns) * (4 if held > 60 else len(x))


def test_a_block_is_summed_by_its_own_clusters():
    labels = np.repeat([[7, 1, 4], [7, 2, 4]], 50, axis=0)
    found, member, spread = E._membership(labels, np.ones(100))
    assert found == [(0, 7), (1, 1), (1, 2), (2, 4)] and member.shape == (100, 2)
    far = np.random.default_rng(1).random((9, 100))
    want = np.array([far[:, labels[:, t] == c].sum(axis=1) for t, c in found])
    assert E._sums_by_cluster(far, member, spread) == pytest.approx(want)


@pytest.mark.parametrize("apart", [0.0, 3.0, 50.0])
def test_neighbours_within_several_distances(apart):
    rng = np.random.default_rng(8)
    a, b = rng.normal(size=(700, 4)), rng.normal(size=(300, 4))
    a[:350] += apart
    a[3], b[5] = 0.0, [1.5, 0.0, 0.0, 0.0]
    eps = [0.1, 1.5, 6.0]
    far = np.sqrt(((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2))
    for weights in (np.ones(700), rng.integers(1, 4, 700).astype(float)):
        for e, close in zip(eps, BL.within_each(a, b, eps), strict=True):
            want = far <= e
            assert (close is None) == (not want.any())
            if close is not None:
                assert (close == want).all()
                of_a, of_b = BL.close_sums(close, weights, weights[:300])
                assert (of_a == want @ weights[:300]).all() and (of_b == weights @ want).all()


def test_steps_of_kmeans_use_all_slots(spark):
    x = np.random.default_rng(2).normal(size=(500, 3))
    rows = K.Rows(frame(spark, x).coalesce(1), "features")
    parts = rows.blocks.agg(F.count(F.lit(1)).alias("blocks"), F.max("n").alias("most")).first()
    assert rows.n == 500 and parts["blocks"] >= 4 and parts["most"] < 250


def test_sums_of_all_fits_go_to_the_first_nearest_centre():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 4, (300, 2)).astype(float)
    fits = [x[:5].copy(), np.array([[1.0, 1.0], [1.0, 1.0], [3.0, 0.0]]), np.array([[0.0, 0.0], [2.0, 0.0]])]
    every = np.concatenate(fits)
    turned = np.concatenate([-2.0 * every, (every * every).sum(axis=1)[:, None]], axis=1)
    got = K._nearest_sums(x, turned, np.array([0, 5, 8]), [5, 3, 2])
    sums, at = got[3:].reshape(-1, 3), 0
    for f, centres in enumerate(fits):
        far = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
        label = far.argmin(axis=1)
        assert got[f] == pytest.approx(far.min(axis=1).sum())
        for k in range(len(centres)):
            assert sums[at + k] == pytest.approx([*x[label == k].sum(axis=0), (label == k).sum()])
        at += len(centres)
