"""K-Means and mixture sweeps against plainly written versions; crowds, sizes and bands of the density operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.operators import blocks as BL
from larder.operators import clustering as K
from larder.operators import density as D
from larder.operators import hierarchy as H
from tests import brute


def frame(spark, x):
    return spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "row_id long, features array<double>")


def points(seed, n=120):
    rng = np.random.default_rng(seed)
    return np.concatenate([rng.normal(0, 1, (n, 3)), rng.normal(6, 0.5, (n, 3)), rng.normal((0, 8, 0), 1.5, (n, 3))])


def lloyd(x, start):
    centres = start.copy()
    for _ in range(K.MAX_ITER):
        label = ((x[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        moved = np.array([x[label == j].mean(axis=0) if (label == j).any() else centres[j] for j in range(len(centres))])
        far = ((moved - centres) ** 2).sum(axis=1)
        centres = moved
        if not (far > K.TOLERANCE**2).any():
            break
    return centres, ((x[:, None] - centres[None]) ** 2).sum(axis=2).min(axis=1).sum()


@pytest.mark.parametrize("block", [37, 4096])
def test_every_fit_of_a_sweep_is_a_plain_fit(spark, monkeypatch, block):
    monkeypatch.setattr(K, "PACKED_ROWS", block)
    x = points(1)
    df = frame(spark, x).repartition(5)
    rows = K.Rows(df, "features")
    starts = [(k, K.SEED + i) for k in (2, 3, 5) for i in range(3)]
    fits = K.fit_kmeans_all(rows, starts)
    order = [r.row_id for r in df.orderBy(F.xxhash64("row_id"), "row_id").collect()]
    for (k, seed), fit in zip(starts, fits, strict=True):
        centres, cost = lloyd(x, K._spread_centres(x[order], k, seed))
        assert np.allclose(fit.centres, centres, atol=1e-9) and fit.cost == pytest.approx(cost, rel=1e-9)


def test_a_step_is_one_scan(spark, monkeypatch):
    rows = K.Rows(frame(spark, points(2)), "features")
    scans = []
    added = K.Rows.added_up
    monkeypatch.setattr(K.Rows, "added_up", lambda self, *a: scans.append(1) or added(self, *a))
    fits = K.fit_kmeans_all(rows, [(k, i) for k in range(2, 8) for i in range(4)])
    assert len(scans) == max(f.iterations for f in fits) + 1


def test_partial_sums_are_added_in_groups(spark, monkeypatch):
    monkeypatch.setattr(K, "GROUPS", 3)
    x = points(3)
    rows = K.Rows(frame(spark, x).repartition(9), "features")
    assert np.allclose(rows.added_up(lambda y: y.sum(axis=0), 3), x.sum(axis=0))


def plain_mixture(x, k, start, max_iter=100):
    n, d = x.shape
    share = np.eye(k)[((x[:, None] - start[None]) ** 2).sum(axis=2).argmin(axis=1)]
    before = -np.inf
    for step in range(max_iter + 1):
        if step:
            logs = np.empty((n, k))
            for j in range(k):
                diff = x - means[j]
                logs[:, j] = np.log(weights[j]) - 0.5 * (d * np.log(2 * np.pi) + np.linalg.slogdet(covs[j])[1] + (diff @ np.linalg.inv(covs[j]) * diff).sum(axis=1))
            total = np.logaddexp.reduce(logs, axis=1)
            if total.mean() - before < 1e-3:
                return total.sum(), logs.argmax(axis=1)
            before, share = total.mean(), np.exp(logs - total[:, None])
        sizes = share.sum(axis=0)
        weights, means = sizes / n, (share.T @ x) / sizes[:, None]
        covs = [((x - means[j]) * share[:, j : j + 1]).T @ (x - means[j]) / sizes[j] + np.eye(d) * K.REGULARISATION for j in range(k)]
    return total.sum(), logs.argmax(axis=1)


def test_mixtures_equal_plain_expectation_maximisation(spark):
    x = points(4) + 100.0
    rows = K.Rows(frame(spark, x).repartition(4), "features")
    grid = [1, 2, 4]
    found = K.fit_mixtures(rows, grid)
    starts = [m.centres for m in K.fit_kmeans_all(rows, [(k, K.SEED) for k in grid])]
    for k, fit, start in zip(grid, found, starts, strict=True):
        want, label = plain_mixture(x, k, start)
        assert fit.log_likelihood == pytest.approx(want, rel=1e-6)
        ready = K._ready(fit.weights, fit.means, fit.covariances)
        assert (K._log_densities(x, ready).argmax(axis=1) == label).mean() > 0.99


def test_singular_data_have_a_mixture(spark):
    x = np.concatenate([np.zeros((20, 2)), np.ones((20, 2))])
    found = K.gmm_sweep(frame(spark, x), [2]).results.first()
    assert np.isfinite(found.metric) and found.silhouette == pytest.approx(1.0)


def labels_of(df, n, trial):
    got = {r.row_id: r.cluster_label for r in df.filter(F.col("trial") == trial).collect()}
    assert len(got) == n
    return np.array([got[i] for i in range(n)])


@pytest.mark.parametrize("crowd", [40, 1024])
def test_crowds_change_nothing(spark, crowd):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(0, 0.02, (300, 2)), rng.normal(1.2, 0.02, (200, 2)), rng.normal(0, 1, (80, 2)), rng.normal(4, 0.4, (90, 2))])
    grid = [(0.3, 5), (0.3, 20), (0.9, 8)]
    found = D.dbscan_trials(frame(spark, x), grid, block_rows=64, crowd=crowd).collect()
    for t, (eps, least) in enumerate(grid):
        got = {r.row_id: r.cluster_label for r in found if r.trial == t}
        assert (np.array([got[i] for i in range(len(x))]) == brute.dbscan(x, eps, least)).all()


def test_a_crowd_takes_no_distances(spark, monkeypatch):
    """50,000 distinct points narrower than eps: no two of their blocks are paired."""
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.uniform(0, 0.01, (50_000, 3)), rng.uniform(50, 90, (50, 3))])
    points_ = BL.distinct_points(frame(spark, x))
    homes = D.crowds(points_, 0.5, 15)
    assert homes.count() == 50_000 and homes.select("home").distinct().count() == 1
    _, packed, pairs = D.neighbour_counts(points_, [0.5], homes=homes)
    in_crowd = packed.filter("crowd").select("block")
    assert in_crowd.count() >= 50_000 // BL.BLOCK_ROWS
    assert pairs.join(in_crowd, F.col("a") == F.col("block")).count() == 0
    found = {r.cluster_label: r["count"] for r in D.dbscan(frame(spark, x), 0.5, 15).groupBy("cluster_label").count().collect()}
    assert found == {0: 50_000, -1: 50}


def copied(seed):
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(c, 0.2 + 0.1 * k, (40, 2)) for k, c in enumerate([(0, 0), (4, 0), (0, 5), (7, 7)])])
    return np.concatenate([x, x[:30], np.tile(x[50], (12, 1)), rng.uniform(-3, 10, (30, 2))])


@pytest.mark.parametrize("band,forest", [(200_000, 1_000_000), (60, 0)])
def test_all_sizes_at_once_equal_brute_force(spark, monkeypatch, band, forest):
    """With copies, in one band and in many, and with trees joined in rounds."""
    monkeypatch.setattr(H, "FOREST_EDGES", forest)
    x = copied(7)
    sizes = [4, 8, 15]
    found = H.hdbscan_trials(frame(spark, x), sizes, block_rows=64, band_events=band).cache()
    for t, size in enumerate(sizes):
        assert (labels_of(found, len(x), t) == brute.hdbscan(x, size)).all(), size


def test_a_chain_of_clusters_over_many_bands(spark):
    """Each next cluster is farther away: a tree as deep as it has leaves, whose worth goes through every band."""
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal((1.35**k, 0), 0.02, (8, 2)) for k in range(2, 16)])
    want = brute.hdbscan(x, 5)
    assert want.max() >= 5
    assert (labels_of(H.hdbscan_trials(frame(spark, x), [5], band_events=25), len(x), 0) == want).all()


def test_all_sizes_share_their_distances(spark):
    x = copied(9)
    points_ = BL.distinct_points(frame(spark, x))
    cores, _, _ = H.neighbour_distances(points_, [3, 10, 25], block_rows=64)
    want = np.sort(brute.distances(x), axis=1)
    for r in points_.to_rows(cores.select("pid", "cores")).collect():
        assert np.allclose(r.cores, want[r.row_id][[2, 9, 24]], atol=1e-9)


def test_one_array_comes_to_the_driver(spark, monkeypatch):
    x = points(3)
    rows = K.Rows(frame(spark, x).repartition(7), "features")
    kind, seen = type(rows.blocks), []
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda self: seen.append(collect(self)) or seen[-1])
    assert np.allclose(rows.added_up(lambda y: y.sum(axis=0), 3), x.sum(axis=0))
    assert rows.n_parts > 1 and [len(s) for s in seen] == [1]
