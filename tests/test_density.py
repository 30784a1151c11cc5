import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.operators import blocks as BL
from larder.operators import density as D
from larder.operators import evaluation as E
from larder.operators import hierarchy as H
from larder.operators.components import connected_components
from tests import brute


def groups(n=260, seed=1, d=3, copies=0):
    rng = np.random.default_rng(seed)
    centres = rng.uniform(-8, 8, size=(6, d))
    x = centres[rng.integers(0, 6, n)] + rng.normal(0, 0.6, size=(n, d)) * rng.choice([0.4, 1.0, 1.8], size=(n, 1))
    x[: n // 20] = rng.uniform(-30, 30, size=(n // 20, d))
    if copies:
        x[rng.choice(n, copies, replace=False)] = x[n // 2]
    return x


def frame(spark, x):
    rows = [(int(i), [float(v) for v in p]) for i, p in enumerate(x)]
    return spark.createDataFrame(rows, "row_id long, features array<double>")


def labels_of(df, n, col="cluster_label"):
    out = np.full(n, -99)
    for r in df.collect():
        out[r["row_id"]] = r[col]
    return out


@pytest.mark.parametrize("copies", [90])
def test_dbscan_grid_equals_brute_force(spark, copies):
    x = groups(copies=copies)
    grid = [(0.5, 5), (0.9, 5), (0.9, 12), (1.5, 8)]
    got = D.dbscan_trials(frame(spark, x), grid, block_rows=37).toPandas()
    for t, (eps, least) in enumerate(grid):
        mine = got[got.trial == t].sort_values("row_id")["cluster_label"].to_numpy()
        assert (mine == brute.dbscan(x, eps, least)).all()


def test_neighbour_counts_on_a_lattice_keep_the_border(spark):
    x = np.array([[i * 0.1, j * 0.1] for i in range(12) for j in range(12)])
    got = labels_of(D.eps_neighbours(frame(spark, x), 0.2, block_rows=20), len(x), "n_neighbours")
    want = (brute.distances(x) <= 0.2).sum(axis=1)
    assert (got == want).all()


@pytest.mark.parametrize("copies,block_rows,mcs", [(0, None, 5), (90, 25, 8)])
def test_hdbscan_equals_brute_force(spark, copies, block_rows, mcs):
    x = groups(n=220, seed=3, copies=copies)
    got = labels_of(H.hdbscan(frame(spark, x), mcs, block_rows=block_rows), len(x))
    assert (got == brute.hdbscan(x, mcs)).all()


def test_hdbscan_tree_does_not_depend_on_the_bands(spark):
    """A tree over many leaves, put together in one band and in many."""
    rng = np.random.default_rng(12)
    x = np.concatenate([rng.normal(c, 0.05 + 0.02 * k, (14, 2)) for k, c in enumerate(rng.uniform(-6, 6, (9, 2)))])
    want = brute.hdbscan(x, 5)
    assert want.max() >= 3
    for band in (100_000, 25):
        assert (labels_of(H.hdbscan(frame(spark, x), 5, band_events=band), len(x)) == want).all()



def test_core_distances(spark):
    x = groups(n=150, seed=5, copies=30)
    points = BL.distinct_points(frame(spark, x))
    cores, _, _ = H.core_distances(points, 7, block_rows=25)
    want = np.sort(brute.distances(x), axis=1)[:, 6]
    for r in cores.collect():
        assert r["core"] == pytest.approx(want[r["pid"]], abs=1e-9)


@pytest.mark.parametrize("copies", [0, 80])
def test_silhouette_equals_brute_force(spark, copies):
    x = groups(n=180, seed=2, copies=copies)
    a, b = brute.dbscan(x, 1.0, 5), np.arange(len(x)) % 7
    b[3] = 99
    b[x.shape[0] // 2] = 1
    df = frame(spark, x)
    pairs = spark.createDataFrame([(i, [int(a[i]), int(b[i])]) for i in range(len(x))], "row_id long, labels array<bigint>")
    got = {r["trial"]: r["silhouette"] for r in E.silhouette_exact(df.join(pairs, "row_id"), block_rows=31).collect()}
    assert got[0] == pytest.approx(brute.silhouette(x, a), abs=1e-9)
    assert got[1] == pytest.approx(brute.silhouette(x, b), abs=1e-9)


def test_silhouette_without_noise_and_with_one_label(spark):
    x = groups(n=120, seed=4)
    a = brute.dbscan(x, 1.0, 5)
    rows = frame(spark, x)
    lab = spark.createDataFrame([(i, [int(v)]) for i, v in enumerate(a)], "row_id long, labels array<bigint>")
    got = E.silhouette_exact(rows.join(lab, "row_id"), exclude_noise=True).first()["silhouette"]
    assert got == pytest.approx(brute.silhouette(x[a >= 0], a[a >= 0]), abs=1e-9)
    one = rows.withColumn("labels", F.array(F.lit(0)))
    assert E.silhouette_exact(one).first()["silhouette"] is None


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(100, i) for i in range(101, 160)]
    edges = spark.createDataFrame([(u, v) for u, v in chain + star], "u long, v long")
    nodes = spark.createDataFrame([(i,) for i in [*range(0, 61), *range(100, 160), 500]], "node long")
    got = {r["node"]: r["component"] for r in connected_components(edges, nodes, []).collect()}
    assert {got[i] for i in range(61)} == {0}
    assert {got[i] for i in range(100, 160)} == {100}
    assert got[500] == 500
