"""Distances by strips, neighbours told in single precision first, and pairs of groups dealt out evenly."""

import numpy as np
import pytest

from larder.operators import blocks as BL
from larder.operators import evaluation as E


def test_pairs_of_groups_go_round_the_tasks(spark):
    pairs = spark.createDataFrame([(a, b) for a in range(7) for b in range(a, 7)], "a long, b long")
    for tasks in (28, 10):
        got = [r["t"] for r in pairs.select(BL.pair_number("a", "b", 7, tasks).alias("t")).collect()]
        assert sorted(got) == sorted(i % tasks for i in range(28))


def test_tiles_are_spread_over_all_tasks(spark):
    blocks = spark.createDataFrame([(i, i) for i in range(60)], "block long, x long")
    pairs = BL.cut(spark.createDataFrame([(a, b) for a in range(60) for b in range(a, 60)], "a long, b long"))
    tiles = BL.in_tiles(pairs, blocks, ["x"])
    held = tiles.rdd.glom().map(lambda rows: (len({(r.tile_a, r.tile_b) for r in rows}), sum(len(r.meets) for r in rows))).collect()
    assert sum(met for _, met in held) == 60 * 61 // 2
    assert max(n for n, _ in held) == 1


@pytest.mark.parametrize("heavy", [False, True])
def test_sums_of_strips_are_those_of_all_distances(heavy):
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=(700, 5)), rng.normal(size=(400, 5))
    x[::9] = y[3]
    labels = {len(z): np.stack([np.arange(len(z)) // 200, np.arange(len(z)) // 37], axis=1) for z in (x, y)}
    weights = {n: rng.integers(1, 4, n).astype(float) if heavy else np.ones(n) for n in (700, 400)}
    far = np.sqrt(((x[:, None, :] - y[None, :, :]) ** 2).sum(axis=2))
    (fx, mx, sx), (fy, my, sy) = (E._membership(labels[n], weights[n]) for n in (700, 400))
    there, back = E._distance_sums(x, y, my, sy, mx)
    for found, got, spread, side, n in ((fy, there, sy, far, 400), (fx, back, sx, far.T, 700)):
        want = np.array([(side * weights[n])[:, labels[n][:, t] == c].sum(axis=1) for t, c in found])
        assert (got if spread is None else spread.T @ got) == pytest.approx(want, rel=1e-12)


@pytest.mark.parametrize("away", [0.0, 1e5])
def test_single_precision_leaves_close_calls_to_the_coordinates(monkeypatch, away):
    """On a lattice many pairs are exactly eps apart, or apart from it by less than single precision holds."""
    rng = np.random.default_rng(2)
    a = rng.integers(0, 4, (600, 6)).astype(float)
    b = rng.integers(0, 4, (500, 6)) + np.where(rng.random((500, 1)) < 0.5, 1e-9, 0.0)
    a[7] += away
    used, rough = [], BL.distance_strips
    monkeypatch.setattr(BL, "distance_strips", lambda *x: used.append(1) or rough(*x))
    far = np.sqrt(((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2))
    for e, close in zip((1.0, 2.0, 3.0), BL.within_each(a, b, (1.0, 2.0, 3.0)), strict=True):
        assert (close == (far <= e)).all()
    assert bool(used) == bool(away)
