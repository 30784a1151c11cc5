"""K-Means and Gaussian mixture sweeps, all fits of a sweep in the same scans, and assignment to given centres."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.operators.evaluation import EUCLIDEAN, mean_silhouettes
from larder.session import cut

# Fixed values.
SEED = 42
RESTARTS = 10
KMEANS_GRID = range(2, 11)
REFINED_KMEANS_GRID = range(10, 26)
GMM_GRID = range(2, 11)
MAX_ITER = 300
TOLERANCE = 1e-4
# Added to the variances of a mixture's components.
REGULARISATION = 1e-6
# Rows of a block, rows that starts are drawn from, and arrays that one task adds up at most.
PACKED_ROWS, SEED_ROWS, GROUPS = 4096, 4096, 32
# Rows whose densities are worked out together, and distances to centres that are, so that they stay in the cache.
STRIP, STRIP_CELLS = 512, 180_000

RESULT_SCHEMA = (
    "trial_no int, paradigm string, params string, silhouette double, metric double, n_clusters bigint, noise_ratio double, "
    "distance string"
)


@dataclass
class Sweep:
    """Fitted models of a sweep, the labels of every row by trial, and one result row per trial."""

    models: list
    labelled: DataFrame
    results: DataFrame


@dataclass
class Centres:
    """One K-Means fit: its centres and the sum of squared distances to the nearest of them."""

    centres: np.ndarray
    cost: float
    iterations: int


@dataclass
class Mixture:
    """One Gaussian mixture: weights, means, covariances, and the log likelihood of all rows under them."""

    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray
    log_likelihood: float
    iterations: int


def _lists(values: pa.Array, size: int) -> pa.Array:
    """``values`` in lists of ``size``."""
    return pa.ListArray.from_arrays(pa.array(np.arange(0, len(values) + 1, max(1, size), dtype=np.int32)), values)


def _dealt_out(df: DataFrame) -> DataFrame:
    """``df``, dealt out evenly where a part has more than twice a slot's share of the rows: every step of a sweep takes as long as its largest part."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    parts = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("most"), F.sum("n").alias("n")).first()
    even = not parts["n"] or parts["most"] * slots <= 2 * parts["n"] or parts["most"] <= slots
    return df if even else df.repartition(max(slots, df.rdd.getNumPartitions()), "row_id")


class Rows:
    """Rows packed into blocks that every step of a sweep reads; written once."""

    def __init__(self, df: DataFrame, features: str) -> None:
        self.spark = df.sparkSession
        self.kind = df.schema["row_id"].dataType.simpleString()

        def pack(batches):
            for batch in batches:
                for at in range(0, batch.num_rows, PACKED_ROWS):
                    part = batch.slice(at, PACKED_ROWS)
                    if part.column(1).null_count or len(pc.unique(pc.list_value_length(part.column(1)))) > 1:
                        raise ValueError("rows without features or of several widths")
                    coords = part.column(1).flatten().to_numpy(zero_copy_only=False)
                    made = [_lists(part.column(0), part.num_rows), pa.array([coords.tobytes()], pa.binary()), pa.array([part.num_rows], pa.int32())]
                    yield pa.RecordBatch.from_arrays(made, ["ids", "coords", "n"])

        doubles = F.col(features).cast("array<double>").alias("features")
        packed = _dealt_out(df.select("row_id", doubles)).mapInArrow(pack, f"ids array<{self.kind}>, coords binary, n int")
        self.blocks = cut(packed)
        known = self.blocks.agg(F.sum("n").alias("n"), F.max(F.octet_length("coords") / 8 / F.col("n")).alias("d")).first()
        self.n, self.width = known["n"] or 0, int(known["d"] or 0)
        self.n_parts = self.blocks.rdd.getNumPartitions()

    def added_up(self, sums: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
        """The sum over all blocks of an array of ``size`` numbers that ``sums`` makes of a block's rows: added up in each task, then by groups of
        tasks, then those groups in one, so that one array comes to the driver however many tasks there are."""
        width = self.width

        def partial(batches):
            total = None
            for batch in batches:
                for data in batch.column(0):
                    made = sums(np.frombuffer(data.as_buffer(), np.float64).reshape(-1, width))
                    total = made if total is None else total + made
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

        def group(pdf: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"part": [sum(np.frombuffer(p, np.float64) for p in pdf["part"]).tobytes()]})

        def last(batches):
            total = None
            for pdf in batches:
                made = sum(np.frombuffer(p, np.float64) for p in pdf["part"])
                total = made if total is None else total + made
            if total is not None:
                yield pd.DataFrame({"part": [total.tobytes()]})

        parts = self.blocks.select("coords").mapInArrow(partial, "part binary")
        if self.n_parts > GROUPS:
            parts = parts.groupBy(F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("g")).applyInPandas(group, "part binary")
        if self.n_parts > 1:
            parts = parts.repartition(1).mapInPandas(last, "part binary")  # GROUPS rows at most
        out = np.zeros(size)
        for row in parts.collect():
            out += np.frombuffer(bytes(row["part"]), np.float64)
        return out

    def labelled(self, label: Callable[[np.ndarray], np.ndarray], with_features: bool = True) -> DataFrame:
        """(row_id, features, labels): every labelling of every row, in one scan. Without features they do not leave the task."""
        width = self.width

        def run(batches):
            for batch in batches:
                for ids, data in zip(batch.column(0), batch.column(1), strict=True):
                    x = np.frombuffer(data.as_buffer(), np.float64).reshape(-1, width)
                    labels = np.asarray(label(x), np.int64)
                    made = {"row_id": ids.values, "features": _lists(pa.array(x.ravel()), width), "labels": _lists(pa.array(labels.ravel()), labels.shape[1])}
                    names = [name for name in made if with_features or name != "features"]
                    yield pa.RecordBatch.from_arrays([made[name] for name in names], names)

        schema = f"row_id {self.kind}, {'features array<double>, ' if with_features else ''}labels array<bigint>"
        return self.blocks.select("ids", "coords").mapInArrow(run, schema)


def _spread_centres(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Start of a fit: rows of the sample, each next one drawn by its squared distance to those before."""
    rng = np.random.default_rng(seed)
    chosen = [sample[rng.integers(len(sample))]]
    near = ((sample - chosen[0]) ** 2).sum(axis=1)
    while len(chosen) < k:
        total = near.sum()
        at = rng.choice(len(sample), p=near / total) if total > 0 else rng.integers(len(sample))
        chosen.append(sample[at])
        near = np.minimum(near, ((sample - chosen[-1]) ** 2).sum(axis=1))
    return np.array(chosen)


def _nearest(x: np.ndarray, fits: Sequence[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Nearest centre (the first among equals) and squared distance under each fit, from one matrix product."""
    every = np.concatenate(fits)
    far = (every * every).sum(axis=1)[None, :] - 2.0 * (x @ every.T)
    own, out, at = (x * x).sum(axis=1), [], 0
    for centres in fits:
        part = far[:, at : at + len(centres)]
        label = part.argmin(axis=1)
        out.append((label, np.maximum(part[np.arange(len(x)), label] + own, 0.0)))
        at += len(centres)
    return out


def _moved_on(rows: Rows, fits: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray], list[float]]:
    """Sums and counts of the rows nearest to each centre, and the cost, for all fits in one scan."""
    width, sizes = rows.width, [len(c) for c in fits]
    every, starts = np.concatenate(fits), np.cumsum([0, *sizes[:-1]])
    turned = np.concatenate([-2.0 * every, (every * every).sum(axis=1)[:, None]], axis=1)
    flat = rows.added_up(lambda x: _nearest_sums(x, turned, starts, sizes), len(fits) + len(every) * (width + 1))
    costs, sums = flat[: len(fits)], flat[len(fits) :].reshape(-1, width + 1)
    parts = np.split(sums, starts[1:])
    return [p[:, :-1] for p in parts], [p[:, -1] for p in parts], [float(c) for c in costs]


def _nearest_sums(x: np.ndarray, turned: np.ndarray, starts: np.ndarray, sizes: list[int]) -> np.ndarray:
    """The cost of every fit, then for every centre of all fits the sums of its rows' coordinates and their number; a row belongs to the first nearest
    centre of a fit. ``turned`` holds -2 times each centre and its square, so that one product ranks the centres of all fits."""
    with_one, own = np.concatenate([x, np.ones((len(x), 1))], axis=1), (x * x).sum(axis=1)
    fit = np.repeat(np.arange(len(sizes)), sizes)
    costs, sums = np.zeros(len(sizes)), np.zeros((len(turned), x.shape[1] + 1))
    strip = max(64, STRIP_CELLS // len(turned))
    for at in range(0, len(x), strip):
        part = with_one[at : at + strip]
        far = turned @ part.T
        least = np.minimum.reduceat(far, starts, axis=0)
        nearest = far == least[fit]
        if np.count_nonzero(nearest) != least.size:
            # Equals: the first of them.
            for f, row in zip(*np.nonzero(np.add.reduceat(nearest, starts, axis=0, dtype=np.int64) != 1)):
                among = slice(starts[f], starts[f] + sizes[f])
                nearest[among, row] = np.arange(sizes[f]) == far[among, row].argmin()
        sums += nearest.astype(np.float64) @ part
        costs += np.maximum(least + own[at : at + strip], 0.0).sum(axis=1)
    return np.concatenate([costs, sums.ravel()])


def fit_kmeans_all(rows: Rows, starts: Sequence[tuple[int, int]], max_iter: int = MAX_ITER, tolerance: float = TOLERANCE) -> list[Centres]:
    """K-Means for every (k, seed) at the same time: a scan moves the centres of all fits that have not come to rest, so there are as many
    scans as the longest fit has steps, and one for the costs.

    Each start is drawn from the ``SEED_ROWS`` rows of the smallest hashes of their ids; all steps see all rows. A centre without rows stays where it is.
    """
    sample = rows.blocks.select(F.posexplode("ids").alias("at", "id"), "coords").select(
        F.xxhash64("id").alias("hash"), "id", F.substring("coords", F.col("at") * (8 * rows.width) + 1, F.lit(8 * rows.width)).alias("x")
    )
    drawn = [np.frombuffer(bytes(r["x"]), np.float64) for r in sample.orderBy("hash", "id").limit(SEED_ROWS).collect()]
    if not drawn:
        raise ValueError("no rows to fit")
    return lloyd(rows, [_spread_centres(np.array(drawn), k, seed) for k, seed in starts], max_iter, tolerance)


def lloyd(rows: Rows, starts: Sequence[np.ndarray], max_iter: int = MAX_ITER, tolerance: float = TOLERANCE) -> list[Centres]:
    """K-Means from the given centres, all fits in the same scans; one whose centres all move by ``tolerance`` at most is at rest."""
    fits = [np.asarray(c, np.float64) for c in starts]
    moving, steps = list(range(len(fits))), [0] * len(fits)
    while moving:
        totals, counts, _ = _moved_on(rows, [fits[i] for i in moving])
        still = []
        for i, total, count in zip(moving, totals, counts, strict=True):
            moved = np.where(count[:, None] > 0, total / np.maximum(count, 1.0)[:, None], fits[i])
            steps[i] += 1
            if steps[i] < max_iter and (((moved - fits[i]) ** 2).sum(axis=1) > tolerance**2).any():
                still.append(i)
            fits[i] = moved
        moving = still
    return [Centres(c, cost, n) for c, cost, n in zip(fits, _moved_on(rows, fits)[2], steps, strict=True)]


def nearest_labels(rows: Rows, models: Sequence[Centres], with_features: bool = True) -> DataFrame:
    """(row_id, features, labels): the number of the nearest centre in every fit."""
    centres = [m.centres for m in models]
    return rows.labelled(lambda x: np.stack([label for label, _ in _nearest(x, centres)], axis=1), with_features)


def kmeans_sweep(
    df: DataFrame, grid: Iterable[int] = KMEANS_GRID, restarts: int = RESTARTS, features: str = "features", distance: str = EUCLIDEAN
) -> Sweep:
    """K-Means for every k, the best of several starts by inertia, scored by silhouette."""
    grid = list(grid)
    rows = Rows(df, features)
    fits = fit_kmeans_all(rows, [(k, SEED + i) for k in grid for i in range(restarts)])
    models = [min(fits[t * restarts : (t + 1) * restarts], key=lambda m: m.cost) for t in range(len(grid))]
    labelled = nearest_labels(rows, models)
    scores = mean_silhouettes(labelled, len(grid), distance)
    found = [(i, "K-Means", f"k={k}", s, m.cost, k, 0.0, distance) for i, (k, m, s) in enumerate(zip(grid, models, scores, strict=True))]
    return Sweep(models, labelled, df.sparkSession.createDataFrame(found, RESULT_SCHEMA))


def mixture_bic(log_likelihood: float, k: int, d: int, n: int) -> float:
    """-2 log L + p ln n with the free parameters of k full-covariance components."""
    p = (k - 1) + k * d + k * d * (d + 1) // 2
    return -2.0 * log_likelihood + p * math.log(n)


def _log_densities(x: np.ndarray, mixture: tuple) -> np.ndarray:
    """Log of weight times density of every row under each component."""
    log_weights, means, factors, log_dets = mixture
    out = np.empty((len(x), len(means)))
    for at in range(0, len(x), STRIP):
        part = x[at : at + STRIP]
        for j, (mean, factor) in enumerate(zip(means, factors, strict=True)):
            y = (part - mean) @ factor
            out[at : at + STRIP, j] = np.einsum("ij,ij->i", y, y)
    return log_weights + log_dets - 0.5 * (x.shape[1] * math.log(2 * math.pi) + out)


def _shares(logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each component's share of each row, and the row's log likelihood."""
    top = logs.max(axis=1, keepdims=True)
    parts = np.exp(logs - top)
    total = parts.sum(axis=1, keepdims=True)
    return parts / total, (top + np.log(total))[:, 0]


def _statistics(x: np.ndarray, shares: np.ndarray) -> list[np.ndarray]:
    roots, seconds = np.sqrt(shares), []
    for j in range(shares.shape[1]):
        some = np.flatnonzero(shares[:, j])
        part = (x if len(some) == len(x) else x[some]) * roots[some, j : j + 1]
        seconds.append((part.T @ part).ravel())  # one half of a symmetric product
    return [shares.sum(axis=0), (shares.T @ x).ravel(), *seconds]


def _from_statistics(flat: np.ndarray, k: int, d: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = flat[:k] + 10 * np.finfo(float).eps
    means = flat[k : k + k * d].reshape(k, d) / sizes[:, None]
    seconds = flat[k + k * d :].reshape(k, d, d) / sizes[:, None, None]
    covariances = seconds - means[:, :, None] * means[:, None, :]
    covariances[:, np.arange(d), np.arange(d)] += REGULARISATION
    return sizes / n, means, covariances


def _ready(weights: np.ndarray, means: np.ndarray, covariances: np.ndarray) -> tuple:
    """A mixture in the form that tasks work with: factors of the inverse covariances and logs of their determinants."""
    factors, log_dets = [], []
    for c in covariances:
        values, vectors = np.linalg.eigh(c)
        values = np.maximum(values, REGULARISATION)
        factors.append(vectors / np.sqrt(values))
        log_dets.append(-0.5 * np.log(values).sum())
    return np.log(weights), means, factors, np.array(log_dets)


def fit_mixtures(rows: Rows, grid: Sequence[int], max_iter: int = 100, tolerance: float = 1e-3) -> list[Mixture]:
    """Gaussian mixtures with full covariance for every number of components at the same time: a scan gathers the sufficient statistics of all of them
    that still gain ``tolerance`` in mean log likelihood. Each starts from the labels of a K-Means fit."""
    d, n = rows.width, rows.n
    middle = rows.added_up(lambda x: x.sum(axis=0), d) / n  # products are taken around the overall mean
    starts = [m.centres for m in fit_kmeans_all(rows, [(k, SEED) for k in grid])]

    def hard(x: np.ndarray) -> np.ndarray:
        out = []
        for k, (label, _) in zip(grid, _nearest(x, starts), strict=True):
            out += _statistics(x - middle, np.eye(k)[label])
        return np.concatenate(out)

    sizes = [k * (1 + d + d * d) for k in grid]
    state, at = [], 0
    flat = rows.added_up(hard, sum(sizes))
    for k, size in zip(grid, sizes, strict=True):
        state.append(_from_statistics(flat[at : at + size], k, d, n))
        at += size
    before, found, steps = [-math.inf] * len(grid), [0.0] * len(grid), [0] * len(grid)
    moving = list(range(len(grid)))
    while moving:
        ready = [_ready(*state[i]) for i in moving]

        def soft(x: np.ndarray, ready=ready) -> np.ndarray:
            out, x = [], x - middle
            for mixture in ready:
                shares, logs = _shares(_log_densities(x, mixture))
                out += [[logs.sum()], *_statistics(x, shares)]
            return np.concatenate(out)

        flat, at, still = rows.added_up(soft, sum(1 + sizes[i] for i in moving)), 0, []
        for i in moving:
            found[i] = float(flat[at])
            steps[i] += 1
            # At rest the parameters stay those of this scan, whose likelihood is known.
            if steps[i] < max_iter and found[i] / n - before[i] >= tolerance:
                before[i] = found[i] / n
                state[i] = _from_statistics(flat[at + 1 : at + 1 + sizes[i]], grid[i], d, n)
                still.append(i)
            at += 1 + sizes[i]
        moving = still
    return [Mixture(w, m + middle, c, logs, s) for (w, m, c), logs, s in zip(state, found, steps, strict=True)]


def gmm_sweep(df: DataFrame, grid: Iterable[int] = GMM_GRID, features: str = "features", distance: str = EUCLIDEAN, max_iter: int = 100) -> Sweep:
    """Gaussian mixtures with full covariance, scored by silhouette, with their BIC."""
    grid = list(grid)
    rows = Rows(df, features)
    models = fit_mixtures(rows, grid, max_iter)
    ready = [_ready(m.weights, m.means, m.covariances) for m in models]
    labelled = rows.labelled(lambda x: np.stack([_log_densities(x, m).argmax(axis=1) for m in ready], axis=1))
    scores = mean_silhouettes(labelled, len(grid), distance)
    found = [
        (i, "GMM", f"components={k}", s, mixture_bic(m.log_likelihood, k, rows.width, rows.n), k, 0.0, distance)
        for i, (k, m, s) in enumerate(zip(grid, models, scores, strict=True))
    ]
    return Sweep(models, labelled, df.sparkSession.createDataFrame(found, RESULT_SCHEMA))


def assign_to_centres(df: DataFrame, centres: np.ndarray, features: str = "features") -> DataFrame:
    """Nearest given centre (the first among equals) and the squared distance; the k x d centres travel with the task."""
    centres = np.asarray(centres, dtype=np.float64)
    norms = (centres * centres).sum(axis=1)

    def assign(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            x = np.array(pdf["features"].tolist(), dtype=np.float64)
            best = (norms[None, :] - 2.0 * (x @ centres.T)).argmin(axis=1)
            diff = x - centres[best]
            yield pd.DataFrame(
                {"row_id": pdf["row_id"], "cluster_label": best.astype(np.int32), "sq_distance": (diff * diff).sum(axis=1)}
            )

    return df.select("row_id", F.col(features).alias("features")).mapInPandas(
        assign, "row_id long, cluster_label int, sq_distance double"
    )


def union_results(sweeps: list[DataFrame]) -> DataFrame:
    """Result rows of several sweeps, numbered in order."""
    offset, parts = 0, []
    for results in sweeps:
        parts.append(results.withColumn("trial_no", F.col("trial_no") + offset))
        offset += results.count()
    return reduce(DataFrame.unionByName, parts)
