"""Scores of labellings and the choice of a model."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.operators.blocks import STRIP, block_size, distance_strips, floats, ints, pair_number, squared_distances
from larder.operators.running import running_sums
from larder.session import broadcast_if_within, cut, parallelism, tasks_for

# Share of noise a density model may leave, by phase, and the least score of a refined k-means.
MAX_NOISE = {1: 0.60, 2: 0.20}
MIN_REFINED_KMEANS = 0.50
NO_MODEL = -1.0
# Distances that model choice can score with; the gates above are meant for the first.
EUCLIDEAN, SQUARED = "euclidean", "squared"
# Blocks of one group in a task, and clusters of all labellings up to which a point's sums are kept as an array; both bound a task's memory.
GROUP_BLOCKS, ARRAY_CLUSTERS = 16, 1024
# With more clusters: sums that a task holds at a time.
HELD_SUMS = 1 << 23
# Columns up to which sums are a matrix product; more are added up run by run.
FEW_COLUMNS = 6


def _pack_labelled(size: int):
    """Blocks of ``size`` rows of a task at most, in the order they come in."""

    def pack(batches):
        made = 0
        for pdf in batches:
            for at in range(0, len(pdf), size):
                part = pdf.iloc[at : at + size]
                yield pd.DataFrame(
                    [
                        {
                            "block": (int(part["part"].iloc[0]) << 32) + made,
                            "weights": part["weight"].to_numpy(np.float64).tobytes(),
                            "coords": np.array(part["features"].tolist(), dtype=np.float64).tobytes(),
                            "labels": np.array(part["labels"].tolist(), dtype=np.int64).tobytes(),
                        }
                    ]
                )
                made += 1

    return pack


def _held(trials: int):
    """(trial, cluster, at, n): the clusters of every block and their rows in it."""

    def count(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                labels, weights = ints(r.labels, trials), floats(r.weights)
                for t in range(trials):
                    known, where = np.unique(labels[:, t], return_inverse=True)
                    yield pd.DataFrame({"trial": np.int32(t), "cluster": known, "at": r.at, "n": np.bincount(where, weights)})

    return count


def _membership(labels: np.ndarray, weights: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray, np.ndarray | None]:
    """The (trial, cluster) of a block, the weights of its rows by column, and how columns add up to clusters.

    Columns are the clusters, or the runs of equal rows of labels where these are fewer (blocks are sorted by their labels): what is added up is as narrow
    as the block allows.
    """
    known = [np.unique(labels[:, t]) for t in range(labels.shape[1])]
    found = [(t, int(c)) for t, own in enumerate(known) for c in own]
    starts = np.cumsum([0, *map(len, known)])
    begins = np.concatenate([[True], (labels[1:] != labels[:-1]).any(axis=1)])
    kinds, kind, rows = labels[begins], np.cumsum(begins) - 1, np.arange(len(labels))
    if len(kinds) < len(found):
        member, spread = np.zeros((len(labels), len(kinds))), np.zeros((len(kinds), len(found)))
        member[rows, kind] = weights
        for t, own in enumerate(known):
            spread[np.arange(len(kinds)), starts[t] + np.searchsorted(own, kinds[:, t])] = 1.0
        return found, member, spread
    member = np.zeros((len(labels), len(found)))
    for t, own in enumerate(known):
        member[rows, starts[t] + np.searchsorted(own, labels[:, t])] = weights
    return found, member, None


def _sums_by_cluster(far: np.ndarray, member: np.ndarray, spread: np.ndarray | None) -> np.ndarray:
    """Sums of distances, a row for each cluster of the block that ``far`` leads to."""
    part = member.T @ far.T
    return part if spread is None else spread.T @ part


def _distance_sums(x: np.ndarray, y: np.ndarray, member: np.ndarray, spread: np.ndarray | None, own: np.ndarray | None = None):
    """Sums of the distances of the rows of x to those of y by column of y's membership, and with ``own`` of the rows of y to those of x by column of x's;
    strip by strip, so that the distances do not leave the cache."""
    there, back = np.empty((member.shape[1], len(x))), None if own is None else np.zeros((own.shape[1], len(y)))
    # Columns that are runs of single rows.
    runs = member.argmax(axis=0) if spread is not None and member.shape[1] > FEW_COLUMNS and member.max() == 1.0 else None
    for at, far in distance_strips(x, y) if len(x) > STRIP else [(0, squared_distances(x, y))]:
        np.sqrt(far, out=far)
        there[:, at : at + len(far)] = _sums_by_cluster(far, member, None) if runs is None else np.add.reduceat(far, runs, axis=1).T
        if own is not None:
            part = own[at : at + len(far)]
            used = np.flatnonzero(part.any(axis=0))
            back[used] += part[:, used].T @ far
    return there, back


def _silhouettes(a: np.ndarray, b: np.ndarray, n_own: np.ndarray) -> np.ndarray:
    top = np.maximum(a, b)
    return np.where((n_own > 1) & (top > 0) & np.isfinite(b), (b - a) / np.where(top > 0, top, 1.0), 0.0)


def _streamed_scores(width: int, trials: int, n_open: int):
    """(trial, score, n) of a group of rows that all blocks go by, in order: the sums of a cluster are held from its first block to its last one (there
    are ``n_open`` such clusters at most at a time), then become means, of which the own one and the least other one stay."""

    def finish(state):
        weights = state["weights"]
        if state["slots"]:
            raise RuntimeError(f"{len(state['slots'])} clusters without an end")
        for t in range(trials):
            s = _silhouettes(state["a"][t], state["b"][t], state["n_own"][t])
            yield pd.DataFrame({"trial": [np.int32(t)], "score": [float(s @ weights)], "n": [float(weights.sum())]})

    def start(own):
        x = np.concatenate([floats(r.coords, width)[r.first : r.until] for r in own])
        empty = np.zeros((trials, len(x)))
        return {
            "x": x, "labels": np.concatenate([ints(r.labels, trials)[r.first : r.until] for r in own]),
            "weights": np.concatenate([floats(r.weights)[r.first : r.until] for r in own]), "a": empty, "b": empty + np.inf, "n_own": empty.copy(),
            "sums": np.zeros((n_open, len(x))), "slots": {}, "free": list(range(n_open)),
        }

    def meet(state, r):
        y, slots, sums = floats(r.coords, width), state["slots"], state["sums"]
        found, member, spread = _membership(ints(r.labels, trials), floats(r.weights))
        for key in found:
            if key not in slots:
                slots[key] = state["free"].pop()
        into = np.array([slots[key] for key in found])
        for at in range(0, len(state["x"]), len(y)):
            part, _ = _distance_sums(state["x"][at : at + len(y)], y, member, spread)
            sums[into, at : at + len(y)] += part if spread is None else spread.T @ part
        for t, cluster, n in zip(ints(r.end_trials), ints(r.end_clusters), floats(r.end_sizes), strict=True):
            slot = slots.pop((int(t), int(cluster)))
            own = state["labels"][:, t] == cluster
            state["a"][t, own], state["n_own"][t, own] = sums[slot, own] / max(n - 1, 1), n
            state["b"][t] = np.where(own, state["b"][t], np.minimum(state["b"][t], sums[slot] / n))
            sums[slot] = 0.0
            state["free"].append(slot)

    def score(batches):
        own, state, group = [], None, None
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                if r.grp != group:
                    if state is not None:
                        yield from finish(state)
                    own, state, group = [], None, r.grp
                if not r.met:
                    own.append(r)
                    continue
                if state is None:
                    state, own = start(own), []
                meet(state, r)
        if state is not None:
            yield from finish(state)

    return score


def _ends(pdf: pd.DataFrame) -> pd.DataFrame:
    """The clusters that end with a block, and their sizes."""
    kinds = {"end_trials": ("trial", np.int64), "end_clusters": ("cluster", np.int64), "end_sizes": ("n", np.float64)}
    return pd.DataFrame([{"at": pdf["last"].iloc[0], **{name: pdf[col].to_numpy(kind).tobytes() for name, (col, kind) in kinds.items()}}])


def _group_arrays(width: int, trials: int, columns: list[np.ndarray]):
    """Distance sums of every point of two groups of blocks by (trial, cluster), an array a block; a distance is worked out once for both its ends.

    An array has a row for each cluster that the block has met in the task; ``cols`` tells which.
    """
    starts = np.cumsum([0, *map(len, columns)])

    def onto(r):
        found, member, spread = _membership(ints(r.labels, trials), floats(r.weights))
        return np.array([starts[t] + np.searchsorted(columns[t], c) for t, c in found]), member, spread

    def compare(key, pdf):
        rows = list(pdf.itertuples(index=False))
        sums, met = [np.zeros((starts[-1], len(floats(r.weights)))) for r in rows], np.zeros((len(rows), starts[-1]), dtype=bool)
        members = [onto(r) for r in rows]
        first = [i for i, r in enumerate(rows) if r.own_group == key[0]]
        second = [i for i, r in enumerate(rows) if r.own_group == key[1]]
        for i in first:
            x = floats(rows[i].coords, width)
            for j in second:
                if key[0] == key[1] and j < i:
                    continue
                _, member, spread = members[j]
                found = _distance_sums(x, floats(rows[j].coords, width), member, spread, None if i == j else members[i][1])
                for one, other, part in ((i, j, found[0]), (j, i, found[1]))[: 1 if i == j else 2]:
                    cols, _, spread = members[other]
                    sums[one][cols] += part if spread is None else spread.T @ part
                    met[one, cols] = True
        return pd.DataFrame(
            {
                "block": [r.block for r in rows],
                "cols": [np.flatnonzero(m).astype(np.int64).tobytes() for m in met],
                "sums": [x[m].tobytes() for x, m in zip(sums, met)],
            }
        )

    return compare


def _by_pair(compare):
    """The rows of each pair of groups, one pair after the other."""

    def run(batches):
        held, key = [], None
        for pdf in batches:
            for found, part in pdf.groupby(["a", "b"], sort=False):
                if found != key:
                    if held:
                        yield compare(key, pd.concat(held))
                    held, key = [], found
                held.append(part)
        if held:
            yield compare(key, pd.concat(held))

    return run


def _block_scores(trials: int, columns: list[np.ndarray], sizes: list[np.ndarray]):
    """(trial, score, n): the sum of the silhouettes of a block's rows and their number, from its arrays of all tasks."""

    def score(packed: pd.DataFrame, arrays: pd.DataFrame) -> pd.DataFrame:
        labels, weights = ints(packed["labels"].iloc[0], trials), floats(packed["weights"].iloc[0])
        sums, rows, found, at = np.zeros((sum(map(len, columns)), len(labels))), np.arange(len(labels)), [], 0
        for cols, data in zip(arrays["cols"], arrays["sums"]):
            sums[ints(cols)] += floats(data, len(labels))
        for t, (known, n) in enumerate(zip(columns, sizes, strict=True)):
            part, own = sums[at : at + len(known)], np.searchsorted(known, labels[:, t])
            at += len(known)
            a = part[own, rows] / np.maximum(n[own] - 1, 1)
            others = part / n[:, None]
            others[own, rows] = np.inf
            s = _silhouettes(a, others.min(axis=0), n[own])
            found.append((t, float(s @ weights), float(weights.sum())))
        return pd.DataFrame(found, columns=["trial", "score", "n"])

    return score


def silhouette_exact(
    df: DataFrame, labels: str = "labels", features: str = "features", exclude_noise: bool = False, block_rows: int | None = None
) -> DataFrame:
    """Mean silhouette with Euclidean distance of every labelling in the ``labels`` array, in one distance pass.

    All distances are needed, so the work is quadratic in the rows. Points are sorted by their labels and packed into blocks of bounded size, so that
    a block has few clusters; blocks lie in groups; a task takes a pair of groups and adds up its distances by point and cluster. What moves is each
    point once per group, and an array of sums per block and group. With more than ``ARRAY_CLUSTERS`` clusters a task takes a group of rows
    instead, and all blocks go by it: then a task holds the sums of the clusters that have begun and not ended, and gives out one number per trial.
    Copies of a labelled point count by weight. Label -1 is a cluster like any other unless ``exclude_noise``.
    """
    spark = df.sparkSession
    head = df.select(F.size(labels).alias("t"), F.size(features).alias("d")).first()
    trials, width = head["t"], head["d"]
    if exclude_noise and trials != 1:
        raise ValueError("leaving noise out needs one labelling at a time")
    rows = df.filter(~F.array_contains(labels, -1)) if exclude_noise else df
    points = cut(
        rows.groupBy(F.col(features).alias("features"), F.col(labels).cast("array<bigint>").alias("labels")).agg(
            F.min("row_id").alias("pid"), F.count(F.lit(1)).cast("double").alias("weight")
        )
    )
    kinds = points.agg(F.count(F.lit(1)).alias("n"), *[F.approx_count_distinct(F.col("labels")[t]).alias(f"k{t}") for t in range(trials)]).first()
    n = kinds["n"]
    size = block_rows or block_size(n, parallelism(spark))
    # Coarse labellings first: a fine one then mostly lies inside them.
    order = [F.col("labels")[t] for t in sorted(range(trials), key=lambda t: kinds[f"k{t}"])]
    n_parts = max(1, min(-(-n // size), 8 * parallelism(spark)))
    ordered = points.repartitionByRange(n_parts, *order, "pid").sortWithinPartitions(*order, "pid").withColumn("part", F.spark_partition_id())
    packed = cut(ordered.select("part", "weight", "features", "labels").mapInPandas(_pack_labelled(size), "block long, weights binary, coords binary, labels binary"))
    n_blocks = packed.count()
    numbers = running_sums(packed.select(F.lit(0).alias("k"), "block"), ["k"], ["block"], {"at": F.lit(1)}, include_current=False)
    blocks = cut(packed.join(numbers.drop("k"), "block").withColumn("at", F.col("at").cast("bigint")))
    held = blocks.select("at", "labels", "weights").mapInPandas(_held(trials), "trial int, cluster long, at long, n double")
    sizes = cut(held.groupBy("trial", "cluster").agg(F.sum("n").alias("n"), F.min("at").alias("first"), F.max("at").alias("last")))
    counts = sizes.orderBy("trial", "cluster").limit(ARRAY_CLUSTERS + 1).collect()
    if len(counts) <= ARRAY_CLUSTERS:
        # Enough pairs of groups to keep all tasks busy, and no more than GROUP_BLOCKS blocks of a group in a task.
        n_groups = min(n_blocks, max(int(np.ceil(np.sqrt(4.0 * parallelism(spark)))), -(-n_blocks // GROUP_BLOCKS)))
        own = F.floor(F.col("at") * n_groups / F.lit(n_blocks))
        met = F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1)))
        listed = blocks.select("block", own.cast("int").alias("own_group"), met.alias("other"), "weights", "coords", "labels")
        pairs = listed.withColumn("a", F.least("own_group", "other")).withColumn("b", F.greatest("own_group", "other"))
        # Dealt out by number, as a hash would leave some tasks several pairs and others none.
        n_tasks = tasks_for(spark, n_groups * (n_groups + 1) // 2)
        pairs = pairs.repartitionById(n_tasks, pair_number("a", "b", n_groups, n_tasks)).sortWithinPartitions("a", "b", "block")
        columns = [np.array([r["cluster"] for r in counts if r["trial"] == t]) for t in range(trials)]
        n_rows = [np.array([r["n"] for r in counts if r["trial"] == t]) for t in range(trials)]
        arrays = pairs.mapInPandas(_by_pair(_group_arrays(width, trials, columns)), "block long, cols binary, sums binary")
        scored = (
            blocks.select("block", "labels", "weights")
            .groupBy("block")
            .cogroup(arrays.groupBy("block"))
            .applyInPandas(_block_scores(trials, columns, n_rows), "trial int, score double, n double")
        )
    else:
        scored = _scored_in_a_stream(blocks, sizes, n, size, n_blocks, width, trials)
    totals = scored.groupBy("trial").agg((F.sum("score") / F.sum("n")).alias("silhouette"), F.sum("n").cast("bigint").alias("n_rows"))
    # One label alone has no score.
    clusters = sizes.groupBy("trial").agg(F.count(F.lit(1)).alias("n_labels"))
    return totals.join(F.broadcast(clusters), "trial").select("trial", F.when(F.col("n_labels") > 1, F.col("silhouette")).alias("silhouette"), "n_rows")


def _scored_in_a_stream(blocks: DataFrame, sizes: DataFrame, n: int, size: int, n_blocks: int, width: int, trials: int) -> DataFrame:
    """(trial, score, n) of groups of rows, each against all blocks; a task's memory is bounded by ``HELD_SUMS`` whatever the number of clusters."""
    spark = blocks.sparkSession
    borders = sizes.select(F.col("first").alias("at"), F.lit(1).alias("d")).unionAll(sizes.select(F.col("last") + 1, F.lit(-1))).groupBy("at").agg(F.sum("d").alias("d"))
    n_open = running_sums(borders.withColumn("k", F.lit(0)), ["k"], ["at"], {"open": F.col("d")}).agg(F.max("open").alias("n")).first()["n"]
    most = max(1, HELD_SUMS // n_open)  # rows of a group
    slices = -(-size // most)
    cut_rows = -(-size // slices)
    together = max(1, min(most // cut_rows, -(-n_blocks * slices // parallelism(spark))))
    n_groups = -(-n_blocks * slices // together)
    ends = sizes.groupBy("last").applyInPandas(_ends, "at long, end_trials binary, end_clusters binary, end_sizes binary")
    blocks = cut(blocks.join(ends, "at", "left").withColumns({c: F.coalesce(c, F.lit(b"")) for c in ("end_trials", "end_clusters", "end_sizes")}))
    sliced = blocks.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    own = sliced.withColumns(
        {
            "grp": F.floor((F.col("at") * slices + F.col("slice")) / F.lit(together)).cast("bigint"), "met": F.lit(False),
            "first": F.col("slice") * cut_rows, "until": (F.col("slice") + 1) * cut_rows,
        }
    )
    met = blocks.withColumns({"grp": F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_groups - 1).cast("bigint"))), "met": F.lit(True), "first": F.lit(0), "until": F.lit(0)})
    cols = ["grp", "met", "at", "first", "until", "weights", "coords", "labels", "end_trials", "end_clusters", "end_sizes"]
    both = own.select(cols).unionAll(met.select(cols))
    dealt = both.repartitionById(n_groups, F.col("grp").cast("int")).sortWithinPartitions("grp", "met", "at", "first")
    return dealt.mapInPandas(_streamed_scores(width, trials, n_open), "trial int, score double, n double")


def mean_silhouettes(labelled: DataFrame, n_labellings: int, distance: str = EUCLIDEAN) -> list[float | None]:
    """Score of every labelling in the ``labels`` array: exact, or with squared distance in linear time."""
    if distance not in (EUCLIDEAN, SQUARED):
        raise ValueError(f"no such distance: {distance}")
    if n_labellings == 0:
        return []
    if distance == EUCLIDEAN:
        found = {r["trial"]: r["silhouette"] for r in silhouette_exact(labelled).collect()}
        return [found.get(i) for i in range(n_labellings)]
    # Spark's evaluator wants labels from 0.
    shifted = lambda i: labelled.withColumn("cluster_label", F.element_at("labels", i + 1) + 1)
    return [silhouette_fast(shifted(i)) for i in range(n_labellings)]


def silhouette_fast(df: DataFrame, label: str = "cluster_label", features: str = "features") -> float:
    """Silhouette with squared Euclidean distance: one linear pass, another scale than the exact score."""
    vectors = df.select(array_to_vector(F.col(features)).alias("v"), F.col(label).cast("double").alias("l"))
    return ClusteringEvaluator(featuresCol="v", predictionCol="l").evaluate(vectors)


def inertia(df: DataFrame, label: str = "cluster_label", features: str = "features") -> DataFrame:
    """Sum of squared distances to the mean of the own cluster.

    The means come first and the differences from them are squared, so that tight groups far from each other keep their digits.
    """
    width = len(df.select(features).first()[0])
    rows = df.select(F.col(label).alias("label"), F.col(features).alias("x"))
    means = cut(rows.groupBy("label").agg(F.array(*[F.avg(F.element_at("x", i + 1)) for i in range(width)]).alias("mean")))
    # A missing label is a cluster of its own.
    joined = rows.alias("r").join(broadcast_if_within(means).alias("m"), F.expr("r.label <=> m.label"))
    apart = F.aggregate(F.zip_with("x", "mean", lambda x, m: (x - m) * (x - m)), F.lit(0.0), lambda acc, d: acc + d)
    sums = joined.groupBy("r.label").agg(F.sum(apart).alias("sq"))
    return sums.agg(F.sum("sq").alias("inertia"), F.count(F.lit(1)).alias("n_clusters"))


def cluster_quality(df: DataFrame, label: str = "cluster_label", by: list[str] | None = None) -> DataFrame:
    """Clusters without the noise label and the share of noise."""
    noise = F.col(label) == -1
    by = by or []
    per_label = df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("_n"))
    return per_label.groupBy(*by).agg(
        F.count_if(~noise).alias("n_clusters"),
        (F.coalesce(F.sum(F.when(noise, F.col("_n"))), F.lit(0)) / F.sum("_n")).alias("noise_ratio"),
    )


def gate(results: DataFrame, max_noise: float | None, min_clusters: int = 2) -> DataFrame:
    """Results with enough clusters and little enough noise."""
    kept = results.filter(F.col("n_clusters") >= min_clusters)
    return kept if max_noise is None else kept.filter(F.col("noise_ratio") < max_noise)


def best_model(results: DataFrame) -> DataFrame:
    """Highest silhouette; the first trial among equals."""
    return results.filter(F.col("silhouette").isNotNull()).orderBy(F.desc("silhouette"), "trial_no").limit(1)


def best_per_paradigm(results: DataFrame) -> DataFrame:
    picked = F.struct(F.col("silhouette"), (-F.col("trial_no")).alias("order"))
    row = F.struct(*[c for c in results.columns if c != "paradigm"])
    return (
        results.filter(F.col("silhouette").isNotNull())
        .groupBy("paradigm")
        .agg(F.max_by(row, picked).alias("r"))
        .select("paradigm", "r.*")
    )


def model_comparison(results: DataFrame, phase: int = 1) -> DataFrame:
    """Best valid trial per paradigm, ranked; a paradigm without one scores -1.

    Phase 1 allows density models 60 % noise. Phase 2 allows 20 %, leaves Gaussian mixtures out and drops k-means
    unless it reaches 0.50; HDBSCAN only needs two clusters.
    """
    dbscan = F.col("paradigm") == "DBSCAN"
    density = F.col("paradigm").isin("DBSCAN", "HDBSCAN")
    few = density & (F.col("n_clusters") < 2)
    noisy = dbscan & (F.col("noise_ratio") >= MAX_NOISE[phase])
    weak = F.lit(False)
    kept = results
    if phase == 2:
        kept = kept.filter(F.col("paradigm") != "GMM")
        weak = (F.col("paradigm") == "K-Means") & (F.col("silhouette") < MIN_REFINED_KMEANS)
    gated = kept.filter(~weak).withColumn(
        "silhouette", F.when(few | noisy, F.lit(NO_MODEL)).otherwise(F.col("silhouette"))
    )
    best = best_per_paradigm(gated)
    top = best.agg(F.max(F.struct("silhouette", (-F.col("trial_no")).alias("o")))).scalar()
    wins = (F.struct("silhouette", (-F.col("trial_no")).alias("o")) == top) & (F.col("silhouette") > NO_MODEL)
    return best.withColumn("winner", wins)


def cluster_profile(segmented: DataFrame) -> DataFrame:
    """Size, mean nutrients and the dominant hour, category and class of each cluster (ties: smallest value)."""
    facts = segmented.withColumn("hour", F.hour("timestamp"))
    sizes = facts.groupBy("cluster_label").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.avg(c).alias(f"mean_{c}") for c in ("calories_100g", "proteins_100g", "carbs_100g")],
    )
    for col in ("hour", "category", "classification"):
        counts = facts.filter(F.col(col).isNotNull()).groupBy("cluster_label", col).agg(F.count(F.lit(1)).alias("n"))
        # min over (-count, value): the most frequent value, the smallest one among equals.
        first = F.min(F.struct((-F.col("n")).alias("rank"), F.col(col)))
        top = counts.groupBy("cluster_label").agg(first.alias("t")).select("cluster_label", F.col(f"t.{col}").alias(f"top_{col}"))
        sizes = sizes.join(top, "cluster_label", "left")
    return sizes


def event_distribution(segmented: DataFrame) -> DataFrame:
    return segmented.groupBy("cluster_label", "event_type").agg(F.count(F.lit(1)).alias("n"))


def segment(inventory: DataFrame, labels: DataFrame) -> DataFrame:
    """Inventory with the label of each row."""
    return inventory.join(labels.select("row_id", "cluster_label"), "row_id", "left")
