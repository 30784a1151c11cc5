"""Blocks of points and pairs of blocks: the common ground of the distance operators.

Points are first reduced to distinct ones with a weight, so that copies cost nothing. A block holds a bounded number of
points packed into one row; a task compares two blocks at a time and gives out totals, never point pairs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.session import cut, parallelism, tasks_for

BLOCK_ROWS = 2048
MIN_BLOCK_ROWS = 512
SORT_AXES = 3
# Blocks of a group in a task, and rows of a distance matrix that are worked out together, so that they stay in the cache.
GROUP_BLOCKS, STRIP = 32, 256
# Share of the smallest squared eps that single precision may be off by.
ROUGH = 0.02


@dataclass
class Points:
    """Distinct points (pid, features, weight), and the pid of every row where there are copies."""

    distinct: DataFrame
    members: DataFrame | None
    n_distinct: int
    n_rows: int
    width: int

    def to_rows(self, per_point: DataFrame) -> DataFrame:
        """Results by pid -> results by row_id."""
        if self.members is None:
            return per_point.withColumnRenamed("pid", "row_id")
        return self.members.join(per_point, "pid").drop("pid")


def distinct_points(df: DataFrame, features: str = "features") -> Points:
    """Group equal vectors; the pid is the smallest row_id of the group."""
    rows = df.select("row_id", F.col(features).alias("features"))
    grouped = cut(
        rows.groupBy("features").agg(F.min("row_id").alias("pid"), F.count(F.lit(1)).cast("double").alias("weight"))
    )
    sizes = grouped.agg(
        F.count(F.lit(1)).alias("n"), F.sum("weight").alias("rows"), F.max(F.size("features")).alias("d")
    ).first()
    members = None
    n, n_rows = int(sizes["n"]), int(sizes["rows"] or 0)
    if n != n_rows:
        members = cut(rows.join(grouped.select("features", "pid"), "features").select("row_id", "pid"))
    return Points(grouped, members, n, n_rows, int(sizes["d"] or 0))


def block_size(n: int, workers: int) -> int:
    """Points per block: enough blocks to keep the workers busy, within a fixed bound per block."""
    blocks = max(1, int(np.ceil(np.sqrt(2.0 * workers))))
    return int(min(BLOCK_ROWS, max(MIN_BLOCK_ROWS, np.ceil(n / blocks))))


PACKED = "block long, n int, ids binary, weights binary, coords binary, lo array<double>, hi array<double>, crowd boolean, home long"


def _pack(pdf: pd.DataFrame) -> dict:
    coords = np.array(pdf["features"].tolist(), dtype=np.float64)
    ids = pdf["pid"].to_numpy(np.int64)
    return {
        "block": int(ids.min()),
        "n": len(ids),
        "ids": ids.tobytes(),
        "weights": pdf["weight"].to_numpy(np.float64).tobytes(),
        "coords": coords.tobytes(),
        "lo": coords.min(axis=0).tolist(),
        "hi": coords.max(axis=0).tolist(),
        "crowd": bool(pdf["crowd"].iloc[0]),
        "home": int(pdf["home"].iloc[0]),
    }


def range_blocks(points: Points, cell: float, block_rows: int | None = None, homes: DataFrame | None = None) -> DataFrame:
    """Blocks of neighbouring points: sorted by grid cell on the leading axes, then by coordinates; points with a ``home`` (pid, home) share
    blocks only with those of the same.

    Range partitioning ends with the unique pid, so a crowded cell is spread over as many blocks as it needs.
    """
    spark = points.distinct.sparkSession
    size = block_rows or block_size(points.n_distinct, parallelism(spark))
    n_parts = max(1, min(-(-points.n_distinct // size), 8 * parallelism(spark)))
    axes = [F.element_at("features", i + 1) for i in range(min(SORT_AXES, points.width))]
    order = [F.col("crowd"), F.col("home"), *[F.floor(x / cell) for x in axes], *axes, F.col("pid")]
    placed = points.distinct.withColumn("home", F.lit(None).cast("long")) if homes is None else points.distinct.join(homes, "pid", "left")
    placed = placed.withColumns({"crowd": F.col("home").isNotNull(), "home": F.coalesce("home", F.lit(0).cast("long"))})
    ordered = placed.repartitionByRange(n_parts, *order).sortWithinPartitions(*order)

    def pack(batches):
        for pdf in batches:
            for _, part in pdf.groupby(["crowd", "home"], sort=False):
                for i in range(0, len(part), size):
                    yield pd.DataFrame([_pack(part.iloc[i : i + size])])

    return cut(ordered.mapInPandas(pack, PACKED))


def box_gap(lo_a, hi_a, lo_b, hi_b):
    """Squared distance of two boxes."""
    below = F.zip_with(lo_b, hi_a, lambda x, y: F.greatest(x - y, F.lit(0.0)))
    above = F.zip_with(lo_a, hi_b, lambda x, y: F.greatest(x - y, F.lit(0.0)))
    gaps = F.zip_with(below, above, lambda x, y: F.greatest(x, y))
    return F.aggregate(gaps, F.lit(0.0), lambda acc, x: acc + x * x)


def near_pairs(blocks: DataFrame, eps: float, width: int) -> DataFrame:
    """(a, b), a <= b, of the blocks whose boxes are at most eps apart, and whether both belong to crowds; two blocks of one crowd are no pair.

    Each box, widened by eps at its upper end, is listed under the grid cells it covers on the first two axes; two
    boxes meet in the cell of their larger lower corner, so every pair is found once.
    """
    no_crowds = [F.lit(False).alias("crowd"), F.lit(0).cast("long").alias("home")]
    meta = blocks.select("block", "lo", "hi", *(["crowd", "home"] if "crowd" in blocks.columns else no_crowds))
    axes = list(range(1, min(2, width) + 1))
    spans = meta.agg(*[(F.max(F.element_at("hi", i)) - F.min(F.element_at("lo", i))).alias(f"s{i}") for i in axes]).first()
    steps = {i: max(eps, (spans[f"s{i}"] or 0.0) / n, 1e-9) for i, n in zip(axes, (256, 32))}

    def cell(value, i):
        return F.floor(value / F.lit(steps[i])).cast("bigint")

    listed = meta
    for i in axes:
        first, last = cell(F.element_at("lo", i), i), cell(F.element_at("hi", i) + F.lit(eps), i)
        listed = listed.withColumn(f"c{i}", F.explode(F.sequence(first, last)))
    a = listed.select(*[F.col(c).alias(f"{c}_a") for c in ("block", "lo", "hi", "crowd", "home")], *[f"c{i}" for i in axes])
    b = listed.select(*[F.col(c).alias(f"{c}_b") for c in ("block", "lo", "hi", "crowd", "home")], *[f"c{i}" for i in axes])
    joined = a.join(b, [f"c{i}" for i in axes]).filter("block_a <= block_b AND NOT (crowd_a AND crowd_b AND home_a = home_b)")
    for i in axes:
        corner = F.greatest(F.element_at("lo_a", i), F.element_at("lo_b", i))
        joined = joined.filter(cell(corner, i) == F.col(f"c{i}"))
    # A hair above eps, so that rounding never drops a pair that the kernel would accept.
    limit = (eps * (1 + 1e-9)) ** 2
    return joined.filter(box_gap("lo_a", "hi_a", "lo_b", "hi_b") <= limit).select(
        F.col("block_a").alias("a"), F.col("block_b").alias("b"), (F.col("crowd_a") & F.col("crowd_b")).alias("crowds")
    )


TILE = "tile_a long, tile_b long, block long, meets array<long>"


def in_tiles(pairs: DataFrame, blocks: DataFrame, cols: list[str]) -> DataFrame:
    """(tile_a, tile_b, block, meets, cols): the blocks of pairs (a, b; a written table) by pair of groups, each once in a tile with the blocks it meets
    there as ``a``; ``block_pairs`` goes through them in a task.

    A block moves once for each group that it meets, not once for each pair. Groups hold about ``GROUP_BLOCKS`` blocks at most, which bounds a
    task's memory; few pairs are tiles of their own.
    """
    spark = blocks.sparkSession
    n_pairs, n_blocks, slots = pairs.count(), blocks.count(), parallelism(spark)
    n_groups = max(int(np.ceil(np.sqrt(4.0 * slots))), -(-n_blocks // GROUP_BLOCKS))
    alone = n_pairs <= 4 * slots
    group = F.col if alone else (lambda x: F.pmod(F.xxhash64(x), F.lit(n_groups)))
    # Either order of the groups is the same tile.
    placed = pairs.select("a", "b", F.least(group("a"), group("b")).alias("tile_a"), F.greatest(group("a"), group("b")).alias("tile_b"))
    ends = F.explode(F.array(F.struct(F.col("a").alias("block"), F.col("b").alias("met")), F.struct(F.col("b").alias("block"), F.lit(None).cast("long").alias("met")))).alias("e")
    wanted = cut(placed.select("tile_a", "tile_b", ends).groupBy("tile_a", "tile_b", "e.block").agg(F.collect_list("e.met").alias("meets")))
    tiles = wanted.join(blocks.select("block", *cols), "block").select("tile_a", "tile_b", "block", "meets", *cols)
    if alone:
        dealt = tiles.repartition(max(1, n_pairs), "tile_a", "tile_b")
    else:
        # Dealt out by number, as a hash would leave some tasks several tiles and others none.
        n_tiles = min(n_pairs, n_groups * (n_groups + 1) // 2)
        dealt = tiles.repartitionById(n_tiles, pair_number("tile_a", "tile_b", n_groups, n_tiles))
    return dealt.sortWithinPartitions("tile_a", "tile_b", "block")


def pair_number(a: str, b: str, n_groups: int, n_tasks: int):
    """Task of a pair of groups a <= b, counted from 0: pairs go round the tasks."""
    return F.expr(f"CAST(pmod({a} * {n_groups}L - {a} * ({a} - 1L) DIV 2 + {b} - {a}, {n_tasks}L) AS INT)")


def whole_tiles(batches):
    """The rows of each tile by block, one tile after the other."""
    held, key = {}, None
    for pdf in batches:
        for r in pdf.itertuples(index=False):
            if (r.tile_a, r.tile_b) != key:
                if held:
                    yield held
                held, key = {}, (r.tile_a, r.tile_b)
            held[r.block] = r
    if held:
        yield held


def block_pairs(tile: dict):
    """The pairs of rows (a, b) that meet in a tile."""
    for a in sorted(tile):
        for b in sorted(tile[a].meets):
            yield tile[a], tile[b]


def spread(blocks: DataFrame, n_blocks: int) -> DataFrame:
    """Blocks dealt out to a fixed number of tasks: their rows are few and small, the work on each is not."""
    return blocks.repartition(tasks_for(blocks.sparkSession, n_blocks), "block")


def floats(data: bytes, width: int | None = None) -> np.ndarray:
    values = np.frombuffer(data, dtype=np.float64)
    return values if width is None else values.reshape(-1, width)


def ints(data: bytes, width: int | None = None) -> np.ndarray:
    values = np.frombuffer(data, dtype=np.int64)
    return values if width is None else values.reshape(-1, width)


def distance_strips(a: np.ndarray, b: np.ndarray, out: np.ndarray | None = None):
    """(start, squared distances of the rows from there to all of b) by strips that stay in the cache; without ``out`` the next strip takes the place of the
    last one.

    Via one matrix product around the common centre, into which the squares go as two more columns, then exact where the product leaves too few digits.
    """
    centre = a.mean(axis=0)
    x, y = a - centre, b - centre
    xx, yy = (x * x).sum(axis=1), (y * y).sum(axis=1)
    left = np.concatenate([x, xx[:, None], np.ones((len(x), 1))], axis=1)
    right = np.concatenate([-2.0 * y.T, np.ones((1, len(y))), yy[None, :]])
    most, room = yy.max(initial=0.0), np.empty((min(STRIP, len(a)), len(b))) if out is None else None
    for at in range(0, len(a), STRIP):
        own = xx[at : at + STRIP]
        part = room[: len(own)] if out is None else out[at : at + STRIP]
        np.matmul(left[at : at + STRIP], right, out=part)
        if part.min(initial=np.inf) <= 1e-6 * (own.max() + most):
            i, j = np.nonzero(part <= 1e-6 * (own[:, None] + yy[None, :]))
            diff = a[at + i] - b[j]
            part[i, j] = (diff * diff).sum(axis=1)
            np.maximum(part, 0.0, out=part)
        yield at, part


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.empty((len(a), len(b)))
    for _ in distance_strips(a, b, out):
        pass
    return out


def apart(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Squared distances of the named pairs from the coordinates alone: the same whatever blocks the two points are in."""
    out = np.empty(len(i))
    for at in range(0, len(i), 1 << 16):
        diff = a[i[at : at + (1 << 16)]] - b[j[at : at + (1 << 16)]]
        out[at : at + (1 << 16)] = (diff * diff).sum(axis=1)
    return out


def _edge(a: np.ndarray, b: np.ndarray, eps: float) -> float:
    """How far from eps * eps a squared distance has to be for its product to be trusted."""
    return 1e-10 * (eps * eps + float(np.abs(a).max(initial=0.0)) ** 2 + float(np.abs(b).max(initial=0.0)) ** 2)


def _within(sq: np.ndarray, a: np.ndarray, b: np.ndarray, eps: float, edge: float) -> np.ndarray:
    limit = eps * eps
    close = sq <= limit + edge
    border = close & (sq >= limit - edge)
    if border.any():
        i, j = np.nonzero(border)
        diff = a[i] - b[j]
        close[i, j] = np.sqrt((diff * diff).sum(axis=1)) <= eps
    return close


def within(sq: np.ndarray, a: np.ndarray, b: np.ndarray, eps: float) -> np.ndarray:
    """Distance <= eps, recomputed directly for pairs at the border."""
    return _within(sq, a, b, eps, _edge(a, b, eps))


def _rough_strips(a: np.ndarray, b: np.ndarray, most: float):
    """How far off squared distances in single precision may be, and (start, these distances) by strips as in ``distance_strips``. ``most`` is the largest
    distance that they are held against."""
    centre = a.mean(axis=0)
    x, y = a - centre, b - centre
    xx, yy = (x * x).sum(axis=1), (y * y).sum(axis=1)
    left = np.concatenate([x, xx[:, None], np.ones((len(x), 1))], axis=1).astype(np.float32)
    right = np.concatenate([-2.0 * y.T, np.ones((1, len(y))), yy[None, :]]).astype(np.float32)
    slack = 2.0 * (a.shape[1] + 10) * float(np.finfo(np.float32).eps) * (xx.max(initial=0.0) + yy.max(initial=0.0) + most * most)
    room = np.empty((min(STRIP, len(a)), len(b)), np.float32)

    def strips():
        for at in range(0, len(a), STRIP):
            part = room[: min(STRIP, len(a) - at)]
            np.matmul(left[at : at + STRIP], right, out=part)
            yield at, part

    return slack, strips()


def within_each(a: np.ndarray, b: np.ndarray, eps: Sequence[float]) -> list[np.ndarray | None]:
    """Who of a is within each eps of whom of b; None where nobody is. Where few pairs are within the largest eps, the others look at these only.

    Single precision tells who is clearly in or out; the pairs that it leaves open are worked out from their coordinates. Points too far from their common centre
    for that are compared in double precision.
    """
    edges, top = [_edge(a, b, e) for e in eps], int(np.argmax(eps))
    slack, strips = _rough_strips(a, b, eps[top])
    if np.isfinite(slack) and slack <= ROUGH * min(eps) ** 2:
        edges = [max(edge, slack) for edge in edges]
    else:
        strips = distance_strips(a, b)
    found: list[np.ndarray | None] = [None] * len(eps)
    for at, sq in strips:
        own = a[at : at + len(sq)]
        reach = sq <= eps[top] * eps[top] + edges[top]
        near = np.count_nonzero(reach)
        if not near:
            continue
        if 8 * near < reach.size:
            i, j = np.nonzero(reach)
            few = sq[i, j]
        for k, (e, edge) in enumerate(zip(eps, edges)):
            if 8 * near < reach.size:
                close = few <= e * e + edge
                border = np.flatnonzero(close & (few >= e * e - edge))
                if len(border):
                    diff = own[i[border]] - b[j[border]]
                    close[border] = np.sqrt((diff * diff).sum(axis=1)) <= e
                if not close.any():
                    continue
                place = i[close], j[close]
            else:
                place = _within(sq, own, b, e, edge)
                if not place.any():
                    continue
            if found[k] is None:
                found[k] = np.zeros((len(a), len(b)), dtype=bool)
            found[k][at : at + len(sq)][place] = True
    return found


def close_sums(close: np.ndarray, wa: np.ndarray, wb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weight of b that is close to each of a, and of a that is close to each of b."""
    if (wa == 1).all() and (wb == 1).all():
        # Single points are counted: set bits of a row, and bytes of so many rows that they do not overflow.
        columns = sum(np.add.reduce(close[at : at + 128].view(np.uint8), axis=0, dtype=np.uint8).astype(np.int64) for at in range(0, len(close), 128))
        return np.bitwise_count(np.packbits(close, axis=1)).sum(axis=1, dtype=np.int64), columns
    # Sums of whole numbers below 2 ** 24 are exact in single precision.
    kind = np.float32 if max(wa.sum(), wb.sum()) < 1 << 24 else np.float64
    close = close.astype(kind)
    return close @ wb.astype(kind), wa.astype(kind) @ close
