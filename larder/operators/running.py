"""Running sums that stay exact and balanced when a few keys hold most of the rows.

A plain window puts each key into one task. Where a key is too large for that, the rows are range-partitioned on
(keys, order), which cuts a hot key into several slices; every slice gets the total of the slices before it. Only keys
that cross a slice border need such a carry, at most one per border, so the carry table is bounded by the number of
slices.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from larder.session import cut, tasks_for

HOT_ROWS = 2_000_000
SLICE_ROWS = 1_000
MIN_SLICES = 4


def group_sizes(df: DataFrame, keys: list[str]) -> tuple[int, int]:
    """Rows of the largest key and of all keys."""
    row = df.groupBy(*keys).count().agg(F.max("count"), F.sum("count")).first()
    return row[0] or 0, row[1] or 0


def _same(left: DataFrame, right: DataFrame, cols: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"_r_{c}"]) for c in cols])


def _renamed(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumnsRenamed({c: f"_r_{c}" for c in cols})


def running_sums(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    sums: Mapping[str, Column],
    include_current: bool = True,
    hot_rows: int = HOT_ROWS,
    sizes: tuple[int, int] | None = None,
) -> DataFrame:
    """Add for every entry of ``sums`` its running sum per key (0 before the first row).

    ``order`` names columns that order the rows of a key totally. With ``include_current`` false the sum covers the
    earlier rows only. ``sizes`` are the rows of the largest key and of all keys, counted unless given.
    """
    valued = df.withColumns({f"_v_{name}": expr for name, expr in sums.items()})
    last = 0 if include_current else -1
    largest, total = group_sizes(df, keys) if sizes is None else sizes
    if largest <= hot_rows:
        w = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, last)
        out = valued.withColumns({n: F.coalesce(F.sum(f"_v_{n}").over(w), F.lit(0)) for n in sums})
        return out.drop(*[f"_v_{n}" for n in sums])

    n_slices = max(MIN_SLICES, tasks_for(df.sparkSession, total // max(SLICE_ROWS, hot_rows // 4)))
    sliced = cut(
        valued.repartitionByRange(n_slices, *keys, *order).withColumn("_slice", F.spark_partition_id())
    )
    # At most one key per slice border: the first key of each slice.
    first_keys = (
        sliced.groupBy("_slice").agg(F.min(F.struct(*keys)).alias("k")).select("k.*").distinct()
    )
    border = F.broadcast(_renamed(first_keys, keys))
    totals = (
        sliced.join(border, _same(sliced, border, keys), "left_semi")
        .groupBy("_slice", *keys)
        .agg(*[F.sum(f"_v_{n}").alias(f"_c_{n}") for n in sums])
    )
    before = W.partitionBy(*keys).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    carry = totals.select(
        "_slice", *keys, *[F.coalesce(F.sum(f"_c_{n}").over(before), F.lit(0)).alias(f"_c_{n}") for n in sums]
    )
    carry = F.broadcast(_renamed(carry, ["_slice", *keys]))
    w = W.partitionBy("_slice", *keys).orderBy(*order).rowsBetween(W.unboundedPreceding, last)
    inside = sliced.withColumns({n: F.coalesce(F.sum(f"_v_{n}").over(w), F.lit(0)) for n in sums})
    joined = inside.join(carry, _same(inside, carry, ["_slice", *keys]), "left")
    out = joined.withColumns({n: F.col(n) + F.coalesce(F.col(f"_c_{n}"), F.lit(0)) for n in sums})
    return out.select(*df.columns, *sums)
