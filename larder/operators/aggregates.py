"""Frequencies, profiles, top-k and rates. Every groupBy keeps its map-side partial aggregation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per non-null value, most frequent first."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), col)


def frequency_shares(df: DataFrame, col: str, digits: int = 4) -> DataFrame:
    """Share of each non-null value, rounded half to even."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(col, F.bround(F.col("n").cast("double") / total, digits).alias("share"))


def top_k(df: DataFrame, col: str, k: int) -> DataFrame:
    """The k most frequent values; equal counts by value."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), col).limit(k)


def distinct_in_order(df: DataFrame, col: str, row_id: str = "row_id") -> DataFrame:
    """Distinct values with the first row that carries each."""
    return df.groupBy(col).agg(F.min(row_id).alias("first_row"))


def null_profile(df: DataFrame) -> DataFrame:
    """Null count and share of every column, in one pass."""
    cols = df.columns
    once = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in cols],
    )
    return once.unpivot("_n", cols, "column", "nulls").select(
        "column",
        "nulls",
        F.when(F.col("_n") > 0, F.col("nulls").cast("double") / F.col("_n")).alias("null_share"),
    )


def column_types(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, columns and column types of each table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"),
            "n_rows",
            F.lit(len(df.columns)).cast("bigint").alias("n_cols"),
            F.lit(",".join(df.columns)).alias("columns"),
            F.lit(",".join(kind for _, kind in column_types(df))).alias("types"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def matrix_range(df: DataFrame, features: str = "features") -> DataFrame:
    """Rows, width, smallest and largest entry of a keyed matrix (array column)."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.max(F.size(features)).cast("bigint").alias("n_cols"),
        F.min(F.array_min(features)).alias("min_value"),
        F.max(F.array_max(features)).alias("max_value"),
    )


def waste_rate(df: DataFrame, *keys: str) -> DataFrame:
    """Quantity bought, wasted, and the wasted share of what was bought; NULL where nothing was bought."""
    wasted = F.col("classification").isin("Waste", "Forced_Waste")
    totals = df.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(F.col("event_type") == "IN", F.col("quantity"))), F.lit(0)).alias("in_qty"),
        F.coalesce(F.sum(F.when(wasted, F.col("quantity"))), F.lit(0)).alias("waste_qty"),
    )
    rate = F.when(F.col("in_qty") > 0, F.col("waste_qty").cast("double") / F.col("in_qty"))
    return totals.withColumn("waste_rate", rate)
