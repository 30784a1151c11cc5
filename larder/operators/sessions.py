"""Restock and kitchen sessions: chains of movements of a household no more than a gap apart.

Events less than a gap apart always share a session, so the events of a time bin as long as the gap can be added up
first. What is left per household is at most one row per calendar bin, whatever the number of events; the window that
finds the session borders runs over those rows only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from larder.session import cut

# Longest pause inside a session, in seconds, by event type.
SESSION_GAP = {"IN": 3600, "OUT": 900}


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a zone-free timestamp (the session zone is UTC)."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def whole_bins(value: Column, width: Column) -> Column:
    """Number of the bin of a whole value; the division of a multiple is exact."""
    return ((value - F.pmod(value, width)) / width).cast("bigint")


def time_bin(ts: Column, seconds: int) -> Column:
    return whole_bins(micros(ts), F.lit(1_000_000 * seconds))


def session_bins(events: DataFrame, gap: int, key: str = "household_id") -> DataFrame:
    """(key, bin) with its session number, first and last time, events and quantity."""
    bins = events.groupBy(key, time_bin(F.col("timestamp"), gap).alias("bin")).agg(
        F.min("timestamp").alias("first_ts"),
        F.max("timestamp").alias("last_ts"),
        F.count(F.lit(1)).alias("n_events"),
        F.sum(F.col("quantity").cast("bigint")).alias("quantity"),
    )
    return _numbered(bins, gap, key)


def _numbered(bins: DataFrame, gap: int, key: str) -> DataFrame:
    w = W.partitionBy(key).orderBy("bin")
    pause = micros(F.col("first_ts")) - micros(F.lag("last_ts").over(w))
    flagged = bins.withColumn("_new", F.when(pause <= gap * 1_000_000, 0).otherwise(1))
    return flagged.withColumn("session_no", F.sum("_new").over(w)).drop("_new")


def sessions(movements: DataFrame, event_type: str, gap: int | None = None) -> DataFrame:
    """One row per session: start, last event, events, quantity and distinct products.

    The log is read once, into rows of a bin and a product; the bins' borders and the sessions' products both follow from these.
    """
    gap = SESSION_GAP[event_type] if gap is None else gap
    events = movements.filter(F.col("event_type") == event_type)
    cells = cut(
        events.groupBy("household_id", time_bin(F.col("timestamp"), gap).alias("bin"), "product_id").agg(
            F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"),
            F.count(F.lit(1)).alias("n_events"), F.sum(F.col("quantity").cast("bigint")).alias("quantity"),
        )
    )
    whole = cells.groupBy("household_id", "bin").agg(
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.sum("n_events").alias("n_events"), F.sum("quantity").alias("quantity")
    )
    bins = _numbered(whole, gap, "household_id")
    spans = bins.groupBy("household_id", "session_no").agg(
        F.min("first_ts").alias("session_start"),
        F.max("last_ts").alias("session_end"),
        F.sum("n_events").alias("n_events"),
        F.sum("quantity").alias("quantity"),
    )
    seen = _same(cells.select("household_id", "bin", "product_id"), bins.select("household_id", "bin", "session_no"), ["household_id", "bin"])
    kinds = seen.select("household_id", "session_no", "product_id").distinct().groupBy("household_id", "session_no").agg(F.count("product_id").alias("n_products"))
    return _same(spans, kinds, ["household_id", "session_no"])


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join where a missing household is a household like any other."""
    named = right.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return left.join(named, on).drop(*[f"_{k}" for k in keys])


def assign_sessions(movements: DataFrame, event_type: str, gap: int | None = None) -> DataFrame:
    """Every event of the type with its session number."""
    gap = SESSION_GAP[event_type] if gap is None else gap
    events = movements.filter(F.col("event_type") == event_type)
    numbered = session_bins(events, gap).select("household_id", "bin", "session_no")
    return _same(events.withColumn("bin", time_bin(F.col("timestamp"), gap)), numbered, ["household_id", "bin"]).drop("bin")


def session_products(movements: DataFrame, event_type: str, gap: int | None = None) -> DataFrame:
    """Distinct (household, session, product); repeats are dropped per bin before the join."""
    gap = SESSION_GAP[event_type] if gap is None else gap
    events = movements.filter(F.col("event_type") == event_type)
    numbered = session_bins(events, gap).select("household_id", "bin", "session_no")
    per_bin = events.select(
        "household_id", time_bin(F.col("timestamp"), gap).alias("bin"), "product_id"
    ).distinct()
    return (
        _same(per_bin, numbered, ["household_id", "bin"]).select("household_id", "session_no", "product_id").distinct()
    )
