"""Sessions on a stream of movements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.operators.sessions import SESSION_GAP


def session_stream(movements: DataFrame, event_type: str, gap: int | None = None, lateness: str = "1 day") -> DataFrame:
    """One row per closed session of a household. The window ends a gap after the last event; the row gives the event.

    Sessions of a task are merged before the shuffle where
    ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition`` is on, which a hot household wants.
    """
    gap = SESSION_GAP[event_type] if gap is None else gap
    events = (
        movements.filter(F.col("event_type") == event_type)
        .select("household_id", "quantity", F.col("timestamp").cast("timestamp").alias("ts"))
        .withWatermark("ts", lateness)
    )
    closed = events.groupBy("household_id", F.session_window("ts", f"{gap} seconds")).agg(
        F.count(F.lit(1)).alias("n_events"), F.sum(F.col("quantity").cast("bigint")).alias("quantity")
    )
    last = F.col("session_window.end") - F.expr(f"INTERVAL {gap} SECONDS")
    return closed.select(
        "household_id",
        F.col("session_window.start").cast("timestamp_ntz").alias("session_start"),
        last.cast("timestamp_ntz").alias("session_end"),
        "n_events",
        "quantity",
    )
