"""Lot ledger, expiry write-offs, open lots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from larder.functions import scalars as S
from larder.operators.running import HOT_ROWS, running_sums

LOT = ["household_id", "stock_id"]


def signed_quantity() -> Column:
    qty = F.col("quantity").cast("bigint")
    return F.when(F.col("event_type") == "IN", qty).otherwise(-qty)


def lot_ledger(movements: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """On-hand quantity of the lot after each movement.

    Minutes within an hour are independent for IN and OUT, so the order is hour, IN before OUT, time, row.
    """
    ordered = movements.withColumns(
        {
            "_hour": F.date_trunc("hour", "timestamp"),
            "_side": F.when(F.col("event_type") == "IN", 0).otherwise(1),
        }
    )
    out = running_sums(
        ordered, LOT, ["_hour", "_side", "timestamp", "row_id"], {"balance": signed_quantity()}, True, hot_rows
    )
    return out.drop("_hour", "_side")


def lot_balances(movements: DataFrame) -> DataFrame:
    """Per lot: last IN expiry, quantity received and final balance."""
    is_in = F.col("event_type") == "IN"
    return movements.groupBy(*LOT).agg(
        F.max(F.when(is_in, F.col("expiry_date"))).alias("lot_expiry"),
        F.coalesce(F.sum(F.when(is_in, F.col("quantity").cast("bigint"))), F.lit(0)).alias("in_qty"),
        F.sum(signed_quantity()).alias("balance"),
    )


def lot_days(movements: DataFrame) -> DataFrame:
    """One row per lot and day with movements: net quantity, latest IN expiry, product, and the term the day belongs to.

    A term ends where a day lies behind the write-off day of the INs so far: what is left is written off, and later INs open a new term.
    Earlier terms need no care when the latest expiry so far is taken over the whole lot, as their write-off days have passed.
    """
    daily = movements.groupBy(*LOT, F.to_date("timestamp").alias("day")).agg(
        F.sum(signed_quantity()).alias("net"),
        F.max(F.when(F.col("event_type") == "IN", F.col("expiry_date"))).alias("expiry"),
        F.max(F.struct("product_id", "product_name")).alias("product"),
    )
    by_day = W.partitionBy(*LOT).orderBy("day")
    so_far = F.max("expiry").over(by_day.rowsBetween(W.unboundedPreceding, -1))
    ends = F.when(S.writeoff_day(so_far) < F.col("day"), 1).otherwise(0)
    return daily.withColumn("_ends", ends).withColumn("term", F.sum("_ends").over(by_day)).drop("_ends")


def lot_terms(movements: DataFrame, as_of: Column | None = None) -> DataFrame:
    """One row per term of a lot: its expiry, write-off day, what is written off then (0 if nothing is), and what is left afterwards.

    The stock written off before a term is the highest running total at the end of the earlier terms that have an expiry, so no state
    is handed from row to row. A term without an IN of known expiry hands its stock on.
    """
    if as_of is None:
        as_of = movements.agg(F.max(F.to_date("timestamp"))).scalar()
    terms = lot_days(movements).groupBy(*LOT, "term").agg(
        F.sum("net").alias("net"), F.max("expiry").alias("expiry_date"), F.max("product").alias("product")
    )
    by_term = W.partitionBy(*LOT).orderBy("term")
    due = S.writeoff_day(F.col("expiry_date"))
    ends = due.isNotNull() & (due <= as_of)
    summed = terms.withColumn("due_day", due).withColumn("_total", F.sum("net").over(by_term)).withColumn("_ends", ends)
    gone = F.max(F.when(F.col("_ends"), F.col("_total"))).over(by_term.rowsBetween(W.unboundedPreceding, -1))
    left = F.col("_total") - F.greatest(F.lit(0), F.coalesce(gone, F.lit(0)))
    written = F.when(F.col("_ends") & (F.col("_left") > 0), F.col("_left")).otherwise(0)
    out = summed.withColumn("_left", left).withColumn("quantity", written).withColumn("balance", F.col("_left") - F.col("quantity"))
    return out.select(*LOT, "term", "product", "expiry_date", "due_day", "quantity", "balance")


def expiry_writeoffs(movements: DataFrame, as_of: Column | None = None) -> DataFrame:
    """One Forced_Waste OUT row per term of a lot that still holds stock at the end of its write-off day.

    Only write-off days up to ``as_of`` count, the last day of the log unless given. Movements are first added up per
    lot and day, so a lot of any size turns into at most one row per calendar day.
    """
    return lot_terms(movements, as_of).filter("quantity > 0").select(
        S.surrogate_key(F.col("household_id"), F.col("stock_id"), F.col("due_day"), length=10).alias("event_id"),
        *LOT,
        "product.*",
        F.lit("OUT").alias("event_type"),
        "quantity",
        S.end_of_day(F.col("due_day")).alias("timestamp"),
        "expiry_date",
        F.lit("Forced_Waste").alias("classification"),
    )


def daily_ledger(movements: DataFrame, as_of: Column | None = None) -> DataFrame:
    """What the stream of lots gives: the balance after each day with movements, write-offs taken off, and the write-offs."""
    days, terms = lot_days(movements), lot_terms(movements, as_of)
    carried = W.partitionBy(*LOT).orderBy("term")
    opening = terms.select(*LOT, "term", F.coalesce(F.lag("balance").over(carried), F.lit(0)).alias("opening"))
    inside = F.sum("net").over(W.partitionBy(*LOT, "term").orderBy("day"))
    same = [F.col(f"d.{k}").eqNullSafe(F.col(f"o.{k}")) for k in (*LOT, "term")]
    balances = days.withColumn("inside", inside).alias("d").join(opening.alias("o"), same).select(
        *[f"d.{k}" for k in LOT], F.lit("balance").alias("kind"), "day", (F.col("opening") + F.col("inside")).alias("quantity")
    )
    written = terms.filter("quantity > 0").select(*LOT, F.lit("write_off").alias("kind"), F.col("due_day").alias("day"), "quantity")
    return balances.unionByName(written)


def lot_state(movements: DataFrame, as_of: Column) -> DataFrame:
    """What a stream has to know of each lot to go on behind the day ``as_of``: its balance after that day's write-offs, and the latest expiry that is
    still to be written off (NULL without one)."""
    last = F.max_by(F.struct("balance", "due_day", "expiry_date"), "term").alias("last")
    state = lot_terms(movements, as_of).groupBy(*LOT).agg(last)
    return state.select(*LOT, F.col("last.balance").alias("balance"), F.when(F.col("last.due_day") > as_of, F.col("last.expiry_date")).alias("expiry"))


def movements_with_writeoffs(purchases: DataFrame, consumption: DataFrame, writeoffs: DataFrame) -> DataFrame:
    """One log from the three kinds of rows."""
    cols = [c for c in purchases.columns if c in writeoffs.columns]
    parts = [df.select(*cols) for df in (purchases, consumption, writeoffs)]
    parts = [p.withColumn("quantity", F.col("quantity").cast("bigint")) for p in parts]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def open_lots(movements: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Lots received that still hold stock after use and write-offs."""
    last = lot_terms(movements, as_of).groupBy(*LOT).agg(F.max_by("balance", "term").alias("balance")).filter("balance > 0")
    received = lot_balances(movements).filter("in_qty > 0").select(F.col(LOT[0]).alias("_h"), F.col(LOT[1]).alias("_s"), "lot_expiry")
    return last.join(received, F.col(LOT[0]).eqNullSafe(F.col("_h")) & F.col(LOT[1]).eqNullSafe(F.col("_s"))).drop("_h", "_s")
