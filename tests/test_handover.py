"""A ledger stream that starts where a batch has left off, with late movements kept apart."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from larder.operators import ledger as L
from larder.streaming.ledger import STATE_STORE, ledger_stream, on_time_and_late
from larder.streaming.run import drain

SCHEMA = "row_id long, household_id int, stock_id string, product_id long, product_name string, event_type string, quantity int, timestamp timestamp_ntz, expiry_date date"


def rows():
    out, day = [], dt.datetime(2024, 1, 1, 9)
    plan = [(0, "a", "IN", 5, 3), (1, "a", "OUT", 2, 0), (4, "b", "IN", 3, 20), (6, "a", "IN", 4, 9), (7, "c", "OUT", 1, 0), (9, "b", "OUT", 1, 0), (12, "a", "OUT", 1, 0),
            (13, "c", "IN", 2, 1), (19, "b", "IN", 1, 2), (25, "a", "IN", 1, 30), (40, "z", "IN", 1, 90)]
    for k, (d, lot, kind, n, life) in enumerate(plan):
        at = day + dt.timedelta(days=d)
        out.append((k, 1, f"1-{lot}", 7, "p", kind, n, at, (at + dt.timedelta(days=life)).date() if kind == "IN" else None))
    return out


def plain(df):
    return sorted((r.stock_id, r.kind, r.day, r.quantity) for r in df.collect())


@pytest.mark.parametrize("closed", [3, 8, 10, 22])
def test_batch_and_stream_give_the_whole_log(spark, tmp_path, closed):
    log = spark.createDataFrame(rows(), SCHEMA)
    end = F.lit(dt.date(2024, 1, 1) + dt.timedelta(days=closed))
    log.coalesce(1).write.parquet(f"{tmp_path}/log")
    stream, late = on_time_and_late(spark.readStream.schema(log.schema).parquet(f"{tmp_path}/log"), end)
    early = log.filter(F.to_date("timestamp") <= end)
    later = drain(ledger_stream(stream, start=L.lot_state(early, end)), f"handover{closed}", STATE_STORE)
    # The lot of the last row only moves the watermark behind all write-off days before it.
    last = F.lit(dt.date(2024, 2, 8))
    both = L.daily_ledger(early, end).unionByName(later).filter("stock_id <> '1-z'").filter(F.col("day") <= last)
    want = L.daily_ledger(log, last).filter("stock_id <> '1-z'")
    assert plain(both) == plain(want)
    # Movements of closed days are not lost: they are the rows of the side table.
    assert drain(late.select("row_id", "timestamp"), f"late{closed}").count() == early.count()
