"""Streams drained over the event table as registered queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.operators import ledger as L
from larder.plans.registry import query
from larder.plans.relational import LOT_STATES, _numbered, big
from larder.plans.views import with_views
from larder.session import cut
from larder.sources import bindings as B
from larder.streaming.ledger import STATE_STORE, ledger_stream, on_time_and_late
from larder.streaming.run import drain
from larder.streaming.sessions import session_stream


@query(
    "stream_sessions",
    with_views(
        "movements",
        f"""WITH {_numbered('OUT', 900)}
          SELECT household_id, min(timestamp) AS session_start, max(timestamp) AS session_end,
            count(*) AS n_events, CAST(sum(quantity) AS BIGINT) AS quantity FROM numbered GROUP BY household_id, session_no""",
    ),
)
def stream_sessions(spark, d):
    return big(B.without_closing(drain(session_stream(B.movement_stream(spark, d), "OUT"), "sessions")))


LEDGER_ROWS = with_views(
    "movements",
    f"""WITH RECURSIVE {LOT_STATES}
      SELECT household_id, stock_id, 'balance' AS kind, day, balance AS quantity FROM states WHERE rn > 0
      UNION ALL SELECT household_id, stock_id, 'write_off', due, quantity FROM w""",
)


@query("stream_ledger", LEDGER_ROWS)
def stream_ledger(spark, d):
    """Balances, and the write-offs up to the last day of the log."""
    last = B.movements(spark, d).agg(F.max(F.to_date("timestamp"))).scalar()
    rows = B.without_closing(drain(ledger_stream(B.movement_stream(spark, d)), "ledger", STATE_STORE))
    return big(rows.filter((F.col("kind") == "balance") | (F.col("day") <= last)))


@query("ledger_handover", LEDGER_ROWS)
def ledger_handover(spark, d):
    """The first half of the log as a batch, the rest as a stream that starts from the state the batch has left: together the rows of the whole log."""
    log = B.movements(spark, d)
    days = log.agg(F.min(F.to_date("timestamp")).alias("first"), F.max(F.to_date("timestamp")).alias("last")).first()
    closed, last = F.lit(days["first"] + (days["last"] - days["first"]) // 2), F.lit(days["last"])
    early = cut(on_time_and_late(log, closed)[1])
    stream = on_time_and_late(B.movement_stream(spark, d), closed)[0]
    later = B.without_closing(drain(ledger_stream(stream, start=cut(L.lot_state(early, closed))), "handover", STATE_STORE))
    later = later.filter((F.col("kind") == "balance") | (F.col("day") <= last))
    return big(L.daily_ledger(early, closed).unionByName(later))


@query("daily_ledger", LEDGER_ROWS)
def daily_ledger(spark, d):
    """The same rows from the table."""
    return big(L.daily_ledger(B.movements(spark, d)))
