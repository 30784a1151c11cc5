"""Lot balances and expiry write-offs on a stream of movements.

Movements are first added up per lot and day by a windowed aggregation, map-side before the shuffle, so that the state
of a hot lot sees one row a day. The state holds the balance and the latest expiry; an event-time timer writes off what
is left at the end of the write-off day.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from larder.functions.scalars import GRACE_DAYS
from larder.operators.ledger import LOT, signed_quantity

OUTPUT = "household_id int, stock_id string, kind string, day date, quantity long"
STATE = "balance long, expiry long"
NO_EXPIRY = -1
DAY_MS = 86_400_000
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _due(expiry: int) -> int:
    return expiry + GRACE_DAYS + 1


def _closes(expiry: int) -> int:
    """End of the write-off day, in milliseconds."""
    return (_due(expiry) + 1) * DAY_MS


def _frame(key, rows: list) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "household_id": [int(key[0])] * len(rows),
            "stock_id": [str(key[1])] * len(rows),
            "kind": [k for k, _, _ in rows],
            "day": pd.to_datetime([d for _, d, _ in rows], unit="D").date,
            "quantity": [q for _, _, q in rows],
        }
    )


class LotLedger(StatefulProcessor):
    """Balance and latest expiry of one lot; input: one row per day with movements, complete up to the watermark."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.lot = handle.getValueState("lot", STATE)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        """A lot as the batch left it."""
        row = initialState.iloc[0]
        expiry = int(row["expiry"])
        self.lot.update((int(row["balance"]), expiry))
        if expiry != NO_EXPIRY:
            self.handle.registerTimer(_closes(expiry))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        balance, expiry = self.lot.get() if self.lot.exists() else (0, NO_EXPIRY)
        before, out = expiry, []
        for r in pd.concat(list(rows)).sort_values("day").itertuples(index=False):
            if expiry != NO_EXPIRY and _due(expiry) < r.day:
                if balance > 0:
                    out.append(("write_off", _due(expiry), balance))
                    balance = 0
                expiry = NO_EXPIRY
            balance += int(r.net)
            if not pd.isna(r.expiry):
                expiry = max(expiry, int(r.expiry))
            out.append(("balance", int(r.day), balance))
        self.lot.update((balance, expiry))
        if expiry != before:
            if before != NO_EXPIRY:
                self.handle.deleteTimer(_closes(before))
            if expiry != NO_EXPIRY:
                self.handle.registerTimer(_closes(expiry))
        yield _frame(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        balance, expiry = self.lot.get()
        if expiry == NO_EXPIRY or expiredTimerInfo.getExpiryTimeInMs() != _closes(expiry):
            return
        self.lot.update((min(balance, 0), NO_EXPIRY))
        if balance > 0:
            yield _frame(key, [("write_off", _due(expiry), balance)])

    def close(self) -> None:
        pass


def on_time_and_late(movements: DataFrame, closed: Column) -> tuple[DataFrame, DataFrame]:
    """Movements behind the day up to which a batch has closed the books, and those of closed days, which belong in a table of their own: the
    balances that they would change are given out already."""
    day = F.to_date("timestamp")
    return movements.filter(day > closed), movements.filter(day <= closed)


def ledger_stream(movements: DataFrame, lateness: str = "1 day", start: DataFrame | None = None) -> DataFrame:
    """(household_id, stock_id, kind, day, quantity): the balance after each day with movements, and write-offs.

    ``start`` is the state a batch has left (``operators.ledger.lot_state``); the stream then takes up movements behind that day. The query has to run with the
    RocksDB state store (``STATE_STORE``).
    """
    days = lambda c: F.unix_date(c).cast("bigint")
    events = movements.select(
        *LOT,
        F.col("timestamp").cast("timestamp").alias("ts"),
        signed_quantity().alias("signed"),
        F.when(F.col("event_type") == "IN", days(F.col("expiry_date"))).alias("expiry"),
    ).withWatermark("ts", lateness)
    daily = events.groupBy(*LOT, F.window("ts", "1 day").alias("window")).agg(
        F.sum("signed").alias("net"), F.max("expiry").alias("expiry")
    )
    rows = daily.select(
        *LOT,
        F.window_time("window").alias("event_time"),
        days(F.to_date("window.start")).alias("day"),
        "net",
        "expiry",
    )
    opening = None if start is None else start.select(*LOT, "balance", F.coalesce(days(F.col("expiry")), F.lit(NO_EXPIRY)).alias("expiry")).groupBy(*LOT)
    return rows.groupBy(*LOT).transformWithStateInPandas(LotLedger(), OUTPUT, "Append", "EventTime", opening)
