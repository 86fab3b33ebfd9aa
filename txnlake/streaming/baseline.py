"""Baselines of days as a stateful stream: what a subcategory spent in the days before each of its days, kept current as rows come in.

State is a map of day sums for each subcategory: as many entries as it has days, whatever its rows. A batch's rows are summed for each
day before they are shuffled, so a subcategory with a third of all rows sends a row for each of its days and Arrow batch. A batch gives
the baselines of its own days and, where it is late, of the known days that its days reach; nothing else is looked at again. After any order
of batches the last row given for a day is that of the whole.

Loads keep the same sums beside silver, in its own commits (silver.daily_spend), as rows are only known to be new there; this operator is
for streams that are watched before they are loaded.
"""

from __future__ import annotations

import datetime as dt
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def partial_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(subcategory, day, n, s, q, m) of each batch of (subcategory, day, cents)."""
    for b in batches:
        rows: dict[tuple, list[int]] = {}
        for sub, day, cents in zip(b["subcategory"], b["day"], b["cents"]):
            c = int(cents)
            own = rows.setdefault((sub, day), [0, 0, 0, c])
            own[:] = own[0] + 1, own[1] + c, own[2] + c * c, max(own[3], c)
        yield pd.DataFrame([(*k, v[0], v[1], str(v[2]), v[3]) for k, v in rows.items()], columns=["subcategory", "day", "n", "s", "q", "m"])


def baselines(sums: dict[dt.date, tuple[int, int, int, int]], wanted: set[dt.date], window: int) -> list[tuple]:
    """(day, n, s, q, m) over the `window` days before each wanted day; a sliding sum and a queue of maxima."""
    out, n, s, q, held, largest = [], 0, 0, 0, deque(), deque()
    for day in sorted(sums):
        while held and held[0] < day - dt.timedelta(days=window):
            old = held.popleft()
            n, s, q = n - sums[old][0], s - sums[old][1], q - sums[old][2]
            if largest and largest[0] == old:
                largest.popleft()
        if day in wanted:
            out.append((day, n, s, q, sums[largest[0]][3] if largest else None))
        own = sums[day]
        n, s, q = n + own[0], s + own[1], q + own[2]
        held.append(day)
        while largest and sums[largest[-1]][3] <= own[3]:
            largest.pop()
        largest.append(day)
    return out


class DayBaselines(StatefulProcessor):
    def __init__(self, window: int):
        self.window = window

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.days = handle.getMapState("days", "day date", "n long, s long, q string, m long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        fresh: dict[dt.date, tuple[int, int, int, int]] = {}
        for b in rows:
            for day, n, s, q, m in zip(b["day"], b["n"], b["s"], b["q"], b["m"]):
                fresh[day] = _added(fresh.get(day), (int(n), int(s), int(q), int(m)))
        sums = {k[0]: (v[0], v[1], int(v[2]), v[3]) for k, v in self.days.iterator()}
        for day, new in fresh.items():
            sums[day] = _added(sums.get(day), new)
            self.days.updateValue((day,), (sums[day][0], sums[day][1], str(sums[day][2]), sums[day][3]))
        reached = {d for d in sums if d in fresh or any(0 < (d - f).days <= self.window for f in fresh)}
        found = baselines(sums, reached, self.window)
        yield pd.DataFrame([(key[0], d, n, s, str(q), m) for d, n, s, q, m in found], columns=["subcategory", "day", "n", "s", "q", "m"]).astype({"m": "Int64"})

    def close(self) -> None:
        pass


def _added(a, b):
    return b if a is None else (a[0] + b[0], a[1] + b[1], a[2] + b[2], max(a[3], b[3]))


def day_baselines(expenses: DataFrame, window: int = 365, amount: str = "amount_abs_eur", date: str = "transaction_date", group: str = "subcategory") -> DataFrame:
    """The days whose baselines changed, for a stream of expenses, in update mode. The session needs STATE_STORE as its state store.

    Rows without subcategory, date or amount have no baseline and are left out.
    """
    cents = F.round(F.col(amount).cast("decimal(12,2)") * 100).cast("long")
    rows = expenses.select(F.col(group).alias("subcategory"), F.col(date).cast("date").alias("day"), cents.alias("cents")).where("subcategory IS NOT NULL AND subcategory <> '' AND day IS NOT NULL AND cents IS NOT NULL")
    parts = rows.mapInPandas(partial_sums, "subcategory string, day date, n long, s long, q string, m long")
    out = parts.groupBy("subcategory").transformWithStateInPandas(DayBaselines(window), "subcategory string, day date, n long, s long, q string, m long", "Update", "None")
    return out.select("subcategory", "day", F.col("n").alias("hist_n_txns"), F.col("s").alias("hist_sum_cents"), F.col("q").cast("decimal(38,0)").alias("hist_squares_cents"), F.col("m").alias("hist_max_cents"))
