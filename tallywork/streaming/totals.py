"""Running totals over a stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle, TimerValues

from tallywork.functions.user_functions import partial_sums
from tallywork.operators.partitions import persisted
from tallywork.streaming.buckets import BucketTable
from tallywork.streaming.runner import BatchAction


def running_total(stream: DataFrame, keys: list[str], value: str, name: str = "amount") -> DataFrame:
    """Total per key since the start.

    Run it in `complete` mode to get all keys with each batch, or in `update`
    mode to get the keys the batch has touched. Spark sums within each batch
    before it meets the state. Keys never expire.
    """
    return stream.groupBy(*keys).agg(F.sum(value).alias(name))


def running_total_stateful(stream: DataFrame, key: str, units: str, name: str = "total") -> DataFrame:
    """`running_total` of a long column with user code for the state, in `update` mode.

    One state value per key and one output row per key and batch. Arrow batches
    are reduced to one row per key before the shuffle, so that the task of a hot
    key receives sums and not rows.
    """
    output = T.StructType([stream.schema[key], T.StructField(name, T.LongType())])
    state = T.StructType([T.StructField("total", T.LongType())])

    def update(
        group: tuple, batches: Iterator[pd.DataFrame], saved: GroupState
    ) -> Iterator[pd.DataFrame]:
        total = saved.get[0] if saved.exists else 0
        for batch in batches:
            total += int(batch["_sum"].sum())
        saved.update((total,))
        yield pd.DataFrame({key: [group[0]], name: [total]})

    return (
        partial_sums(stream, [key], units)
        .groupBy(key)
        .applyInPandasWithState(update, output, state, "update", GroupStateTimeout.NoTimeout)
    )


def daily_total(
    stream: DataFrame, instant: str, keys: list[str], value: str, lateness: str | None = None
) -> DataFrame:
    """Totals that start from nothing each day, as `day_window`, keys, `amount` and `cnt`.

    Every row counts, however late, and days stay in the state. With a
    `lateness` Spark forgets days that its watermark has passed, and rows for
    them are dropped; `runner.late_rows` tells how many.
    """
    return (
        (stream.withWatermark(instant, lateness) if lateness else stream)
        .groupBy(F.window(instant, "1 day").alias("day_window"), *keys)
        .agg(F.sum(value).alias("amount"), F.count(F.lit(1)).alias("cnt"))
    )


DAY_MS = 86_400_000


class DayTotals(StatefulProcessor):
    """Sums of one key for the days that are still open, which a timer ends.

    Input rows are sums of Arrow batches: key, `part_day` (milliseconds),
    `part_sum` and `part_count`. Every batch gives back what its rows have changed: a key and day,
    its sums so far, and `late` as false. A day's sums are forgotten when the
    watermark has passed its end and the last sums are out. Rows of a day that
    is forgotten never open it again: they come back as they are, with `late`
    as true, for the stored day to be raised by them.
    """

    def __init__(self, key: str) -> None:
        self.key = key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.days = handle.getMapState("days", "day long", "amount long, cnt long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        sums: dict[int, list[int]] = {}
        for batch in rows:
            for day, amount, cnt in zip(*(batch[name].tolist() for name in ("part_day", "part_sum", "part_count"))):
                held = sums.setdefault(day, [0, 0])
                held[0] += amount
                held[1] += cnt
        out = []
        for day, (amount, cnt) in sums.items():
            late = day + DAY_MS <= watermark
            if not late:
                if self.days.containsKey((day,)):
                    saved = self.days.getValue((day,))
                    amount, cnt = amount + saved[0], cnt + saved[1]
                else:
                    self.handle.registerTimer(day + DAY_MS)
                self.days.updateValue((day,), (amount, cnt))
            out.append((key[0], day, amount, cnt, late))
        yield self._frame(out)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        day = expiredTimerInfo.getExpiryTimeInMs() - DAY_MS
        if self.days.containsKey((day,)):
            self.days.removeKey((day,))
        yield self._frame([])

    def close(self) -> None:
        pass

    def _frame(self, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=[self.key, "day", "amount", "cnt", "late"])


def day_totals(stream: DataFrame, instant: str, key: str, units: str, lateness: str) -> DataFrame:
    """Changes of the totals per key and day of a long column, whose state ends with the day.

    State holds the days that the watermark has not passed: with rows in order
    and a lateness below a day, two. Nothing is dropped, however late. Use it in
    `update` mode with `day_table_action`, and RocksDB as the state store.
    Each Arrow batch is reduced to one row per key and day before the shuffle.
    """
    millis = F.unix_millis(F.col(instant))
    day = millis - F.pmod(millis, F.lit(DAY_MS))
    rows = stream.withWatermark(instant, lateness).select(key, day.alias("_day"), units)
    sums = partial_sums(rows, [key, "_day"], units).withColumnsRenamed({"_day": "part_day", "_sum": "part_sum", "_count": "part_count"})
    output = T.StructType([
        stream.schema[key], *[T.StructField(name, T.LongType()) for name in ("day", "amount", "cnt")], T.StructField("late", T.BooleanType()),
    ])
    return sums.groupBy(key).transformWithStateInPandas(DayTotals(key), output, "Update", "EventTime")


def day_table_action(table: BucketTable) -> BatchAction:
    """Action that keeps the totals of all days in a table: open days are replaced, late rows added to what is stored.

    The table has the keys key and `day`. A repeated batch finds the table as it
    was before the batch, so late rows are added once.
    """

    def action(batch: DataFrame, batch_id: int) -> None:
        keys = [name for name in batch.columns if name not in ("amount", "cnt", "late")]

        def summed(rows: DataFrame) -> DataFrame:
            return rows.groupBy(*keys).agg(F.sum("amount").alias("amount"), F.sum("cnt").alias("cnt"))

        with persisted(batch):  # used twice; without it the state would be run through twice
            late = summed(batch.filter("late"))
            raised = summed(table.rows_before(batch_id, late).unionByName(late))
            table.commit(batch.filter(~F.col("late")).drop("late").unionByName(raised), batch_id)

    return action
