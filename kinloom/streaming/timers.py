"""Alarms of keys that fall silent: state with event-time timers.

``observe.alarm_stream`` fills a gap when the next period of a key arrives, so a key that
stays silent never alarms.  Here each key sets a timer at the end of the period it expects;
when the watermark passes it without data, the period counts as missing, the state is
written out, and the next timer is set.  A key that has been silent for ``dead_after``
periods is forgotten: its state and timers go, and should it come back it starts anew.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.logs import UNITS, Alarm
from ..session import package_for_workers

_STATE = "last bigint, own bigint, flags array<boolean>"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class SilentKeys(StatefulProcessor):
    """One row per key and period, data or not, as long as the key lives; times in milliseconds."""

    def __init__(self, key: str, step: int, alarm: Alarm, dead_after: int):
        self.key, self.step, self.dead = key, step, dead_after * step
        self.n, self.m, self.gap = alarm.n, alarm.m, alarm.missing_breaches

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("alarm", _STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # One row per period of one key.
        arrived = pd.concat(list(rows)).sort_values("at").drop_duplicates("at")
        yield from self._advance(key, list(zip(arrived["at"].tolist(), arrived["breach"].tolist(), strict=True)), timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._advance(key, [], timerValues)

    def close(self) -> None:
        pass

    def _advance(self, key, arrived: list[tuple[int, bool]], timers) -> Iterator[pd.DataFrame]:
        last = own = None
        flags: list[bool] = []
        if self.state.exists():
            last, own, flags = self.state.get()
            flags = list(flags)
        out: list[tuple[int, int]] = []

        def step(at: int, breach: bool) -> None:
            flags.append(bool(breach))
            del flags[: -self.n]
            out.append((at, sum(flags)))

        def silent(upto: int) -> None:
            nonlocal last
            while last is not None and last + self.step <= min(upto, own + self.dead):
                last += self.step
                step(last, self.gap)

        for at, breach in arrived:
            if last is not None and at <= last:
                continue  # was missing when its time was over
            silent(at - self.step)
            if own is not None and at - own > self.dead:
                flags.clear()  # it had died before
            last = own = at
            step(at, breach)
        watermark = timers.getCurrentWatermarkInMs()
        silent(watermark - self.step)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if last is None or last >= own + self.dead:
            self.state.clear()
        else:
            self.state.update((last, own, flags))
            self.handle.registerTimer(last + 2 * self.step)
        if out:
            yield pd.DataFrame(
                {self.key: key[0], "at": [a for a, _ in out], "breaches": [c for _, c in out], "state": ["ALARM" if c >= self.m else "OK" for _, c in out]}
            )


def silent_alarms(
    events: DataFrame, alarm: Alarm, value: str, key: str, dead_after: int, lateness: str = "10 minutes", ts: str = "ts"
) -> DataFrame:
    """(key, period, breaches, state) of every period of every living key, as the watermark closes it.

    A period is written once its end lies behind the watermark, with its data or without.
    The session needs the ``PROVIDER`` state store while the stream starts.
    """
    fold = {"avg": F.avg, "sum": F.sum, "max": F.max, "min": F.min}[alarm.statistic]
    window = F.window(ts, alarm.period)
    closed = events.withWatermark(ts, lateness).groupBy(window.alias("w"), key)
    closed = closed.agg(F.round(fold(value).cast("double") * F.lit(UNITS["none"]), 6).alias("value"))
    judged = closed.select(
        key,
        F.unix_millis(F.col("w.start").cast("timestamp")).alias("at"),
        F.coalesce(alarm.breaches(F.col("value")), F.lit(alarm.missing_breaches)).alias("breach"),
        F.window_time("w").alias("closed_at"),
    )
    step = int(pd.Timedelta(alarm.period).total_seconds() * 1000)
    kind = events.schema[key].dataType.simpleString()
    package_for_workers(events.sparkSession)
    states = judged.groupBy(key).transformWithStateInPandas(
        SilentKeys(key, step, alarm, dead_after),
        outputStructType=f"{key} {kind}, at bigint, breaches int, state string",
        outputMode="append",
        timeMode="eventTime",
    )
    return states.select(key, F.timestamp_millis("at").alias("period"), "breaches", "state")
