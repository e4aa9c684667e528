"""Log bins and alarms over streams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.logs import Alarm, minute_bins, period_statistic

PIECE = 100_000  # periods written at a time


def closed_bins(fields: DataFrame, lateness: str = "10 minutes", ts: str = "ts", width: str = "1 minute") -> DataFrame:
    """Minute bins of a stream; a bin is emitted once the watermark has passed it."""
    return minute_bins(fields.withWatermark(ts, lateness), ts, width)


def closed_periods(
    df: DataFrame, alarm: Alarm, value: str, key: str, lateness: str = "10 minutes", ts: str = "ts"
) -> DataFrame:
    """Period statistics of a stream, first stage of a streaming alarm."""
    return period_statistic(df.withWatermark(ts, lateness), value, alarm.period, [key], alarm.statistic, ts=ts)


def alarm_stream(periods: DataFrame, alarm: Alarm, key: str) -> DataFrame:
    """Alarm states from a stream of closed periods (key, period, value).

    Breaches are judged by the engine; the state of a key is its last period and its last
    ``n`` flags.  Gaps between periods are filled when the next one arrives, as arrays and
    piece by piece, and a period that is not newer than the last one changes nothing.
    """
    step = int(pd.Timedelta(alarm.period).total_seconds())
    n, m, gap = alarm.n, alarm.m, alarm.missing_breaches

    def advance(name: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, flags = (state.get[0], np.array(state.get[1], bool)) if state.exists else (None, np.empty(0, bool))
        # One row per period of one key, two numbers each.
        arrived = pd.concat(list(frames)).sort_values("at").drop_duplicates("at")
        if last is not None:
            arrived = arrived[arrived["at"] > last]
        at, breach = arrived["at"].to_numpy(np.int64), arrived["breach"].to_numpy(bool)
        begin = 0
        while begin < len(at):
            first = at[begin] if last is None else last + step
            # As many arrivals as fit into a piece of PIECE periods; at least one.
            end = max(int(np.searchsorted(at, first + PIECE * step)), begin + 1)
            upto = min(at[end - 1], first + PIECE * step)  # a gap longer than a piece is filled in pieces
            moments = np.arange(first, upto + 1, step)
            now = np.full(len(moments), gap)
            known = at[begin:end][at[begin:end] <= upto]
            now[(known - first) // step] = breach[begin : begin + len(known)]
            whole = np.concatenate((flags, now))
            sums = np.concatenate(([0], np.cumsum(whole)))
            ends = np.arange(len(flags) + 1, len(whole) + 1)
            counts = sums[ends] - sums[np.maximum(ends - n, 0)]
            yield pd.DataFrame({key: name[0], "at": moments, "breaches": counts, "state": np.where(counts >= m, "ALARM", "OK")})
            flags, last, begin = whole[-n:], int(moments[-1]), begin + len(known)
        if last is not None:
            state.update((last, [bool(f) for f in flags]))

    kind = periods.schema[key].dataType.simpleString()
    judged = periods.select(
        key,
        F.unix_timestamp(F.col("period").cast("timestamp")).alias("at"),
        F.coalesce(alarm.breaches(F.col("value")), F.lit(gap)).alias("breach"),
    )
    states = judged.groupBy(key).applyInPandasWithState(
        advance,
        f"{key} {kind}, at bigint, breaches int, state string",
        "last bigint, flags array<boolean>",
        "append",
        GroupStateTimeout.NoTimeout,
    )
    return states.select(key, F.timestamp_seconds("at").alias("period"), "breaches", "state")
