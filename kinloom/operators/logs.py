"""Job logs and metrics: field extraction, durations, period statistics, alarms."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import column

# What the log lines look like.
JOB = r"(\d{14}_\w+_search_\w+)"
JOB_TYPE = r"\d{14}_(\w+)_search_\w+"
RETRY = r"opensearch_client_error_retry_count is #(\d+)"
DELAY = r"next opensearch_client_retry#0 in (\d+\.\d+) seconds"
PROGRESS = r"msearch: done (\d+) of (\d+)"


def _number(message: Column, pattern: str, group: int, kind: str) -> Column:
    text = F.regexp_extract(message, pattern, group)
    return F.when(text != "", text).cast(kind)


def extract_fields(df: DataFrame, message: str = "message") -> DataFrame:
    """Adds job id and type, retry count, delay and progress; absent ones null."""
    m = F.col(message)
    job, kind = F.regexp_extract(m, JOB, 1), F.regexp_extract(m, JOB_TYPE, 1)
    return df.withColumns(
        {
            "job_id": F.when(job != "", job),
            "job_type": F.when(kind != "", kind),
            "retry_count": _number(m, RETRY, 1, "bigint"),
            "retry_delay": _number(m, DELAY, 1, "double"),
            "done": _number(m, PROGRESS, 1, "bigint"),
            "total": _number(m, PROGRESS, 2, "bigint"),
        }
    )


def retry_summary(fields: DataFrame, ts: str = "ts") -> DataFrame:
    """Per job: most retries and the latest delay that was logged."""
    timed = F.when(F.col("retry_delay").isNotNull(), F.struct(ts, "retry_delay"))
    return fields.groupBy("job_id", "job_type").agg(
        F.max("retry_count").alias("max_retry_count"),
        F.max_by("retry_delay", timed).alias("retry_delay_secs"),
    )


def minute_bins(fields: DataFrame, ts: str = "ts", width: str = "1 minute") -> DataFrame:
    """Per job and tumbling bin: last progress, total, most retries.

    Works on a batch and, with a watermark on ``ts``, on a stream.
    """
    return (
        fields.groupBy(F.window(ts, width).alias("_w"), "job_id")
        .agg(
            F.max("done").alias("last_done"),
            F.max("total").alias("total"),
            F.max("retry_count").alias("max_retry_count"),
        )
        .select(F.col("_w.start").alias("bin"), "job_id", "last_done", "total", "max_retry_count")
    )


def span_durations(
    df: DataFrame, markers: Sequence[str], message: str = "message", ts: str = "ts", by: Sequence[str] = ()
) -> DataFrame:
    """First to last line holding any marker, per group, in milliseconds."""
    hit = F.lit(False)
    for marker in markers:
        hit = hit | F.col(message).rlike(marker)
    start, end = F.min(ts).alias("span_start"), F.max(ts).alias("span_end")
    spans = df.filter(hit).groupBy(*by).agg(start, end) if by else df.filter(hit).agg(start, end)
    millis = F.unix_millis(F.col("span_end").cast("timestamp")) - F.unix_millis(F.col("span_start").cast("timestamp"))
    return spans.withColumn("duration_ms", millis)


# Unit factors of the charts.
UNITS = {"hours": 1 / 3600, "percent": 100.0, "seconds": 1 / 1000, "gigabytes": 1 / 10**9, "none": 1.0}


def period_statistic(
    df: DataFrame,
    value: str | Column,
    period: str,
    by: Sequence[str],
    statistic: str = "avg",
    unit: str = "none",
    ts: str = "ts",
    digits: int = 6,
) -> DataFrame:
    """Statistic per key and period: ``avg``, ``sum``, ``max`` or ``min``, scaled."""
    f = {"avg": F.avg, "sum": F.sum, "max": F.max, "min": F.min}[statistic]
    scaled = f(column(value)).cast("double") * F.lit(UNITS[unit])
    return (
        df.groupBy(F.window(ts, period).alias("_w"), *by)
        .agg(F.round(scaled, digits).alias("value"))
        .select(F.col("_w.start").alias("period"), *by, "value")
    )


@dataclass(frozen=True)
class Alarm:
    """``m`` of the last ``n`` periods breaching raises the alarm."""

    name: str
    statistic: str
    comparison: str
    threshold: float
    m: int = 1
    n: int = 1
    period: str = "300 seconds"
    missing_breaches: bool = False

    def breaches(self, value: Column) -> Column:
        tests = {
            ">": value > self.threshold,
            ">=": value >= self.threshold,
            "<": value < self.threshold,
            "<=": value <= self.threshold,
        }
        return tests[self.comparison]


# The alarms in use.
ALARMS = [
    Alarm("capacity use", "avg", ">", 90, 6, 6),
    Alarm("cache hit ratio", "avg", "<", 99, 3, 3, missing_breaches=True),
    Alarm("queue depth (warn)", "avg", ">", 5, 3, 3),
    Alarm("queue depth (critical)", "avg", ">", 100, 3, 3),
    Alarm("search retries", "max", ">=", 5),
    Alarm("graph retries", "max", ">=", 3),
    Alarm("client-error retries", "max", ">=", 19),
]


def alarm_states(df: DataFrame, alarm: Alarm, value: str, key: str, ts: str = "ts") -> DataFrame:
    """State of each key in each period from its first to its last.

    The rolling count runs over one row per key and period, after aggregation, so
    its input is bounded by the time covered and not by the volume of a hot key.
    """
    stats = period_statistic(df, value, alarm.period, [key], alarm.statistic, ts=ts)
    spans = stats.groupBy(key).agg(F.min("period").alias("_lo"), F.max("period").alias("_hi"))
    # Two steps, so that no row ever holds more than the periods of one day.
    step, day = F.expr(f"INTERVAL {alarm.period}"), 86_400
    seconds = F.expr(f"timestampdiff(SECOND, TIMESTAMP '2000-01-01', TIMESTAMP '2000-01-01' + INTERVAL {alarm.period})")
    per_day = F.greatest(F.floor(F.lit(day) / seconds), F.lit(1)) * seconds
    lo, hi = F.unix_timestamp(F.col("_lo").cast("timestamp")), F.unix_timestamp(F.col("_hi").cast("timestamp"))
    chunks = spans.select(key, "_lo", "_hi", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((hi - lo) / per_day))).alias("_c"))
    first = F.col("_lo") + F.make_dt_interval(secs=(F.col("_c") * per_day).cast("decimal(18,6)"))
    last = F.least(F.col("_hi"), F.col("_lo") + F.make_dt_interval(secs=((F.col("_c") + 1) * per_day - seconds).cast("decimal(18,6)")))
    grid = chunks.select(key, F.explode(F.sequence(first, last, step)).alias("period"))
    filled = grid.join(stats, [key, "period"], "left")
    breach = F.coalesce(alarm.breaches(F.col("value")), F.lit(alarm.missing_breaches))
    recent = Window.partitionBy(key).orderBy("period").rowsBetween(-(alarm.n - 1), 0)
    return filled.withColumns(
        {"breach": breach, "breaches": F.sum(breach.cast("int")).over(recent).cast("int")}
    ).withColumn("state", F.when(F.col("breaches") >= alarm.m, "ALARM").otherwise("OK"))
