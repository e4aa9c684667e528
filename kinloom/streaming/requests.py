"""Requests and their results as two streams: who was answered, late, or not at all.

The hand-over waits for a result for a while and goes on without it.  Here both sides are
streams: a left outer join within a time range keeps a request until the watermark says
that no result can come any more, and then lets it go unanswered; state on either side is
bounded by that range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ANSWERED, LATE, UNANSWERED = "answered", "late", "unanswered"


def with_results(
    requests: DataFrame,
    results: DataFrame,
    key: str,
    asked: str = "asked_at",
    answered: str = "answered_at",
    wait: str = "300 seconds",
    grace: str = "3600 seconds",
    lateness: str = "10 minutes",
) -> DataFrame:
    """Each request with its results and a status.

    ``answered``: a result within ``wait``; ``late``: one within ``grace``; ``unanswered``:
    none, as far as the watermark can tell.  Results before their request, beyond ``grace``
    or without request are left out, as are results without key; a request with several
    results gives a row for each; a request without key is unanswered.
    """
    left = requests.withWatermark(asked, lateness)
    found = results.withColumnsRenamed({key: "_key", answered: "_answered"}).withWatermark("_answered", lateness)
    within = (
        (F.col(key) == F.col("_key"))
        & (F.col("_answered") >= F.col(asked))
        & (F.col("_answered") <= F.col(asked) + F.expr(f"INTERVAL {grace}"))
    )
    status = (
        F.when(F.col("_answered").isNull(), UNANSWERED)
        .when(F.col("_answered") <= F.col(asked) + F.expr(f"INTERVAL {wait}"), ANSWERED)
        .otherwise(LATE)
    )
    joined = left.join(found, within, "leftOuter").withColumn("status", status)
    return joined.drop("_key").withColumnRenamed("_answered", answered)


def control(rows: DataFrame, batch: str) -> DataFrame:
    """One row per batch of requests: how many have each status, and DONE once none is unanswered."""
    counts = [F.count_if(F.col("status") == s).alias(s) for s in (ANSWERED, LATE, UNANSWERED)]
    out = rows.groupBy(batch).agg(*counts)
    return out.withColumn("STATUS", F.when(F.col(UNANSWERED) == 0, "DONE").otherwise("INCOMPLETE"))
