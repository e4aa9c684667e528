"""Group-wise elections that hold when one group owns a third of the rows.

``row_number() = 1`` is planned with a group limit in front of the shuffle, so a
hot group sends one row per map task.  Results go back to the rows through an
N:1 join, whose hot partitions adaptive execution splits; null keys are spread
because no group can own them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column], k: int = 1) -> DataFrame:
    """The first ``k`` rows of each group; ``order`` must end in a unique column."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")


def attach(rows: DataFrame, groups: DataFrame, key: str, row_id: str | None = None) -> DataFrame:
    """Left join one row per key onto the rows.

    With ``row_id`` the rows without key are hashed by their id instead of all
    meeting in one partition.
    """
    if row_id is None:
        return rows.join(groups, key, "left")
    spread = F.coalesce(F.col(key), F.concat(F.lit("\u0000"), F.col(row_id).cast("string")))
    right = groups.withColumnRenamed(key, "_group_key")
    return rows.withColumn("_join_key", spread).join(right, F.col("_join_key") == F.col("_group_key"), "left").drop(
        "_join_key", "_group_key"
    )


# Oldest first, then surest, then by id: the order identities are elected in.
def election_order(
    ts: str = "id_res_last_updated_timestamp", confidence: str = "uxid_confidence", row_id: str = "batch_record_id"
) -> list[Column]:
    return [
        F.col(ts).asc_nulls_last(),
        F.col(confidence).cast("double").desc_nulls_last(),
        F.col(row_id).asc_nulls_last(),
    ]
