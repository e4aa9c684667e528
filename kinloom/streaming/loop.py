"""The incremental loop as a stream of bounded micro-batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def file_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    fmt: str = "parquet",
    max_files: int = 150,
    pattern: str | None = None,
    **options: str,
) -> DataFrame:
    """Files of a folder, at most ``max_files`` per micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files).options(**options)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(folder)


def write_batches(folder: str) -> Callable[[DataFrame, int], None]:
    """Micro-batch writer that a retry cannot duplicate: one folder per batch,
    replaced as a whole."""

    def write(df: DataFrame, number: int) -> None:
        df.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/batch={number}")

    return write


def run_available(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    """Process everything that is there, then stop: the batch loop without polling.

    Progress is kept in ``checkpoint``; a failed micro-batch is not recorded as
    done and runs again.
    """
    query = (
        stream.writeStream.foreachBatch(handle)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return query


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for as long as a stream runs."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
