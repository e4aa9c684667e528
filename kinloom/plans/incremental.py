"""The incremental job: next batch, enrich, resolve, record the outcome.

The store is kept in buckets of the record key.  A version of the store is a manifest
that names, per bucket, the version that last wrote it; a batch writes the buckets it
changes and the next manifest, and leaves all other files alone.  Manifests and data are
never changed once written, so a lost executor or a failed run cannot leave a half-written
store, and a repeated run reads what it read before and overwrites only its own output.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import batches
from ..operators.match import record_key
from ..operators.rules import RunContext
from .resolve import resolve_batch

BUCKETS = 64


def _manifest(folder: str, version: int) -> str:
    return f"{folder.rstrip('/')}/manifest/version={version:08d}"


def _data(folder: str, version: int) -> str:
    return f"{folder.rstrip('/')}/data/version={version:08d}"


def bucket_of(buckets: int):
    """The bucket of a row; rows without a full key are dealt by record id."""
    return F.pmod(F.xxhash64(F.coalesce(record_key(), F.col("batch_record_id").cast("string"))), F.lit(buckets)).cast("int")


def _entries(spark: SparkSession, folder: str, version: int) -> list[tuple[int, int]]:
    """(bucket, version that wrote it): one entry per bucket at most."""
    rows = spark.read.schema("bucket int, written int").json(_manifest(folder, version))
    return sorted((r.bucket, r.written) for r in rows.collect())


def write_store(rows: DataFrame, folder: str, version: int = 0, buckets: int = BUCKETS) -> None:
    """A whole store as version ``version``."""
    _write(rows.withColumn("bucket", bucket_of(buckets)), folder, version, {})


def read_store(spark: SparkSession, folder: str, version: int) -> DataFrame:
    paths = [f"{_data(folder, written)}/bucket={bucket}" for bucket, written in _entries(spark, folder, version)]
    return spark.read.option("mergeSchema", True).parquet(*paths)


def update_store(
    new_state: DataFrame, changed_keys: DataFrame, folder: str, version: int, buckets: int = BUCKETS
) -> list[int]:
    """Write version ``version + 1``: the buckets of ``changed_keys`` anew, the others by reference.

    Returns the buckets written.  ``changed_keys`` has the key columns and batch_record_id.
    """
    spark = new_state.sparkSession
    touched = sorted(r.bucket for r in changed_keys.select(bucket_of(buckets).alias("bucket")).distinct().collect())
    rows = new_state.withColumn("bucket", bucket_of(buckets)).filter(F.col("bucket").isin(touched))
    _write(rows, folder, version + 1, dict(_entries(spark, folder, version)))
    return touched


def _write(rows: DataFrame, folder: str, version: int, before: dict[int, int]) -> None:
    spark = rows.sparkSession
    rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(_data(folder, version))
    written = [r.bucket for r in spark.read.parquet(_data(folder, version)).select("bucket").distinct().collect()]
    entries = sorted((before | dict.fromkeys(written, version)).items())
    spark.createDataFrame(entries, "bucket int, written int").coalesce(1).write.mode("overwrite").json(_manifest(folder, version))


def resolving_handler(
    spark: SparkSession,
    store_folder: str,
    export_folder: str,
    context: RunContext,
    first_version: int = 0,
    enrich: Callable[[DataFrame], DataFrame] | None = None,
    buckets: int = BUCKETS,
) -> Callable[[DataFrame, int], None]:
    """A micro-batch handler for ``run_available``.

    Micro-batch ``n`` turns store version ``first + n`` into ``first + n + 1``;
    a retry reads and writes the same versions, export and ready record.
    """

    def handle(batch: DataFrame, number: int) -> None:
        stored = read_store(spark, store_folder, first_version + number)
        rows = enrich(batch) if enrich else batch
        result = resolve_batch(rows, stored, context)
        export = f"{export_folder.rstrip('/')}/batch={number:08d}"
        result.export.write.mode("overwrite").parquet(export)
        update_store(result.store, result.changed, store_folder, first_version + number, buckets)
        done = spark.read.parquet(export)
        ready = batches.ready_record(done, context.job_id, export)
        ready.write.mode("overwrite").json(f"{export_folder.rstrip('/')}-ready/batch={number:08d}")

    return handle


def run_incremental(
    spark: SparkSession,
    manifest: DataFrame,
    read: Callable[[Sequence[str]], DataFrame],
    handle: Callable[[DataFrame, int], None],
    as_of: str,
    max_items: int = 150,
    max_records: int = 50_000,
    save: Callable[[DataFrame, int], DataFrame] = lambda df, number: df,
) -> DataFrame:
    """Batch after batch until no file of the manifest is ready: bounds, work, outcome.

    The files of a batch (at most ``max_items`` names) are marked complete, or failed with
    an expiry when ``handle`` raises; the loop then goes on with the next batch.  ``save``
    stores the manifest of each round and returns it as read back.
    """
    number, attempt = 0, 0
    while True:
        chosen = batches.next_batch(manifest.filter(F.col("status") == batches.READY), max_items, max_records)
        names = [r.file_name for r in chosen.select("file_name").orderBy("file_name").collect()]
        if not names:
            return manifest
        try:
            handle(read(names), number)
            ok = True
            number += 1  # a failed batch leaves the store at its version
        except Exception as error:  # whatever went wrong is the batch's outcome
            print(f"batch of {names[0]} failed: {error}")
            ok = False
        outcome = spark.createDataFrame([(n, ok) for n in names], "file_name string, ok boolean")
        manifest = save(batches.mark(manifest, outcome, as_of), attempt)
        attempt += 1

