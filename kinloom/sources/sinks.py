"""Writers.  Row counts come from ``observe`` during the write, never from a
second pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.dates import instant, time_parts
from ..functions.keys import email_hash, record_id
from ..functions.text import lookup_key
from ..session import cut_lineage

PARTITIONS = ["year", "month", "day", "hour", "minute", "batch_id"]


def with_run_columns(df: DataFrame, as_of: str, batch_id: str) -> DataFrame:
    """Run time, its parts and the batch id; the pass-through column goes last."""
    out = df.withColumn("tx_datetime", instant(as_of)).withColumns(time_parts("tx_datetime"))
    out = out.withColumn("batch_id", F.lit(batch_id))
    last = [c for c in ("pass_thru_data",) if c in out.columns]
    return out.select(*[c for c in out.columns if c not in last], *last)


def write_partitioned(df: DataFrame, path: str, as_of: str, batch_id: str) -> tuple[str, int]:
    """One run below ``path``; returns its partition path and row count.

    A repeated run (same time and batch id) replaces its rows; other runs stay.
    """
    seen = Observation("write_partitioned")
    out = with_run_columns(df, as_of, batch_id)
    out.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*PARTITIONS).parquet(path)
    spark = df.sparkSession
    parts = spark.range(1).select(instant(as_of).alias("t")).select(
        *[c.alias(n) for n, c in time_parts("t").items()]
    ).first()
    folder = "/".join(f"{n}={parts[n]}" for n in PARTITIONS[:-1])
    return f"{path.rstrip('/')}/{folder}/batch_id={batch_id}", seen.get["rows"]


def overwrite_partitions(df: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """Replace only the partitions present in ``df``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def snapshot(df: DataFrame, folder: str | None, number: int, stage: str) -> DataFrame:
    """Debug dump of a stage, skipped without a folder; hands ``df`` on."""
    if folder:
        df.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{number:02d}_{stage}")
    return df


def _keyed(path: str, run: str) -> str:
    return f"{path.rstrip('/')}/run={run}"


def append_json(df: DataFrame, path: str, run: str) -> None:
    """Adds the rows of one run as JSON; a repeated run replaces its own rows and no others."""
    df.write.mode("overwrite").json(_keyed(path, run))


def append(df: DataFrame, path: str, run: str, fmt: str = "parquet", **options: str) -> None:
    """Adds the rows of one run to a table folder, where a repeated run replaces its own rows.

    With ``fmt='jdbc'`` the rows go to a database table that has a ``run`` column for the
    database to tell repeated rows by; there they are only added.
    """
    if fmt == "jdbc":
        df.withColumn("run", F.lit(run)).write.mode("append").format(fmt).options(**options).save()
    else:
        df.write.mode("overwrite").format(fmt).options(**options).save(_keyed(path, run))


def write_rejects(df: DataFrame, path: str, run: str) -> DataFrame:
    """Stores the rows of a run that are flagged for deletion; returns the others.

    The plan runs once: both parts read its checkpoint.
    """
    df = cut_lineage(df)
    append(df.filter(F.col("delete_flag") == "Y"), path, run)
    return df.filter(F.col("delete_flag") != "Y")


def write_split(df: DataFrame, path: str, flag: str = "skip_ml") -> None:
    """One folder per flag value, so that a reader prunes to one of them."""
    df.write.mode("overwrite").partitionBy(flag).parquet(path)


def write_export(df: DataFrame, path: str, max_rows: int = 1_000_000, gzip: bool = False) -> None:
    """CSV files of at most ``max_rows`` rows each."""
    df.write.mode("overwrite").options(
        header=True, maxRecordsPerFile=max_rows, compression="gzip" if gzip else "none"
    ).csv(path)


def request_rows(df: DataFrame, batch_id: str, email: str = "ml_email_address", phone: str = "ml_phone") -> DataFrame:
    """One enrichment request per record."""
    trimmed: Column = F.trim(phone)
    return df.select(
        F.lit(batch_id).alias("BATCH_ID"),
        record_id(F.col("batch_record_id").cast("string"), "source_name", "source_customer_id").alias("RECORD_ID"),
        lookup_key(email).alias("INPUT_EMAIL_ADDRESS"),
        trimmed.alias("INPUT_PHONE"),
        email_hash(email).alias("INPUT_EMAIL_HASH"),
        F.sha2(trimmed, 256).alias("INPUT_PHONE_HASH"),
    )


def control_row(df: DataFrame, batch_id: str, as_of: str) -> DataFrame:
    """The batch's single control row."""
    return df.sparkSession.range(1).select(
        F.lit(batch_id).alias("BATCH_ID"),
        F.lit("NEW").alias("STATUS"),
        instant(as_of).alias("CREATED_TS"),
        instant(as_of).alias("UPDATED_TS"),
    )
