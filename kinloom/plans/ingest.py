"""Vendor files to the common schema, one generic job for every source.

The plan is lazy from the scan to the write.  Timestamps are deduplicated in the
vendor's own layout, then moved to UTC, range-checked and written as ISO text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates
from ..operators.dedupe import dedupe_latest
from ..operators.project import map_to_common, pass_through, prefix_columns, require
from ..schema import COMMON_COLUMNS
from ..sources import readers, sinks, vendors  # noqa: F401  (vendors registers the sources)
from ..sources.specs import SOURCES, SourceSpec, TableSpec


def read_table(
    spark: SparkSession, spec: TableSpec, paths: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Scan one vendor table and keep the columns the source needs."""
    if spec.reader == "csv":
        df = readers.read_csv_group(
            spark, readers.csv_only(paths), columns, spec.column_count, spec.lower_header, spec.multi_line
        )
    elif spec.reader == "tsv":
        if not columns:
            raise ValueError(f"{spec.name} has no header; pass its column list")
        df = readers.read_ragged_tsv(spark, paths, columns)
    elif spec.reader == "fixed":
        df = readers.read_fixed_width(spark, paths, spec.layout, spec.length)
    else:
        raise ValueError(f"unknown reader {spec.reader}")
    if spec.add_file_name:
        df = df.withColumn("_file_name", F.col("_metadata.file_name"))
        return require(df, [*spec.keep, "_file_name"])
    return require(df, spec.keep)


def prepare_table(df: DataFrame, spec: TableSpec, as_of: str) -> DataFrame:
    """Clean, standardise dates, deduplicate."""
    if spec.transform:
        df = spec.transform(df)
    df = dates.clean_dates(df, as_of, spec.date_columns, with_time=False) if spec.date_columns else df
    if spec.before_dedupe:
        df = spec.before_dedupe(df)
    if spec.dedupe_on:
        df = dedupe_latest(df, spec.dedupe_on, spec.dedupe_formats)
    return spec.after_dedupe(df) if spec.after_dedupe else df


def standardise(df: DataFrame, spec: SourceSpec, as_of: str) -> DataFrame:
    """Record timestamps to UTC ISO text; future and pre-1900 ones become null."""
    limit = dates.instant(as_of)
    out = {}
    for name in spec.timestamps:
        moment = dates.source_instant(name, spec.clock, dict(spec.zone_overrides))
        out[name] = dates.iso_millis(F.when((F.year(moment) >= 1900) & (moment <= limit), moment))
    return df.withColumns(out)


def to_common(
    spark: SparkSession,
    source: str,
    paths: Sequence[str],
    as_of: str,
    columns: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """All files of a source as common-schema records plus its extra columns."""
    spec = SOURCES.get(source)
    routed = readers.route_paths(paths, [t.name for t in spec.tables], spec.exact_names)
    missing = [t.name for t in spec.tables if t.name not in routed]
    if missing:
        raise ValueError(f"no files for {missing}")
    tables = {
        t.name: prepare_table(read_table(spark, t, routed[t.name], (columns or {}).get(t.name)), t, as_of)
        for t in spec.tables
    }
    return standardise(map_to_common(spec.join(tables), spec.mapping(spec.code)), spec, as_of)


def ingest(
    spark: SparkSession,
    source: str,
    paths: Sequence[str],
    target: str,
    as_of: str,
    columns: Mapping[str, Sequence[str]] | None = None,
    keep_pass_through: bool = False,
) -> tuple[str, int]:
    """Read, standardise and append one delivery; returns partition path and rows."""
    records = to_common(spark, source, paths, as_of, columns)
    extra = [c for c in records.columns if c not in COMMON_COLUMNS]
    records = prefix_columns(pass_through(records, extra, keep_pass_through))
    names = spark.createDataFrame([(p,) for p in paths], "name string")
    run = readers.batch_id(names, "name", as_of).first()["batch_id"]
    return sinks.write_partitioned(records, target, as_of, run)
