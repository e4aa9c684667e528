"""Vendor file readers: delimited groups, ragged tab files, fixed width."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import column
from ..schema import strings

PART_SUFFIX = r"_\d{3}_of_\d{3}(\.csv)$"
BAD_ROW = "_corrupt_record"


def read_csv_group(
    spark: SparkSession,
    paths: Sequence[str],
    columns: Sequence[str] | None = None,
    column_count: int | None = None,
    lower_header: bool = False,
    multi_line: bool = True,
    malformed: str = "keep",
) -> DataFrame:
    """All parts of one table in a single scan, every value text.

    Names come from ``columns`` or from the first part's header; every other
    part's header is checked against them by the reader itself.  ``malformed``
    rows are kept padded with nulls, fail the job, or are kept with their text
    in ``_corrupt_record`` (``quarantine``).  ``multi_line=False`` lets Spark
    split large files when no value holds a line break.
    """
    options = {"header": True, "sep": ",", "quote": '"', "escape": '"', "multiLine": multi_line}
    names = list(columns) if columns else spark.read.options(**options).csv(paths[0]).columns
    if column_count is not None and len(names) != column_count:
        raise ValueError(f"{len(names)} columns where {column_count} were expected in {paths[0]}")
    modes = {"keep": "PERMISSIVE", "fail": "FAILFAST", "quarantine": "PERMISSIVE"}
    fields = [*names, BAD_ROW] if malformed == "quarantine" else names
    # Header names are compared only when no extra column is asked for.
    options |= {"mode": modes[malformed], "enforceSchema": malformed == "quarantine"}
    df = spark.read.options(**options, columnNameOfCorruptRecord=BAD_ROW).schema(strings(fields)).csv(list(paths))
    return df.toDF(*[c.lower() for c in df.columns]) if lower_header else df


def metadata_csv_schema(fields: Iterable[str], extra: Sequence[tuple[str, str]]):
    """Schema known only at run time: text fields plus fixed typed ones."""
    schema = strings(fields)
    for name, kind in extra:
        schema = schema.add(name, kind)
    return schema


def read_ragged_tsv(spark: SparkSession, paths: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Split on tabs; short rows gain empty text, long rows lose the surplus."""
    fields = F.split("value", "\t", -1)
    return spark.read.text(list(paths)).select(
        [F.coalesce(F.get(fields, F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(columns)]
    )


def fixed_fields(line: str, layout: Sequence[tuple[str, int, int]]) -> list[Column]:
    """Trimmed slices (name, start, end), zero based, end exclusive."""
    return [F.trim(F.substring(line, start + 1, end - start)).alias(name) for name, start, end in layout]


def read_fixed_width(
    spark: SparkSession,
    paths: Sequence[str],
    layout: Sequence[tuple[str, int, int]],
    length: int,
    header: bool = True,
    on_bad: str = "fail",
) -> DataFrame:
    """Slice lines by position; a line of another length is an error.

    ``on_bad='quarantine'`` keeps it in ``_corrupt_record`` instead.  The CSV
    reader, given a separator no file uses, drops each file's own header row.
    """
    lines = (
        spark.read.options(header=header, sep="\u0001", quote="", enforceSchema=True)
        .schema("line string")
        .csv(list(paths))
    )
    fits = F.length("line") == length
    if on_bad == "quarantine":
        sliced = [F.when(fits, c).alias(n) for c, (n, _, _) in zip(fixed_fields("line", layout), layout, strict=True)]
        return lines.select(*sliced, F.when(~fits, F.col("line")).alias(BAD_ROW))
    problem = F.concat(F.lit(f"line length is not {length}: "), F.length("line").cast("string"))
    checked = lines.select(F.when(fits, F.col("line")).otherwise(F.raise_error(problem)).alias("line"))
    return checked.select(*fixed_fields("line", layout))


# ---- file names ----------------------------------------------------------


def table_of_file(name: Column | str, prefixes: Sequence[str], exact: bool = True) -> Column:
    """Table a file belongs to; null when none fits.

    ``exact`` strips the leading run id, the part suffix and the extension and
    compares the rest; otherwise the first prefix contained in the name wins.
    Longer prefixes are tried first in both cases.
    """
    text = F.lower(column(name))
    if exact:
        text = F.regexp_replace(F.regexp_replace(text, PART_SUFFIX, "$1"), r"^\d+_|\.csv$", "")
    out = None
    for prefix in sorted(prefixes, key=len, reverse=True):
        hit = (text == prefix.lower()) if exact else text.contains(prefix.lower())
        out = F.when(hit, prefix) if out is None else out.when(hit, prefix)
    return out


def route_paths(paths: Iterable[str], prefixes: Sequence[str], exact: bool = True) -> dict[str, list[str]]:
    """The same routing for a list of paths; unknown files are an error."""
    routed: dict[str, list[str]] = {}
    longest_first = sorted(prefixes, key=len, reverse=True)
    for path in paths:
        name = path.rsplit("/", 1)[-1].lower()
        stem = re.sub(r"^\d+_", "", re.sub(r"\.\w+$", "", re.sub(PART_SUFFIX, r"\1", name)))
        found = next((p for p in longest_first if (stem == p.lower() if exact else p.lower() in name)), None)
        if found is None:
            raise ValueError(f"no table for file {path}")
        routed.setdefault(found, []).append(path)
    return routed


def csv_only(paths: Iterable[str]) -> list[str]:
    """The paths themselves, or an error naming the files that are not CSV."""
    paths = list(paths)
    other = [p for p in paths if not p.lower().endswith(".csv")]
    if other:
        raise ValueError(f"not CSV: {other}")
    return paths


def batch_id(names: DataFrame, name: str, as_of: str) -> DataFrame:
    """One row: the 14-digit run id all files share, else the run time."""
    run = F.regexp_extract(F.element_at(F.split(F.col(name), "/"), -1), r"^(\d{14})_", 1)
    ids = names.select(run.alias("run")).filter("run <> ''")
    fallback = F.date_format(F.lit(as_of).cast("timestamp"), "yyyyMMddHHmmss")
    return ids.agg(F.min("run").alias("lo"), F.max("run").alias("hi")).select(
        F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(fallback).alias("batch_id")
    )


def lookup_scan(table: DataFrame, key: str, wanted: DataFrame, wanted_key: str) -> DataFrame:
    """Rows of a lookup table whose normalised key was asked for.

    Any reader may supply the table (JDBC, Parquet); a small key set turns into
    a broadcast or a runtime filter by itself.
    """
    norm = F.lower(F.trim(F.col(key).cast("string")))
    keys = wanted.select(F.lower(F.trim(F.col(wanted_key).cast("string"))).alias("_k")).distinct()
    return table.join(keys, norm == F.col("_k"), "left_semi")
