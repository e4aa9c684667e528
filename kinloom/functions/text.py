"""Text clean-up expressions and the frame-wide forms built on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def is_blank(c: Column | str) -> Column:
    """True for null, empty and space-only text; never null itself."""
    return F.coalesce(F.trim(column(c)), F.lit("")) == ""


def null_if_blank(c: Column | str) -> Column:
    """Blank becomes null; other values keep their spaces."""
    return F.when(is_blank(c), F.lit(None)).otherwise(column(c))


def lookup_key(c: Column | str) -> Column:
    """Lower-cased, trimmed, blank as null: the form keys are compared in."""
    key = F.lower(F.trim(column(c)))
    return F.when(key != "", key)


# ---- whole-frame forms ---------------------------------------------------


def trim_upper(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Trim and upper-case every column; ``keys`` are trimmed only, so that they
    still join with tables cleaned another way."""
    return df.select([(F.trim(c) if c in keys else F.upper(F.trim(c))).alias(c) for c in df.columns])


def trim_lower(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return df.select([(F.trim(c) if c in keys else F.lower(F.trim(c))).alias(c) for c in df.columns])


def blanks_to_null(df: DataFrame) -> DataFrame:
    return df.withColumns({c: null_if_blank(c) for c in string_columns(df)})


def nulls_to_blank(df: DataFrame) -> DataFrame:
    return df.na.fill("", subset=string_columns(df))


def all_to_string(df: DataFrame) -> DataFrame:
    return df.select([F.col(c).cast("string").alias(c) for c in df.columns])


# ---- e-mail --------------------------------------------------------------


def valid_email(c: Column | str, max_length: int = 128, measure_raw: bool = False) -> Column:
    """Lower-cased and trimmed, null when longer than ``max_length``.

    ``measure_raw`` takes the length before trimming, as one source expects.
    """
    value = F.lower(F.trim(column(c)))
    measured = column(c) if measure_raw else value
    return F.when(F.length(measured) <= max_length, value)


def upper_but_email(df: DataFrame, email: str, measure_raw: bool = False) -> DataFrame:
    return df.select(
        [
            (valid_email(c, measure_raw=measure_raw) if c == email else F.upper(F.trim(F.col(c)))).alias(c)
            for c in df.columns
        ]
    )


def email_local_part(c: Column | str) -> Column:
    """Text before the first ``@``; empty when there is none or it leads."""
    return F.regexp_extract(column(c), "^([^@]+)@", 1)


def clean_email(c: Column | str, max_length: int = 128) -> Column:
    """Usable e-mail key: one ``@``, something on both sides, a dot in the domain."""
    key = lookup_key(c)
    return F.when((F.length(key) <= max_length) & key.rlike(r"^[^@\s]+@[^@\s]+\.[^@\s.]+$"), key)


# ---- codes and values ----------------------------------------------------


def short_postcode(c: Column | str) -> Column:
    return F.substring(column(c), 1, 5)


def area_source(c: Column | str, areas: dict[str, str], source_suffix: str) -> Column:
    """Three-letter code prefix -> area -> source name; null when unknown."""
    code = F.substring(F.trim(column(c)), 1, 3)
    out = F.lit(None).cast("string")
    for prefix, area in areas.items():
        out = F.when(code == prefix, F.lit(f"{area}_{source_suffix}")).otherwise(out)
    return out


def plain_dashes(c: Column | str) -> Column:
    """Unicode hyphens, dashes and the minus sign become ``-``."""
    return F.regexp_replace(column(c), "[‐-―−]", "-")


def replace_prefix(c: Column | str, old: str, new: str) -> Column:
    """Swap a leading ``old`` for ``new``; later occurrences are left alone."""
    value = column(c)
    return F.when(value.startswith(old), F.concat(F.lit(new), F.substring(value, len(old) + 1, 2**31 - 1))).otherwise(
        value
    )


def usable(c: Column | str) -> Column:
    """The value unless it is null, blank or the text ``null``."""
    value = column(c).cast("string")
    return F.when(~F.lower(F.trim(value)).isin("", "null"), value)


def first_usable(df: DataFrame, aliases: Sequence[str]) -> Column:
    """First usable value among the aliases ``df`` has, names compared without case."""
    present = {c.lower(): c for c in df.columns}
    found = [usable(present[a.lower()]) for a in aliases if a.lower() in present]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


# Fields that make up the similarity text, in order.
SIMILARITY_FIELDS = [
    "ml_first_name",
    "ml_middle_name",
    "ml_last_name",
    "ml_address_line_1",
    "ml_address_line_2",
    "ml_phone",
]


def similarity_text(df: DataFrame, email: str = "ml_email_address") -> Column:
    """Space-joined person fields plus the e-mail's local part; nulls are skipped."""
    fields = [F.col(c) for c in SIMILARITY_FIELDS if c in df.columns]
    return F.concat_ws(" ", *fields, email_local_part(email))


def source_from_file_name(c: Column | str, markers: Sequence[tuple[str, str]], default: str) -> Column:
    """Source code of the first marker the file name contains."""
    name = F.lower(column(c))
    out = None
    for marker, source in markers:
        out = F.when(name.contains(marker), source) if out is None else out.when(name.contains(marker), source)
    return F.lit(default) if out is None else out.otherwise(default)
