"""Date and time clean-up: one strict parser instead of many lenient ones."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import column

ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
ISO_DATE = "yyyy-MM-dd"

# Accepted input patterns, most specific first.
FORMATS = [
    "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "yyyy-MM-dd HH:mm:ss.SSS",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy/MM/dd HH:mm:ss",
    "yyyyMMddHHmmss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd",
    "yyyy/MM/dd",
    "M/d/yyyy",
    "dd-MM-yyyy",
    "dd/MM/yyyy",
    "yyyyMMdd",
    "MMM d, yyyy",
    "MMMM d, yyyy",
    "dd-MMM-yyyy",
    "dd-MMMM-yyyy",
    "dd-MMM-yy",
    "MMM d, yy",
    "M/d/yy",
    "M/d/yy h:mm a",
    "M/d/yyyy h:mm a",
]

# Texts that stand for a missing date.
PLACEHOLDERS = ["null", "none", "n/a", "missing", "not null", "", "na"]

# Source -> (zone, input patterns in order).  A zone of None means
# the value carries its own offset.  EST is a fixed offset in the JVM, CST and
# PST follow daylight saving; pass ``zone_overrides`` for region zones.
SOURCE_CLOCKS = {
    "UDX_TRISEPT": ("UTC", ["yyyy-MM-dd HH:mm:ss.SSSSSS"]),
    "UOR_LOEWS": ("EST", ["MM/dd/yyyy hh:mm:ss a"]),
    "USH_WIFI": ("PST", ["yyyy-MM-dd HH:mm:ss"]),
    "UOR_WIFI": ("EST", ["yyyy-MM-dd HH:mm:ss"]),
    "USH_DENALI": ("PST", ["yyyy-MM-dd HH:mm:ss.SSS"]),
    "USH_GALAXY": ("PST", ["yyyy-MM-dd HH:mm:ss.SSS"]),
    "UOR_GALAXY": ("EST", ["yyyy-MM-dd HH:mm:ss.SSS"]),
    "UOR_COMMERCE_CART": (None, ["yyyy-MM-dd'T'HH:mm:ss.SSSXXX"]),
    "UOR_COLORVISION": ("EST", ["M/d/yyyy h:mm:ss a", "M/d/yyyy h:mm a", "M/d/yyyy HH:mm"]),
    "UDX_FNBO": ("CST", ["yyyyMMdd"]),
    "UDX_ADHOC": ("EST", ["yyyy-MM-dd HH:mm:ss.SSS", "M/d/yyyy", "yyyy-MM-dd"]),
    "USH_TRISEPT": ("CST", ["yyyy-MM-dd HH:mm:ss"]),
}
OTHER_CLOCK = ("UTC", ["yyyy-MM-dd HH:mm:ss.SSS", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd"])

_TOKEN = re.compile(r"'([^']*)'|([A-Za-z])\2*|.")


def shape_of(pattern: str) -> str:
    """Regular expression for texts that could match a datetime pattern.

    Failing a parse costs an exception per row; a shape test costs almost
    nothing, so each row reaches only the one or two parsers that may accept it.
    """
    out = []
    for match in _TOKEN.finditer(pattern):
        token = match.group(0)
        if match.group(1) is not None:
            out.append(re.escape(match.group(1)))
        elif token == "a":
            out.append("[AaPp][Mm]")
        elif token == "XXX":
            out.append(r"(?:Z|[+-]\d{2}:\d{2})")
        elif token == "MMM":
            out.append("[A-Za-z]{3}")
        elif token == "MMMM":
            out.append("[A-Za-z]{3,9}")
        elif token.isalpha():
            out.append(r"\d{1,2}" if len(token) == 1 else rf"\d{{{len(token)}}}")
        else:
            out.append(re.escape(token))
    return "^" + "".join(out) + "$"


def parse_any(c: Column | str, formats: Sequence[str] = FORMATS) -> Column:
    """Timestamp from the first pattern that accepts the trimmed text, else null."""
    text = F.trim(column(c))
    tries = [F.when(text.rlike(shape_of(f)), F.try_to_timestamp(text, F.lit(f))) for f in formats]
    return F.coalesce(*tries)


def instant(as_of: str | Column) -> Column:
    return F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of


def iso_millis(c: Column | str) -> Column:
    return F.date_format(column(c), ISO_MILLIS)


def holds_time(name: str) -> bool:
    return "time" in name.lower()


def looks_like_date_column(name: str) -> bool:
    return "date" in name.lower() or holds_time(name)


def clean_date(
    c: Column | str, as_of: str | Column, with_time: bool, min_year: int = 1900, formats: Sequence[str] = FORMATS
) -> Column:
    """ISO text; null for placeholders, impossible dates, years before ``min_year``
    and moments after ``as_of``."""
    text = F.trim(column(c))
    parsed = parse_any(F.when(~F.lower(text).isin(PLACEHOLDERS), text), formats)
    kept = F.when((F.year(parsed) >= min_year) & (parsed <= instant(as_of)), parsed)
    return F.date_format(kept, ISO_MILLIS if with_time else ISO_DATE)


def clean_dates(
    df: DataFrame,
    as_of: str | Column,
    columns: Sequence[str] | None = None,
    min_year: int = 1900,
    with_time: bool | None = None,
) -> DataFrame:
    """Standardise date columns, named ones or all whose name suggests a date."""
    chosen = [c for c in (columns or df.columns) if c in df.columns and (columns or looks_like_date_column(c))]
    return df.withColumns(
        {c: clean_date(c, as_of, holds_time(c) if with_time is None else with_time, min_year) for c in chosen}
    )


def source_instant(c: Column | str, source: str, zone_overrides: dict[str, str] | None = None) -> Column:
    """UTC timestamp of a vendor text, by the clock its source uses."""
    zone, formats = SOURCE_CLOCKS.get(source.upper(), OTHER_CLOCK)
    parsed = parse_any(c, formats)
    if zone is None:
        return parsed
    return F.to_utc_timestamp(parsed, (zone_overrides or {}).get(zone, zone))


def to_utc(
    df: DataFrame, columns: Sequence[str], source: str, zone_overrides: dict[str, str] | None = None
) -> DataFrame:
    return df.withColumns(
        {c: iso_millis(source_instant(c, source, zone_overrides)) for c in columns if c in df.columns}
    )


def full_timestamp(c: Column | str, formats: Sequence[str] = ("M/d/yyyy", "yyyy-MM-dd")) -> Column:
    """Short dates gain a midnight time; texts longer than 19 characters stay."""
    value = column(c)
    return F.when(F.length(value) > 19, value).otherwise(
        F.date_format(parse_any(value, formats), "yyyy-MM-dd HH:mm:ss.SSS")
    )


# Extra patterns of the timestamp normaliser, zone-bearing ones included.
FLEXIBLE_FORMATS = [
    "yyyy-MM-dd:HH:mm:ss.SSSSSS",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "yyyy-MM-dd'T'HH:mm:ss.SSSXXX",
    "yyyy-MM-dd'T'HH:mm:ssXXX",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "yyyy-MM-dd'T'HH:mm:ss.SSS",
    "yyyy-MM-dd HH:mm:ssXXX",
]


def flexible_iso(c: Column | str) -> Column:
    """ISO milliseconds in UTC from many layouts; null when none fits."""
    return iso_millis(parse_any(c, FLEXIBLE_FORMATS + FORMATS))


def scrub_birth_date(birth: Column | str, updated: Column | str, cutoff: str = "2019-07-31") -> Column:
    """Drop the 1901-01-01 filler; after the cut-off only day and month are kept,
    under the leap year 1904."""
    value = F.try_to_date(F.trim(column(birth)), "yyyy-MM-dd")
    masked = F.make_date(F.lit(1904), F.month(value), F.day(value))
    late = F.coalesce(column(updated) > cutoff, F.lit(False))
    return F.when(column(birth) == "1901-01-01", F.lit(None)).otherwise(
        F.when(late, F.date_format(masked, ISO_DATE)).otherwise(column(birth))
    )


def time_parts(c: Column | str) -> dict[str, Column]:
    """Partition columns from a timestamp."""
    ts = column(c)
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "hour": F.hour(ts),
        "minute": F.minute(ts),
    }


def expiry_epoch(as_of: str | Column, days: int = 90) -> Column:
    """Epoch seconds at which a row kept for ``days`` may be dropped."""
    return F.unix_timestamp(instant(as_of)) + F.lit(days * 86400).cast("long")
