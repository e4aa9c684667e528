"""Column selection, mapping, naming and row predicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.text import is_blank, null_if_blank
from ..schema import COMMON_COLUMNS, prefixed_name


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Select the columns, failing at once when one is missing."""
    have = {c.lower() for c in df.columns}
    missing = [c for c in columns if c.lower() not in have]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*columns)


def map_to_common(df: DataFrame, mapping: Mapping[str, str | Column], keep_extra: bool = True) -> DataFrame:
    """The 20 common columns from a name-or-expression map, absent ones empty,
    followed by the source columns the map did not use."""
    unknown = set(mapping) - set(COMMON_COLUMNS)
    if unknown:
        raise ValueError(f"not common columns: {sorted(unknown)}")
    chosen = [
        (F.col(m) if isinstance(m, str) else m if m is not None else F.lit("")).alias(name)
        for name, m in ((name, mapping.get(name)) for name in COMMON_COLUMNS)
    ]
    used = {m.lower() for m in mapping.values() if isinstance(m, str)} | set(COMMON_COLUMNS)
    extra = [F.col(c) for c in df.columns if c.lower() not in used] if keep_extra else []
    return df.select(*chosen, *extra)


def map_positional(df: DataFrame, inputs: Sequence[str], outputs: Sequence[str]) -> DataFrame:
    """Pair input and output names by position; an absent input gives null."""
    if len(inputs) != len(outputs):
        raise ValueError("input and output lists differ in length")
    return df.select(
        [
            (F.col(i) if i in df.columns else F.lit(None).cast("string")).alias(o)
            for i, o in zip(inputs, outputs, strict=True)
        ]
    )


def prefix_columns(df: DataFrame) -> DataFrame:
    return df.select([F.col(c).alias(prefixed_name(c)) for c in df.columns])


def mark_original(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Prefix every column but the keys with ``original_``."""
    return df.select([F.col(c) if c in keys else F.col(c).alias(f"original_{c}") for c in df.columns])


def expand_json(df: DataFrame, column: str, ddl: str) -> DataFrame:
    """Replace a JSON text column by its fields."""
    kept = [c for c in df.columns if c != column]
    return df.withColumn("_parsed", F.from_json(column, ddl)).select(*kept, "_parsed.*")


def pass_through(df: DataFrame, columns: Sequence[str] | None = None, active: bool = True) -> DataFrame:
    """Fold the non-common columns into one JSON column; inactive writes null."""
    extra = list(columns) if columns is not None else [c for c in df.columns if c not in COMMON_COLUMNS]
    json = F.to_json(F.struct(*extra)) if active and extra else F.lit(None).cast("string")
    return df.withColumn("pass_thru_data", json).drop(*extra)


def add_state_columns(df: DataFrame, batch_id: str, description: str = "incremental") -> DataFrame:
    """Result columns of a fresh batch: nothing resolved, nothing deleted."""
    return df.withColumns(
        {
            "delete_flag": F.lit("N"),
            "uxid": F.lit(None).cast("string"),
            "uxid_confidence": F.lit(1.0),
            "id_res_last_updated_timestamp": F.lit(None).cast("string"),
            "processing_scenario": F.lit(0),
            "updated_by_incremental_batch_id": F.lit(batch_id),
            "updated_by_incremental_batch_description": F.lit(description),
        }
    )


def column_last(df: DataFrame, name: str) -> DataFrame:
    return df.select(*[c for c in df.columns if c != name], name)


def updated_or_created(updated: str, created: str) -> Column:
    return F.coalesce(null_if_blank(updated), F.col(created))


# ---- predicates ----------------------------------------------------------


def split_scenarios(df: DataFrame, scenario: str = "processing_scenario") -> dict[str, DataFrame]:
    """The three routes of an exact-match result: touch, adopt, go on matching."""
    live = df.filter(F.col("delete_flag") == "N")
    return {
        "touch": live.filter(F.col(scenario) == 1),
        "adopt": live.filter(F.col(scenario) == 3),
        "match": live.filter(F.col(scenario).isin(2, 4)),
    }


def drop_unconverted(df: DataFrame, before: str, after: str) -> tuple[DataFrame, Observation]:
    """Drop rows whose timestamp was given but could not be converted.

    The observation holds ``rows`` and ``dropped`` once the result has run.
    """
    lost = ~is_blank(before) & F.col(after).isNull()
    seen = Observation("drop_unconverted")
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(lost).alias("dropped"))
    return watched.filter(~lost), seen


def active_contacts(df: DataFrame, role: str, role_col: str = "PHONE_ROLE", end_col: str = "END_DATE") -> DataFrame:
    return df.filter((F.lower(F.trim(F.col(role_col))) == role) & is_blank(end_col))


def value_in(df: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """Rows whose value is on the list; the list is a one-column frame of any size."""
    key = values.columns[0]
    return df.join(values.select(F.col(key).alias("_v")).distinct(), F.col(column) == F.col("_v"), "left_semi")


def holds_item(items: str, value: str) -> Column:
    """An array (see ``text_items``) contains the normalised value."""
    return F.array_contains(F.col(items), value.strip().lower())
