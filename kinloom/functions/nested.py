"""Arrays, structs and JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import HISTORY_TYPE
from .text import column, is_blank


def push_history(
    history: Column | str, old_id: Column | str, confidence: Column | str, changed: Column | str, new_id: Column | str
) -> Column:
    """Append the old id when there is one and it differs from the new one."""
    past = F.coalesce(column(history), F.array().cast(HISTORY_TYPE))
    entry = F.struct(
        column(old_id).alias("uxid"),
        column(confidence).cast("double").alias("uxid_confidence"),
        column(changed).alias("uxid_last_changed_timestamp"),
    )
    changed_id = column(old_id).isNotNull() & ~column(old_id).eqNullSafe(column(new_id))
    return F.when(changed_id, F.concat(past, F.array(entry))).otherwise(past)


def text_items(c: Column | str) -> Column:
    """Items of a value that is either plain text or a bracketed, quoted list.

    ``['A@x.y', ' b@x.y']`` gives ``[a@x.y, b@x.y]``; ``C@x.y`` gives ``[c@x.y]``.
    """
    text = F.trim(column(c))
    as_json = F.regexp_replace(text, "'", '"')
    listed = F.from_json(F.when(text.startswith("["), as_json), "array<string>")
    items = F.coalesce(listed, F.array(text))
    return F.filter(F.transform(items, lambda x: F.lower(F.trim(x))), lambda x: x.isNotNull() & (x != ""))


def parsed_json(c: Column | str, ddl: str) -> Column:
    return F.from_json(column(c), ddl)


def blank_count(paths: Sequence[str]) -> Column:
    """How many of the (possibly nested) text fields are null or blank."""
    total = F.lit(0)
    for path in paths:
        total = total + is_blank(F.col(path)).cast("int")
    return total


def as_document(df: DataFrame) -> DataFrame:
    """Nested store form: originals, normalised features and metadata.

    ``original_x`` goes to ``record_original.x``; ``ml_*`` and ``rules_*`` go to
    ``record_normalized``; everything else stays on top next to the key.
    """
    original = [c for c in df.columns if c.startswith("original_")]
    features = [c for c in df.columns if c.startswith(("ml_", "rules_"))]
    rest = [c for c in df.columns if c not in original and c not in features]
    parts = [F.concat_ws("_", "source_name", "source_customer_id").alias("doc_id"), *map(F.col, rest)]
    if original:
        parts.append(F.struct(*[F.col(c).alias(c.removeprefix("original_")) for c in original]).alias("record_original"))
    if features:
        parts.append(F.struct(*features).alias("record_normalized"))
    return df.select(*parts)
