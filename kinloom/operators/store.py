"""Maintaining the identity store.

A store is a frame with unique keys.  Every operator returns the new state and
the change set; a dry run is simply the change set without writing the state.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import document_key, stable_id
from ..functions.nested import blank_count, push_history, text_items
from ..functions.text import column, replace_prefix
from ..schema import HISTORY_TYPE, KEY_COLUMNS
from .groups import attach, top_per_group


class StoreChange(NamedTuple):
    """New state of the store and the rows that changed, in their new form."""

    table: DataFrame
    changes: DataFrame


# ---- upsert and partial update -------------------------------------------


def last_per_key(batch: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return top_per_group(batch, keys, order)


def upsert(store: DataFrame, batch: DataFrame, keys: Sequence[str] = tuple(KEY_COLUMNS)) -> StoreChange:
    """Insert or overwrite by key.

    Columns the batch carries overwrite, nulls included; columns it lacks keep
    the stored value.  The batch has one row per key (see ``last_per_key``).
    """
    carried = [c for c in batch.columns if c not in keys]
    columns = [*store.columns, *[c for c in carried if c not in store.columns]]
    if all(c in batch.columns for c in store.columns):
        table = store.join(batch.select(*keys), list(keys), "left_anti").unionByName(batch, allowMissingColumns=True)
        return StoreChange(table.select(*columns), batch)
    right = batch.select(*keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in carried])
    joined = store.join(right, list(keys), "full")
    out = []
    for c in columns:
        if c in keys or c not in carried:
            out.append(F.col(c))
        else:
            kept = F.col(c) if c in store.columns else F.lit(None)
            out.append(F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(kept).alias(c))
    table = joined.select(*out)
    return StoreChange(table, table.join(batch.select(*keys), list(keys), "left_semi"))


def partial_update(
    store: DataFrame, updates: DataFrame, fields: Sequence[str], keys: Sequence[str] = tuple(KEY_COLUMNS)
) -> StoreChange:
    """Overwrite a few fields of existing keys; unknown keys are ignored."""
    right = updates.select(*keys, F.lit(True).alias("_hit"), *[F.col(f).alias(f"_new_{f}") for f in fields])
    joined = store.join(right, list(keys), "left").withColumns(
        {f: F.when(F.col("_hit"), F.col(f"_new_{f}")).otherwise(F.col(f)) for f in fields}
    )
    return _finish(joined, F.col("_hit"), "_hit", *[f"_new_{f}" for f in fields])


def _finish(flagged: DataFrame, hit: Column, *helpers: str) -> StoreChange:
    return StoreChange(flagged.drop(*helpers), flagged.filter(hit).drop(*helpers))


# ---- scrubbing values ----------------------------------------------------


def _flag_values(store: DataFrame, path: str, values: DataFrame, record: str | None) -> DataFrame:
    """Adds ``_hit``: the value at a (nested) path is on the one-column list."""
    listed = values.select(F.col(values.columns[0]).alias("_value")).filter(F.col("_value").isNotNull()).distinct()
    return attach(store.withColumn("_value", F.col(path)), listed.withColumn("_hit", F.lit(True)), "_value", record)


def _set_path(df: DataFrame, path: str, hit: Column, new: Column) -> DataFrame:
    """Set a top-level or nested field where ``hit`` holds."""
    top, _, rest = path.partition(".")
    if not rest:
        return df.withColumn(top, F.when(hit, new).otherwise(F.col(top)))
    return df.withColumn(top, F.when(hit, F.col(top).withField(rest, new)).otherwise(F.col(top)))


def nullify(store: DataFrame, path: str, values: DataFrame, record: str | None = None) -> StoreChange:
    """Null the field wherever its value is listed, at any nesting depth."""
    flagged = _flag_values(store, path, values, record)
    kind = store.select(F.col(path).alias("v")).schema["v"].dataType
    return _finish(
        _set_path(flagged, path, F.col("_hit"), F.lit(None).cast(kind)), F.col("_hit"), "_hit", "_value"
    )


def replace_values(
    store: DataFrame, path: str, mapping: DataFrame, record: str | None = None
) -> StoreChange:
    """Rewrite values by (old, new) pairs; each old value is listed once."""
    pairs = mapping.select(F.col("old").alias("_value"), F.col("new").alias("_new"), F.lit(True).alias("_hit"))
    joined = attach(store.withColumn("_value", F.col(path)), pairs, "_value", record)
    return _finish(
        _set_path(joined, path, F.col("_hit"), F.col("_new")), F.col("_hit"), "_hit", "_value", "_new"
    )


def remove_field(
    store: DataFrame, field: str, path: str, values: DataFrame, record: str | None = None
) -> StoreChange:
    """Remove ``field`` from the rows whose value at ``path`` is listed.

    Rows share one schema, so removal from some rows means null there.
    """
    flagged = _flag_values(store, path, values, record)
    kind = store.select(F.col(field).alias("v")).schema["v"].dataType
    return _finish(
        _set_path(flagged, field, F.col("_hit"), F.lit(None).cast(kind)), F.col("_hit"), "_hit", "_value"
    )


def drop_struct_field(store: DataFrame, path: str) -> DataFrame:
    """Remove a field from every row, out of its struct when nested."""
    top, _, rest = path.partition(".")
    return store.withColumn(top, F.col(top).dropFields(rest)) if rest else store.drop(top)


def null_threshold(
    store: DataFrame,
    path: str,
    values: DataFrame,
    person_fields: Sequence[str],
    threshold: int,
    record: str | None = None,
) -> StoreChange:
    """Of the rows holding a listed value, delete those with more than
    ``threshold`` blank person fields and null the value in the others.

    The change set has an ``action`` column: ``delete`` or ``nullify``.
    """
    flagged = _flag_values(store, path, values, record)
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    action = F.when(hit, F.when(blank_count(person_fields) > threshold, "delete").otherwise("nullify"))
    marked = flagged.withColumn("action", action).drop("_hit", "_value")
    kind = store.select(F.col(path).alias("v")).schema["v"].dataType
    done = _set_path(marked, path, F.col("action") == "nullify", F.lit(None).cast(kind))
    table = done.filter(F.coalesce(F.col("action"), F.lit("")) != "delete").drop("action")
    return StoreChange(table, done.filter(F.col("action").isNotNull()))


# ---- ids -----------------------------------------------------------------


class Regenerated(NamedTuple):
    table: DataFrame
    changes: DataFrame
    backup: DataFrame


def regenerate_ids(store: DataFrame, doc_ids: DataFrame, job_id: str, stamp: Column) -> Regenerated:
    """New id for the listed documents, the old one pushed to their history.

    The new id derives from document and job, so a repeated attempt of the same
    job gives the same id.  Unknown documents are ignored.
    """
    wanted = doc_ids.select(F.col(doc_ids.columns[0]).alias("_doc")).distinct().withColumn("_hit", F.lit(True))
    rows = store.withColumn("_doc", document_key())
    flagged = rows.join(wanted, "_doc", "left")
    hit = F.col("_hit")
    fresh = stable_id(F.concat_ws("|", F.lit(job_id), F.col("_doc")), "regen")
    confidence = F.coalesce(F.col("uxid_confidence"), F.lit(1.0))
    history = F.col("past_uxids") if "past_uxids" in store.columns else F.lit(None)
    new = {
        "past_uxids": F.when(
            hit, push_history(history.cast(HISTORY_TYPE), "uxid", confidence, stamp, fresh)
        ).otherwise(history.cast(HISTORY_TYPE)),
        "uxid": F.when(hit, fresh).otherwise(F.col("uxid")),
        "uxid_confidence": F.when(hit, F.lit(1.0)).otherwise(F.col("uxid_confidence")),
    }
    for name in ("created_timestamp", "last_updated_timestamp"):
        old = F.col(name) if name in store.columns else F.lit(None).cast("string")
        new[name] = F.when(hit, stamp).otherwise(old)
    done = flagged.withColumns(new)
    backup = rows.join(wanted.select("_doc"), "_doc", "left_semi").drop("_doc")
    return Regenerated(*_finish(done, hit, "_hit", "_doc"), backup)


# ---- duplicate e-mails ---------------------------------------------------


def clean_duplicate_emails(
    store: DataFrame, email: str = "ml_email_address", modified: str = "record_last_updated_timestamp",
    record: str = "batch_record_id",
) -> StoreChange:
    """Where several rows share an e-mail, only the latest keeps it.

    A row may list several e-mails; one that is the keeper of any of them keeps
    its whole value.
    """
    held = store.select(record, modified, F.explode(text_items(email)).alias("_email")).distinct()
    # Two rows per e-mail tell both the keeper and whether anyone shares it.
    order = [F.col(modified).desc_nulls_last(), F.col(record).asc()]
    first_two = top_per_group(held, ["_email"], order, k=2)
    shared = (
        first_two.groupBy("_email")
        .agg(F.count(F.lit(1)).alias("_n"), F.sort_array(F.collect_list(F.struct(record, modified))).alias("_two"))
        .filter("_n > 1")
        .select("_email", _later("_two", record, modified).alias("_keeper"))
    )
    losers = (
        held.join(shared, "_email")
        .groupBy(record)
        .agg(F.max(F.col(record) == F.col("_keeper")).alias("_keeps"))
        .filter(~F.col("_keeps"))
        .select(record, F.lit(True).alias("_hit"))
    )
    flagged = store.join(losers, record, "left")
    return _finish(_set_path(flagged, email, F.col("_hit"), F.lit(None)), F.col("_hit"), "_hit")


def _later(two: str, record: str, modified: str) -> Column:
    """Of two (record, modified) rows in record order: the later one, the first on a tie."""
    first, second = F.get(two, F.lit(0)), F.get(two, F.lit(1))
    newer = second[modified].isNotNull() & (first[modified].isNull() | (second[modified] > first[modified]))
    return F.when(newer, second[record]).otherwise(first[record])


# ---- renames -------------------------------------------------------------


class Renamed(NamedTuple):
    table: DataFrame
    changes: DataFrame
    collisions: DataFrame


def rename_prefix(store: DataFrame, columns: Sequence[str], key: str | Column, old: str, new: str) -> Renamed:
    """Swap a leading prefix in the given columns; report keys that then clash."""
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(column(c).startswith(old), F.lit(False))
    table = store.withColumns({c: replace_prefix(c, old, new) for c in columns})
    changed = store.filter(hit).withColumns({c: replace_prefix(c, old, new) for c in columns})
    collisions = (
        table.groupBy(column(key).alias("key")).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    )
    return Renamed(table, changed, collisions)
