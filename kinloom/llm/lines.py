"""Removal of lines repeated across documents, with built-in functions only.

Texts are read once to hash their long lines.  The hashes are range-partitioned by (hash,
shard of documents) and sorted there by document, largest first, and position; a shard is
``SHARD`` bits of doc_id, so a line that a third of all documents share spreads over as many
partitions as it has shards.  One pass over the sorted rows streams first occurrences: the
first row of a hash names the shard's largest document with it, a row whose predecessor is
of another document begins a new document.  Both windows look one row back, so nothing is
held, and the range partitioning and its sort serve them as they are.  What a shard leaves
is one row a hash; these meet by hash, where the documents are added up and the first one
of all shards stays.  Occurrences elsewhere are dropped through an N:1 join, and a
document's keep bitmap is returned run-length coded: the runs of lines that stay.  Texts
are never shuffled for this; only applying a bitmap joins it to its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, ascii_lower, written

SHARD = 12  # documents of one shard share all but this many low bits of their ids


def split_lines(text: Column) -> Column:
    """The lines of a text; null and empty texts are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _identified(docs: DataFrame) -> DataFrame:
    """(row, id, text, tx): the caller's columns stand inside ``row``, where no name can clash."""
    text = F.col("text")
    return docs.select(
        F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("id"),
        text.alias("text"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("tx"),
    )


def long_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(id, tx, pos, h1, h2) per line whose key has ``min_chars`` code points or more."""
    lines = _identified(docs.select("doc_id", "text")).select(
        "id", "tx", F.posexplode(split_lines(F.col("text"))).alias("pos", "line")
    )
    key = F.btrim("line", F.lit(SPACES))
    keyed = lines.filter(F.char_length("line") >= min_chars).select("id", "tx", "pos", key.alias("key"))
    lowered = ascii_lower(F.col("key"))
    return keyed.filter(F.char_length("key") >= min_chars).select(
        "id", "tx", "pos", F.xxhash64(lowered).alias("h1"), F.xxhash64(F.lit(1), lowered).alias("h2")
    )


def first_occurrences(found: DataFrame) -> DataFrame:
    """(h1, h2, n_docs, keeper) of each hash: documents with it, and the one that the sorted stream meets first."""
    shard = F.negate(F.shiftright("id", SHARD))  # rising shards, falling documents; no id is the last of all
    order = [F.col("id").desc_nulls_last(), F.col("tx"), F.col("pos")]
    dealt = found.withColumn("shard", shard).repartitionByRange("h1", "h2", "shard")
    dealt = dealt.sortWithinPartitions("h1", "h2", "shard", *order)
    stream = Window.partitionBy("h1", "h2", "shard").orderBy(*order)
    seen = dealt.withColumns({"place": F.row_number().over(stream), "before": F.lag("id").over(stream)})
    first = F.col("place") == 1
    fresh = seen.filter(first | ~F.col("id").eqNullSafe(F.col("before")))
    per_shard = fresh.groupBy("h1", "h2", "shard").agg(
        F.count(F.lit(1)).alias("n_docs"), F.max(F.when(first, F.col("id"))).alias("keeper")
    )
    return per_shard.groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"))


def dropped_runs(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(lost_id, lost_tx, lost): the dropped line positions of each document that loses any."""
    found = written(long_lines(docs, min_chars), "lines-hashes")
    repeated = first_occurrences(found).filter(F.col("n_docs") >= min_docs).select("h1", "h2", "keeper")
    repeated = written(repeated, "lines-repeated")
    lost = found.join(repeated, ["h1", "h2"]).filter(~F.col("id").eqNullSafe(F.col("keeper")))
    return lost.groupBy(F.col("id").alias("lost_id"), F.col("tx").alias("lost_tx")).agg(
        F.sort_array(F.collect_set("pos")).alias("lost")
    )


def _runs(positions: Column, n_lines: Column) -> Column:
    """Kept runs (start, length) between dropped positions."""
    ends = F.concat(positions, F.array(n_lines))
    starts = F.concat(F.array(F.lit(0)), F.transform(positions, lambda p: p + 1))
    gaps = F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("start"), (e - s).alias("length")))
    return F.filter(gaps, lambda run: run["length"] > 0)


def with_keep_runs(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(row, text, runs): the caller's columns, and the kept runs, or null where every line stays."""
    lost = dropped_runs(docs, min_chars, min_docs)
    on = (F.col("tx") == F.col("lost_tx")) & F.col("id").eqNullSafe(F.col("lost_id"))
    runs = F.when(F.col("lost").isNotNull(), _runs(F.col("lost"), F.size(split_lines(F.col("text")))))
    return _identified(docs).join(lost, on, "left").select("row", "text", runs.alias("runs"))


def kept_text(text: Column, runs: Column) -> Column:
    """The kept lines joined by a line feed."""
    lines = split_lines(text)
    pieces = F.flatten(F.transform(runs, lambda run: F.slice(lines, run["start"] + 1, run["length"])))
    return F.when(runs.isNull(), F.coalesce(text, F.lit(""))).otherwise(F.array_join(pieces, "\n"))


def keep_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(doc_id, n_lines, n_dropped, keep_runs) per row of ``docs``.

    A line's key is the line without ASCII white space at both ends and with A-Z
    lower-cased.  Keys of ``min_chars`` code points or more found in ``min_docs``
    documents or more lose all lines except in the largest doc_id that holds them.
    Null and empty texts are one empty line.  Rows sharing a doc_id are one document;
    rows without doc_id are one document too, smaller than any other.
    """
    return with_keep_runs(docs, min_chars, min_docs).select("row.doc_id", *_counts())


def _counts() -> list[Column]:
    n_lines = F.size(split_lines(F.col("text")))
    all_kept = F.array(F.struct(F.lit(0).alias("start"), n_lines.alias("length")))
    runs = F.coalesce(F.col("runs"), all_kept)
    kept = F.aggregate(runs, F.lit(0), lambda total, run: total + run["length"])
    return [
        n_lines.cast("long").alias("n_lines"),
        (n_lines - kept).cast("long").alias("n_dropped"),
        runs.alias("keep_runs"),
    ]


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """The documents with repeated lines removed from ``text`` and ``n_chars`` set anew."""
    rows = with_keep_runs(docs, min_chars, min_docs).withColumn("new", kept_text(F.col("text"), F.col("runs")))
    changed = {"text": F.col("new")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.char_length("new").cast(docs.schema["n_chars"].dataType)
    return rows.select(*[changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def line_digests(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) per row."""
    rows = with_keep_runs(docs, min_chars, min_docs)
    digest = F.sha2(kept_text(F.col("text"), F.col("runs")).cast("binary"), 256)
    counts = _counts()
    return rows.select("row.doc_id", counts[0], counts[1], digest.alias("kept_sha256"))
