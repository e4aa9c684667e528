"""Benchmark decontamination with one Aho-Corasick automaton.

The windows of ten words of every benchmark item are the automaton's patterns, written
over normalised text: A-Z lower-cased, words joined by single spaces, a space at both
ends.  A task normalises each whole text once, scans it once, and maps hits to words;
offsets into the original text are worked out for the documents that have hits.

The automaton is bounded: items are dealt into shards of at most ``SHARD_CHARS``
characters, each shard is one automaton, and the hits of several shards are merged
per document.  Only one shard is held by a task at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, map_arrow

WINDOW = 10
SHARD_CHARS = 16_000_000
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
# Every ASCII byte that is no word character becomes a space, A-Z becomes a-z; other bytes stay.
_TO_WORDS = bytes(
    c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256)
)
_CASE = str.maketrans(UPPER, LOWER)


def normalised_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()


def _joined(words: list[bytes]) -> str:
    """One character per byte: the automaton sees bytes, whatever the script."""
    return f" {b' '.join(words).decode('latin-1')} "


def windows(words: list[bytes], width: int = WINDOW) -> set[str]:
    """The patterns of an item: windows of ``width`` words, or the whole of a shorter item."""
    if not words:
        return set()
    width = min(width, len(words))
    return {_joined(words[i : i + width]) for i in range(len(words) - width + 1)}


def build(items: list[tuple[str | None, str | None]], width: int = WINDOW):
    """The automaton over (id, text) items: each pattern carries its word count and item ids."""
    owners: dict[str, set[str]] = {}
    for item_id, text in items:
        for pattern in windows(normalised_words(text), width):
            owners.setdefault(pattern, set()).update([] if item_id is None else [item_id])
    automaton = ahocorasick.Automaton()
    for pattern, ids in owners.items():
        automaton.add_word(pattern, (pattern.count(" ") - 1, tuple(sorted(ids))))
    if owners:
        automaton.make_automaton()
    return automaton if owners else None


def hits(automaton, text: str | None) -> tuple[int, list[tuple[int, int]], set[str]]:
    """(number of words, merged word ranges [start, end) inside windows, items)."""
    words = normalised_words(text)
    if automaton is None or not words:
        return len(words), [], set()
    found = list(automaton.iter(line := _joined(words)))
    if not found:
        return len(words), [], set()
    gaps = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
    ends = np.searchsorted(gaps, [at for at, _ in found])  # the space that closes word `end`
    ranges: list[list[int]] = []
    items: set[str] = set()
    for start, end, ids in sorted((int(e) - n, int(e), ids) for e, (_, (n, ids)) in zip(ends, found, strict=True)):
        items.update(ids)
        if ranges and start < ranges[-1][1]:
            ranges[-1][1] = max(end, ranges[-1][1])
        else:
            ranges.append([start, end])
    return len(words), [(a, b) for a, b in ranges], items


def spans(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word ranges as offsets [start, end) in code points of the original text."""
    at = [m.span() for m in _WORD.finditer(text.translate(_CASE))]
    return [(at[a][0], at[b - 1][1]) for a, b in ranges]


def item_shards(benchmark: DataFrame, max_chars: int = SHARD_CHARS) -> Iterator[list[tuple[str | None, str | None]]]:
    """The items, streamed to the driver in shards of bounded size."""
    shard, size = [], 0
    for item_id, text in benchmark.select(F.col("item_id").cast("string"), "text").toLocalIterator():
        if shard and size + len(text or "") > max_chars:
            yield shard
            shard, size = [], 0
        shard.append((item_id, text))
        size += len(text or "")
    yield shard


_SCHEMA = "n_words long, ranges array<struct<start:int,end:int>>, spans array<struct<start:int,end:int>>, items array<string>"


def _scan(docs: DataFrame, shard, width: int) -> DataFrame:
    """The rows of ``docs`` with the columns of ``_SCHEMA`` behind the given ones."""
    sent = docs.sparkSession.sparkContext.broadcast(shard)
    text_at = len(docs.columns) - 1
    extra = pa.struct([("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = build(sent.value, width)
        for batch in batches:
            counts, ranges, offsets, items = [], [], [], []
            for text in batch.column(text_at).to_pylist():
                n, found, ids = hits(automaton, text)
                counts.append(n)
                ranges.append([{"start": a, "end": b} for a, b in found])
                offsets.append([{"start": a, "end": b} for a, b in spans(text, found)] if found else [])
                items.append(sorted(ids))
            new = [
                pa.array(counts, pa.int64()),
                pa.array(ranges, pa.list_(extra)),
                pa.array(offsets, pa.list_(extra)),
                pa.array(items, pa.list_(pa.string())),
            ]
            kept = [batch.column(i) for i in range(text_at)]
            yield pa.RecordBatch.from_arrays(
                [*kept, *new], [*batch.schema.names[:text_at], "n_words", "ranges", "spans", "items"]
            )

    kept = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes[:text_at])
    return map_arrow(docs, run, f"{kept}, {_SCHEMA}")


def contamination(
    docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, shard_chars: int = SHARD_CHARS
) -> DataFrame:
    """(doc_id, n_words, ranges, spans, items) per row of ``docs``.

    ``ranges`` are the word ranges covered by windows, ``spans`` the same in code points
    of the original text, ``items`` the ids of items with a window in the text.  Null
    texts have no words.  Windows of an item without id mark words but name no item;
    items sharing an id are one.  An empty benchmark marks nothing.
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    parts = [_scan(rows, shard, width) for shard in item_shards(benchmark, shard_chars)]
    if len(parts) == 1:
        return parts[0].drop("text_key")
    # Of several shards only the rows with hits are merged; equal rows have equal hits.
    found = parts[0].filter(F.size("ranges") > 0)
    for part in parts[1:]:
        found = found.unionByName(part.filter(F.size("ranges") > 0))
    merged = found.groupBy("doc_id", "text_key").agg(
        F.flatten(F.collect_list("ranges")).alias("r"),
        F.flatten(F.collect_list("spans")).alias("s"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    merged = merged.select(
        F.col("doc_id").alias("m_id"),
        F.col("text_key").alias("m_key"),
        _merged(F.col("r")).alias("ranges"),
        _merged(F.col("s")).alias("spans"),
        "items",
    )
    first = parts[0].select("doc_id", "text_key", "n_words")
    on = F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("text_key") == F.col("m_key"))
    none = F.array().cast("array<struct<start:int,end:int>>")
    return first.join(merged, on, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("ranges", none).alias("ranges"),
        F.coalesce("spans", none).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def _merged(ranges):
    """Overlapping ranges joined."""
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def add(done, run):
        last = F.element_at(done, -1)
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], run["end"]).alias("end"))
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(grown))
        return F.when((F.size(done) > 0) & (run["start"] < F.try_element_at(done, F.lit(-1))["end"]), joined).otherwise(
            F.concat(done, F.array(run))
        )

    return F.aggregate(F.array_sort(ranges), empty, add)


def contamination_digests(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) per row."""
    rows = contamination(docs, benchmark)
    n_hit = F.aggregate("ranges", F.lit(0), lambda total, run: total + run["end"] - run["start"]).cast("long")
    return rows.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("ranges") > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any window of the benchmark, all columns kept."""
    marked = docs
    for shard in item_shards(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(shard)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            automaton = build(sent.value, width)
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
                yield batch.filter(pa.array([not hits(automaton, text)[1] for text in texts], pa.bool_()))

        marked = map_arrow(marked, run, docs.schema)
    return marked
