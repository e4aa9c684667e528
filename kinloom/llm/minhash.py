"""Near-duplicate documents by b-bit MinHash.

One task pass turns each text into its set of word shingles, the minima of 200
hash functions over it, 40 band keys of five minima each, and a packed signature
that keeps the low two bits of every minimum as two bit planes.  Everything after
that works on distinct sets, so copies never form pairs.

Candidates come from the bands in two steps, neither of which pairs up a group:

1. The sets of a band bucket are linked to the bucket's hub, the set that meets
   most others over all its bands (the text that near copies were made from).
   Hub pairs are confirmed on the full sets, and components are taken.
2. Only sets of one bucket that step 1 left in *different* components are
   compared, and only if size, the shares of both in their common hub, and the
   two-bit estimate leave 0.8 possible.  Survivors are confirmed the same way.

A pair of Jaccard 0.8 shares no band with probability (1 - 0.8^5)^40 = 1.2e-7, and
the estimate (standard deviation 0.034 there) is cut at 0.6, six deviations away.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from .common import map_batches, written

BANDS, ROWS = 40, 5
HASHES = BANDS * ROWS
PLANE = 4  # longs that hold one bit of each of the 200 minima
HUB_FLOOR, FLOOR = 0.4, 0.6  # smallest estimates worth confirming, against a hub and otherwise
MAP = 16  # longs of the bitmap of what a set has beyond its hub
_CHUNK = 1024  # shingles hashed at a time: the work area stays in the cache
_LETTERS = 4096  # multipliers by position in a word; longer words use them again

_rng = np.random.default_rng(20240201)
_MASK = _rng.integers(0, 2**32, (HASHES, 1), dtype=np.uint32)
_FACTOR = _rng.integers(0, 2**32, (HASHES, 1), dtype=np.uint32) | np.uint32(1)
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_PLACE = _rng.integers(0, 2**64, _LETTERS, dtype=np.uint64) | np.uint64(1)
_MIX = _rng.integers(0, 2**64, 16, dtype=np.uint64) | np.uint64(1)
_STIR = np.uint64(0x9E3779B97F4A7C15)  # fixed value: 2^64 / golden ratio
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _stirred(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _STIR
    return x ^ (x >> np.uint64(29))


def word_hashes(text: bytes | None) -> np.ndarray:
    """A 64-bit hash per white-space word, A-Z lower-cased."""
    letters = np.frombuffer((text or b"").lower(), np.uint8)
    inside = ~_IS_SPACE[letters]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    letters, first = letters[inside], first[inside]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = np.diff(starts, append=len(letters))
    place = np.arange(len(letters)) - np.repeat(starts, lengths)
    sums = np.add.reduceat(_BYTE[letters] * _PLACE[place % _LETTERS], starts)
    for i in np.flatnonzero(lengths > _LETTERS):  # beyond the multipliers: no place may count like another
        word = letters[starts[i] : starts[i] + lengths[i]].tobytes()
        sums[i] = np.frombuffer(hashlib.blake2b(word, digest_size=8).digest(), np.uint64)[0]
    return _stirred(sums + lengths.astype(np.uint64))


def shingle_set(text: bytes | None, width: int = 4) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; a shorter text is one shingle."""
    words = word_hashes(text)
    if not len(words):
        return words
    width = min(width, len(words))
    last = len(words) - width + 1
    mixed = np.full(last, width, np.uint64)
    for i in range(width):
        mixed = _stirred(mixed * _MIX[i % 16] + words[i : i + last])
    mixed.sort()
    return mixed[np.append(True, mixed[1:] != mixed[:-1])]


def minima(shingles: np.ndarray) -> np.ndarray:
    """The minimum of each hash function over a set that is not empty."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 2**32 - 1, np.uint32)
    for at in range(0, len(short), _CHUNK):
        values = short[None, at : at + _CHUNK] ^ _MASK
        values *= _FACTOR
        np.minimum(least, values.min(axis=1), out=least)
    return least


def packed(least: np.ndarray) -> np.ndarray:
    """Two bit planes of the minima's low bits, as eight longs."""
    planes = np.zeros((2, PLANE * 64), np.uint8)
    planes[0, :HASHES] = least & 1
    planes[1, :HASHES] = least >> 1 & 1
    return np.packbits(planes, axis=1).reshape(-1).view(np.int64)


def band_keys(least: np.ndarray) -> np.ndarray:
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T.astype(np.uint64):
        key = _stirred(key * _MIX[0] + column)
    return key.view(np.int64)


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """One bit per shingle, by hash, in ``MAP`` longs."""
    bits = np.zeros(MAP * 64, np.uint8)
    bits[shingles % np.uint64(MAP * 64)] = 1
    return np.packbits(bits).view(np.int64)


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_shingles, set_key, sig, bands); the last three are null for an empty set."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, keys, sigs, bands = [], [], [], []
            for text in batch.column("text").to_pylist():
                shingles = shingle_set(text, width)
                sizes.append(len(shingles))
                least = minima(shingles) if len(shingles) else None
                keys.append(None if least is None else hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                sigs.append(None if least is None else packed(least))
                bands.append(None if least is None else band_keys(least))
            longs = pa.list_(pa.int64())
            columns = [pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, longs), pa.array(bands, longs)]
            names = ["doc_id", "n_shingles", "set_key", "sig", "bands"]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)

        return step

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return map_batches(
        rows, make, "doc_id long, n_shingles long, set_key binary, sig array<long>, bands array<long>"
    )


def _shingles_of(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(set_key, shingles as packed longs) of the wanted (doc_id, set_key)."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            keys, sets = [], []
            for text in batch.column("text").to_pylist():
                shingles = shingle_set(text, width).tobytes()
                sets.append(shingles)
                keys.append(hashlib.blake2b(shingles, digest_size=16).digest())
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sets, pa.binary())], ["set_key", "shingles"])

        return step

    texts = docs.join(wanted.select("doc_id"), "doc_id", "left_semi").select(F.col("text").cast("binary").alias("text"))
    sets = map_batches(texts, make, "set_key binary, shingles binary")
    return sets.join(wanted.select("set_key"), "set_key", "left_semi").dropDuplicates(["set_key"])


def estimate(a: Column, b: Column) -> Column:
    """Similarity from the share of equal two-bit minima, less the quarter equal by chance."""
    differ = sum(
        F.bit_count(a[i].bitwiseXOR(b[i]).bitwiseOR(a[i + PLANE].bitwiseXOR(b[i + PLANE]))) for i in range(PLANE)
    )
    return (1 - differ / HASHES - 0.25) / 0.75


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with the size of their intersection, a bitmap of what a has beyond b, and whether they link."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            common, extra, linked = [], [], []
            for left, right in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist(), strict=True):
                x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                shared = y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x
                n = int(np.count_nonzero(shared))
                common.append(n)
                extra.append(bitmap(x[~shared]))
                linked.append(100 * n >= percent * (len(x) + len(y) - n))
            arrays = [
                batch.column("a"),
                batch.column("b"),
                pa.array(common, pa.int64()),
                pa.array(extra, pa.list_(pa.int64())),
                pa.array(linked, pa.bool_()),
            ]
            return pa.RecordBatch.from_arrays(arrays, ["a", "b", "common", "extra", "linked"])

        return step

    left = sets.select(F.col("set_key").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("set_key").alias("b"), F.col("shingles").alias("sb"))
    full = pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb")
    return map_batches(full, make, "a binary, b binary, common long, extra array<long>, linked boolean")


def near_duplicates(docs: DataFrame, width: int = 4, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``.

    Documents whose shingle sets have a Jaccard similarity of ``percent`` / 100 or
    more are linked; ``component_id`` is the smallest doc_id reachable.  Null and
    blank texts have the empty set and no links.  Rows sharing a doc_id are one
    document with the links of all its texts.  A row without doc_id cannot be named
    by others: it takes part in nothing, its component is null and it is kept.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = written(sketches(docs, width), "minhash-rows")
    named = rows.filter("doc_id IS NOT NULL AND set_key IS NOT NULL")
    # One row per distinct set; copies are reduced before the shuffle.
    best = F.struct("doc_id", "n_shingles", "sig", "bands")
    single = written(named.groupBy("set_key").agg(F.min(best).alias("best")).select("set_key", "best.*"), "minhash-sets")
    classes = single.select("set_key", "doc_id")

    banded = single.select("set_key", F.posexplode("bands").alias("band", "bucket"))
    counts = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = written(banded.join(counts, "bucket"), "minhash-members")
    fame = members.groupBy("set_key").agg(F.sum("size").alias("fame"))
    hubs = (
        members.join(fame, "set_key")
        .groupBy("bucket")
        .agg(F.min(F.struct((-F.col("fame")).alias("rank"), "set_key")).alias("top"))
        .select("bucket", F.col("top.set_key").alias("hub"))
    )
    with_hub = written(members.join(hubs, "bucket"), "minhash-hubs")

    met = fame.select("set_key").join(single.select("set_key", "doc_id", "sig", "bands", "n_shingles"), "set_key")
    met = written(met, "minhash-met")
    sets = written(_shingles_of(docs, met, width), "minhash-shingles")

    sig = met.select("set_key", "sig")
    spokes = (
        with_hub.filter("set_key != hub").select(F.col("set_key").alias("a"), F.col("hub").alias("b")).distinct()
        .join(sig.select(F.col("set_key").alias("a"), F.col("sig").alias("ga")), "a")
        .join(sig.select(F.col("set_key").alias("b"), F.col("sig").alias("gb")), "b")
        .filter(estimate(F.col("ga"), F.col("gb")) >= HUB_FLOOR)
    )
    spokes = written(_confirmed(spokes, sets, percent), "minhash-spokes")
    links = spokes.filter("linked").select(F.col("a").alias("src"), F.col("b").alias("dst"))
    more = written(
        _confirmed(_across(with_hub, met, spokes, links, percent), sets, percent), "minhash-across"
    )
    links = links.union(more.filter("linked").select(F.col("a"), F.col("b")))

    shared = named.groupBy("doc_id").agg(F.min("set_key").alias("dst"), F.max("set_key").alias("top")).filter("dst != top")
    shared = named.join(shared, "doc_id").filter("set_key != dst").select(F.col("set_key").alias("src"), "dst")
    links = links.union(shared)

    groups = _components(links)
    smallest = groups.join(classes, "set_key").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    labels = groups.join(smallest, "component").select("set_key", "component_id")
    labels = classes.join(labels, "set_key", "left").select(
        "set_key", F.coalesce("component_id", "doc_id").alias("component_id")
    )
    labels = written(labels, "minhash-labels")
    # An empty set is hashed by its document, so that blank texts do not meet in one task.
    key = F.coalesce(F.col("set_key"), F.col("doc_id").cast("string").cast("binary"))
    result = rows.select("doc_id", "n_shingles", key.alias("set_key")).join(labels, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return result.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def _components(links: DataFrame) -> DataFrame:
    """(set_key, component) of the sets that have links."""
    links = written(links, "minhash-links")
    ends = links.select(F.col("src").alias("id")).union(links.select("dst"))
    return connected_components(ends, links).select(F.col("id").alias("set_key"), "component")


def _across(with_hub: DataFrame, met: DataFrame, spokes: DataFrame, links: DataFrame, percent: int) -> DataFrame:
    """Pairs of one bucket in different components that may still be similar.

    Of two sets in a bucket, |x & y| <= min(hx, hy) + |ex & ey|: h is what a set shares
    with the common hub, e what it has beyond it.  |ex & ey| is bounded by the common
    bits of their bitmaps plus the shingles of either set that share a bit.  Variants of
    one text edited in different places are told apart by this without being paired.
    A pair is taken from its first common band.
    """
    labelled = (
        with_hub.join(_components(links).withColumnRenamed("component", "label"), "set_key", "left")
        .withColumn("label", F.coalesce("label", "set_key"))
    )
    mixed = labelled.groupBy("bucket").agg(F.min("label").alias("l0"), F.max("label").alias("l1")).filter("l0 != l1")
    shares = spokes.select(F.col("a").alias("set_key"), F.col("b").alias("hub"), F.col("common").alias("shared"), "extra")
    side = (
        labelled.filter("set_key != hub")  # hubs have met all others already
        .join(mixed.select("bucket"), "bucket", "left_semi")
        .join(shares, ["set_key", "hub"], "left")
        .join(met.select("set_key", "sig", "bands", F.col("n_shingles").alias("n")), "set_key")
    )
    alone = F.col("n") - F.col("shared") - sum(F.bit_count(F.col("extra")[i]) for i in range(MAP))  # without a bit of their own
    side = side.select("bucket", "band", "set_key", "label", "shared", "n", "extra", alone.alias("alone"), "sig", "bands")
    side = written(side, "minhash-sides")
    x = side.select("bucket", *[F.col(c).alias(f"x_{c}") for c in side.columns if c != "bucket"])
    y = side.select("bucket", *[F.col(c).alias(f"y_{c}") for c in side.columns if c != "bucket"])
    total = F.col("x_n") + F.col("y_n")
    bits = sum(F.bit_count(F.col("x_extra")[i].bitwiseAND(F.col("y_extra")[i])) for i in range(MAP))
    beyond = F.least(
        F.col("x_n") - F.col("x_shared"), F.col("y_n") - F.col("y_shared"), bits + F.least("x_alone", "y_alone")
    )
    most = F.coalesce(F.least("x_shared", "y_shared") + beyond, F.least("x_n", "y_n"))
    first = F.array_position(F.zip_with("x_bands", "y_bands", lambda p, q: p == q), True) - 1
    near = (
        (F.col("x_set_key") < F.col("y_set_key"))
        & (F.col("x_label") != F.col("y_label"))
        & (100 * F.least("x_n", "y_n") >= percent * F.greatest("x_n", "y_n"))
        & (100 * most >= percent * (total - most))
        & (estimate(F.col("x_sig"), F.col("y_sig")) >= FLOOR)
        & (first == F.col("x_band"))
    )
    return x.join(y, (x["bucket"] == y["bucket"]) & near).select(
        F.col("x_set_key").alias("a"), F.col("y_set_key").alias("b")
    )
