"""The prefix trie of conversations, from sorted sequences and their longest common prefixes.

A conversation is a sequence of turns; a turn is its digest (16 bytes of SHA-256 over role
and text).  Sorted sequences that share a prefix are neighbours, so a trie node is an
interval of them.  For each distinct sequence i and each depth that its left neighbour
does not share, the prefix is a *candidate*: a sparse table of range minima over the common
prefix lengths (LCP) is searched by halving steps for its right extent, and, for the parent
of the first such prefix, for the left extent as well; each search is independent of all
others, no stack, and numpy runs them for a whole block at once.  Counts, leaves, children
and token sums are then differences of prefix sums, the smallest member a range minimum.

On Spark.  Sequences are range-partitioned and sorted by their digests; equal ones become
one row, whose member ids arrive in lists of at most 4096 ids, so thousands of copies are a
few rows.  Blocks of at most ``BLOCK`` sequences are solved by one task each.  Nodes that
reach across a block's end (the *spine*: prefixes of the last sequence of a block) leave a
part in every block they touch; a second sparse table over the least LCP of each block
finds the block a part began in, and an aggregate adds the parts up.  The driver holds two
numbers per block and nothing else.

A task holds one block, or the digests (16 bytes a turn) of one conversation; texts never
leave the scan.  Defined cases: null role or text is empty; rows without conv_id belong to
no conversation; rows of one turn are ordered by digest; an empty table has no nodes, not
even a root; other columns of the input do not matter.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import give_back, map_arrow, written

BLOCK = 16  # a block holds 2 ** BLOCK distinct sequences at most
IDS = 12  # member ids travel in lists of 2 ** IDS at most
WIDTH = 16  # bytes of a turn's digest
NOBODY = hashlib.sha256(b"").hexdigest()


# --- sequences ------------------------------------------------------------------------


def _turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, seq): the turns of each conversation in order, as (digest, code points of the text)."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    digest = F.unhex(F.substring(F.sha2(named.cast("binary"), 256), 1, 2 * WIDTH))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").cast("long").alias("turn"), digest.alias("h"), F.char_length(text).alias("n")).alias("t"),
    )
    ordered = F.sort_array(F.collect_list("t"))  # nulls first
    return rows.groupBy("conv_id").agg(F.transform(ordered, lambda t: F.struct(t.h.alias("h"), t.n.alias("n"))).alias("seq"))


def _sequence(seq) -> list:
    key = F.unhex(F.array_join(F.transform(seq, lambda t: F.hex(t.h)), ""))
    return ["conv_id", key.alias("key"), F.transform(seq, lambda t: t.n).alias("sizes")]


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, key, sizes) of every conversation as it is."""
    return _turns(conversations).select(*_sequence(F.col("seq")))


def rebuilt(conversations: DataFrame, group: int = 100, most: int = 5) -> DataFrame:
    """(conv_id, key, sizes): conversation c takes its first h turns from c - c % group.

    h is the unsigned crc32 of the decimal conv_id modulo ``most`` + 1; its own turns after
    the first h follow.
    """
    # Read once: it is joined with itself.
    own = written(_turns(conversations), "trie-turns")
    heads = own.filter(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.slice("seq", 1, most).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    both = own.withColumns({"base": F.col("conv_id") - F.col("conv_id") % group, "h": h}).join(heads, "base", "left")
    none = F.slice("seq", 1, 0)
    seq = F.concat(F.coalesce(F.slice("head", F.lit(1), F.col("h")), none), F.slice("seq", F.col("h") + 1, F.size("seq")))
    return both.select("conv_id", seq.alias("seq")).select(*_sequence(F.col("seq")))


_SORTED = "lcp int, sizes array<int>, n long, least long, ends string, edge binary"


def _common(a: bytes, b: bytes) -> int:
    """Turns that two sequences share at their beginning."""
    if a == b[: len(a)]:
        return len(a) // WIDTH
    return len(os.path.commonprefix((a, b))) // WIDTH


def _sorted(seqs: DataFrame) -> DataFrame:
    """Distinct sequences in order, each with the LCP of its left neighbour; none for the first of a partition."""
    lists = seqs.groupBy("key", F.shiftright("conv_id", IDS).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("conv_id").alias("least"),
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string")), ",").alias("ids"),
        F.any_value("sizes").alias("sizes"),
    )
    ordered = lists.repartitionByRange("key").sortWithinPartitions("key", "bucket")

    def distinct(rows: Iterator[dict]) -> Iterator[dict]:
        before, now, digest = None, None, None
        for row in rows:
            if now is not None and row["key"] == now["key"]:
                digest.update(f",{row['ids']}".encode())
                now["n"] += row["n"]
                now["least"] = min(now["least"], row["least"])
                continue
            if now is not None:
                yield now | {"ends": digest.hexdigest(), "edge": now["key"] if before is None else None}
                before = now["key"]
            digest = hashlib.sha256(row["ids"].encode())
            now = row | {"lcp": None if now is None else _common(now["key"], row["key"])}
        if now is not None:
            yield now | {"ends": digest.hexdigest(), "edge": now["key"]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        rows = (row for batch in batches for at in range(0, batch.num_rows, 1024) for row in batch.slice(at, 1024).to_pylist())
        held = []
        for row in distinct(rows):
            held.append(row)
            if len(held) == 1024:
                yield pa.RecordBatch.from_pylist(held, schema)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    schema = _arrow(_SORTED)
    return written(map_arrow(ordered, run, _SORTED).withColumn("at", F.monotonically_increasing_id()), "trie-sorted")


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


# --- range minima ---------------------------------------------------------------------


class Minima:
    """Sparse table over an array: range minima and how far a bound holds on either side."""

    def __init__(self, values: np.ndarray):
        self.rows, width = [values], 1
        while 2 * width <= len(values):
            last = self.rows[-1]
            self.rows.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Minimum of values[low .. high], both included."""
        out = np.empty(len(low), self.rows[0].dtype)
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.rows[k][low[at]], self.rows[k][high[at] - (1 << int(k)) + 1])
        return out

    def right(self, at: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The last place r with values[at + 1 .. r] >= bound."""
        r, last = at.copy(), len(self.rows[0]) - 1
        for k in range(len(self.rows) - 1, -1, -1):
            row, step = self.rows[k], 1 << k
            go = r + step <= last
            go &= row[np.where(go, r + 1, 0)] >= bound
            r += step * go
        return r

    def left(self, at: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The first place l with values[l + 1 .. at] >= bound."""
        first = at.copy()
        for k in range(len(self.rows) - 1, -1, -1):
            row, step = self.rows[k], 1 << k
            go = first >= step
            go &= row[np.where(go, first - step + 1, 0)] >= bound
            first -= step * go
        return first


class Blocks:
    """What every task knows of all blocks: their ids, least LCPs, and the LCPs of their first rows."""

    def __init__(self, ids: np.ndarray, least: np.ndarray, first: np.ndarray):
        self.ids, self.least, self.first = ids, least, first
        self.minima = Minima(least)

    def place(self, block: int) -> int:
        return int(np.searchsorted(self.ids, block))

    def began(self, place: int, depths: np.ndarray) -> np.ndarray:
        """The blocks in which the prefixes that enter block ``place`` begin."""
        return self.ids[self.minima.left(np.full(len(depths), place - 1), depths)]


# --- one block ------------------------------------------------------------------------

CLOSED, OPEN, ENTERING = range(3)
_PARTS = (
    "kind int, block long, depth long, conv_id long, n_convs long, n_children long, n_leaves long, saved long, "
    "size long, ends string, parent_conv_id long, up_block long, up_depth long"
)


def _block_parts(block: int, blocks: Blocks, rows: pa.Table, schema: pa.Schema) -> pa.RecordBatch:
    place = blocks.place(block)
    m = rows.num_rows
    sizes = rows.column("sizes").combine_chunks()
    lens = pc.list_value_length(sizes).to_numpy().astype(np.int64)
    flat = sizes.flatten().to_numpy().astype(np.int64)
    base = np.cumsum(lens) - lens
    lcp = rows.column("lcp").to_numpy().astype(np.float64)  # null, at the first row of a partition only, is nan
    lcp[0] = blocks.first[place]
    lcp = lcp.astype(np.int64)
    after = int(blocks.first[place + 1]) if place + 1 < len(blocks.ids) else -1
    members, least = rows.column("n").to_numpy(), Minima(rows.column("least").to_numpy())
    table = Minima(lcp)

    count = lens - lcp  # prefixes that begin here: depths lcp + 1 .. len
    offset = np.cumsum(count) - count
    start = np.repeat(np.arange(m), count)
    depth = np.arange(len(start)) - offset[start] + lcp[start] + 1
    right = table.right(start, depth)
    opened = (right == m - 1) & (after >= depth)
    sums = np.concatenate(([0], np.cumsum(members)))
    leaf = np.concatenate(([0], np.cumsum(np.append(lcp[1:], after) < lens)))
    codes = np.sort(lcp * (m + 1) + np.arange(m))

    def upto(d, r):
        return np.searchsorted(codes, d * (m + 1) + r, "right")

    n = sums[right + 1] - sums[start]
    size = np.where(depth > 0, flat[np.where(depth > 0, base[start] + depth - 1, 0)] if len(flat) else 0, 0)
    own = np.concatenate(([0], np.cumsum(np.where(opened, 0, (n - 1) * size))))
    ends = offset + count
    smallest = least.least(start, right)

    # The parent: one turn less on the same sequence, or the prefix shared with the left neighbour.
    up_depth = depth - 1
    top = up_depth == lcp[start]
    parent = np.arange(len(start)) - 1
    low = table.left(start[top], up_depth[top])
    outside = np.zeros(len(start), bool)
    outside[top] = (low == 0) & (lcp[0] >= up_depth[top])
    parent[top] = offset[low] + up_depth[top] - lcp[low] - 1
    parent[outside | (depth == 0)] = 0
    spine = (outside | opened[parent]) & (depth > 0)
    up_block = np.full(len(start), block)
    up_block[outside] = blocks.began(place, up_depth[outside])
    known = (depth > 0) & ~spine

    entering = np.arange(max(int(lcp[0]), -1) + 1)
    zero = np.zeros(len(entering), np.int64)
    reach = table.right(zero, entering)
    extra = len(entering)

    def both(nodes, parts):
        return pa.array(np.concatenate((nodes, parts)).astype(np.int64))

    def maybe(nodes, mask):
        return pa.array(np.concatenate((nodes, zero)).astype(np.int64), mask=np.concatenate((~mask, np.ones(extra, bool))))

    mine = rows.column("ends").combine_chunks().take(pa.array(start))
    mine = pc.if_else(pa.array(depth == lens[start]), mine, pa.scalar(NOBODY))
    columns = [
        pa.array(np.concatenate((np.where(opened, OPEN, CLOSED), np.full(extra, ENTERING))).astype(np.int32)),
        both(np.full(len(start), block), blocks.began(place, entering) if extra else zero),
        both(depth, entering),
        both(smallest, least.least(zero, reach)),
        both(n, sums[reach + 1]),
        both((lens[start] > depth) + upto(depth, right) - upto(depth, start), upto(entering, reach) - upto(entering, zero - 1)),
        both(leaf[right + 1] - leaf[start], leaf[reach + 1]),
        both(own[ends[right]] - own[:-1], own[ends[reach]]),
        both(size, zero),
        pa.concat_arrays([mine, pa.nulls(extra, pa.string())]),
        maybe(smallest[parent], known),
        maybe(up_block, spine),
        maybe(up_depth, spine),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _parts(rows: DataFrame, blocks: Blocks, bits: int) -> DataFrame:
    """Nodes within blocks, and the parts of those that reach across."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        block, held = None, []
        for batch in batches:
            ids = batch.column("at").to_numpy() >> bits
            cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
            for begin, end in zip(cuts, cuts[1:], strict=False):
                if begin == end:
                    continue
                if held and ids[begin] != block:
                    yield _block_parts(block, blocks, pa.Table.from_batches(held), schema)
                    held = []
                block = int(ids[begin])
                held.append(batch.slice(begin, end - begin))
        if held:
            yield _block_parts(block, blocks, pa.Table.from_batches(held), schema)

    schema = _arrow(_PARTS)
    narrow = rows.select("at", "lcp", "sizes", "n", "least", "ends")
    dealt = narrow.repartition(F.shiftright("at", bits)).sortWithinPartitions("at")
    return written(map_arrow(dealt, run, _PARTS), "trie-parts")


def _blocks(rows: DataFrame, bits: int) -> Blocks:
    """Two numbers per block of 2 ** bits sequences, once the partitions' edges have met."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            found = []
            for at, lcp, edge in zip(*(batch.column(c).to_pylist() for c in ("at", "lcp", "edge")), strict=True):
                if lcp is None:
                    found.append((at, -1 if before is None else _common(before, edge)))
                before = edge
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([c for _, c in found], pa.int32())], ["at", "lcp"])

    # Two rows per partition.
    edges = rows.filter("edge IS NOT NULL").select("at", "lcp", "edge").repartition(1).sortWithinPartitions("at")
    firsts = {r.at: r.lcp for r in map_arrow(edges, meet, "at long, lcp int").collect()}
    block = F.shiftright("at", bits).alias("block")
    found = rows.groupBy(block).agg(F.min("at").alias("at"), F.min("lcp").alias("least"), F.min_by("lcp", "at").alias("first")).collect()
    table = []
    for r in sorted(found, key=lambda r: r.block):
        first = firsts[r.at] if r.at in firsts else r.first
        table.append((r.block, first if r.least is None else min(first, r.least), first))
    ids, least, first = np.array(table, np.int64).reshape(-1, 3).T
    return Blocks(ids, least, first)


def _spine(parts: DataFrame, blocks: Blocks) -> DataFrame:
    """Nodes that reach across blocks, their parts added up."""
    sums = {c: F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")}
    once = {c: F.max(c).alias(c) for c in ("size", "ends", "up_block", "up_depth")}  # from the block where it begins
    nodes = parts.filter(F.col("kind") != CLOSED).groupBy("block", "depth")
    nodes = nodes.agg(F.min("conv_id").alias("conv_id"), *sums.values(), *once.values())
    nodes = written(nodes.withColumn("own", (F.col("n_convs") - 1) * F.col("size")), "trie-spine")

    def above(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each block's own spine once more for the prefixes that enter the block."""
        for batch in batches:
            for block, total in zip(batch.column("block").to_pylist(), batch.column("total").to_pylist(), strict=True):
                place = blocks.place(block)
                depths = np.arange(blocks.least[place] + 1)
                if len(depths):
                    columns = [pa.array(blocks.began(place, depths)), pa.array(depths.astype(np.int64)), pa.array(np.full(len(depths), total, np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, ["block", "depth", "more"])

    totals = nodes.groupBy("block").agg(F.sum("own").alias("total"))
    more = map_arrow(totals, above, "block long, depth long, more long").groupBy("block", "depth").agg(F.sum("more").alias("more"))
    # A block's spine is one path: what is deeper lies below.
    below = F.sum("own").over(Window.partitionBy("block").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0))
    whole = nodes.withColumn("below", below).join(more, ["block", "depth"], "left")
    return whole.withColumn("saved", F.col("saved") + F.col("below") + F.coalesce("more", F.lit(0)))


NODES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefix_trie(seqs: DataFrame, block: int | None = None) -> DataFrame:
    """One row per distinct prefix of the (conv_id, key, sizes) sequences, the empty one included."""
    bits = BLOCK if block is None else block
    rows = _sorted(seqs)
    if rows.isEmpty():
        return rows.sparkSession.createDataFrame([], ", ".join(f"{c} {'string' if c == 'ends_sha256' else 'long'}" for c in NODES))
    blocks = _blocks(rows, bits)
    parts = _parts(rows, blocks, bits)
    spine = written(_spine(parts, blocks), "trie-spine")
    same = [c for c in parts.columns if c not in ("kind", "size", "parent_conv_id")]
    nodes = parts.filter(F.col("kind") == CLOSED).select(*same, "parent_conv_id")
    nodes = nodes.unionByName(spine.select(*same, F.lit(None).cast("long").alias("parent_conv_id")))
    # The parents in the spine, first once per block: the root has children in every one.
    asked = nodes.filter("up_block IS NOT NULL").select("block", "up_block", "up_depth").distinct()
    ids = spine.select(F.col("block").alias("up_block"), F.col("depth").alias("up_depth"), F.col("conv_id").alias("up_id"))
    told = asked.join(ids, ["up_block", "up_depth"])
    reached = nodes.filter("up_block IS NOT NULL").drop("parent_conv_id").join(told, ["block", "up_block", "up_depth"])
    out = nodes.filter("up_block IS NULL").unionByName(reached.withColumnRenamed("up_id", "parent_conv_id"))
    return out.withColumnsRenamed({"saved": "saved_tokens", "ends": "ends_sha256"}).select(*NODES)
