"""Token ids in binary files: a static range asymmetric numeral system (rANS).

Writing.  Documents are dealt into ranges of (doc_id, hash of the text) and sorted there;
a null id comes first, rows that repeat an id follow each other by hash and text.  Each
range is tokenised in this order and cut into *groups* of whole documents of about
``GROUP_TOKENS`` ids.  A group carries one frequency table, counted over all of its ids
and shared by its *blocks* of ``BLOCK_TOKENS`` ids.  A block is independent of all
others: ``lanes`` coders take turns, id ``t`` belongs to lane ``t mod lanes``, and their
words are interleaved in one stream.  It starts with the states of its lanes and holds a
*checkpoint* (states, place in the stream) every ``CHECKPOINT_STEPS`` steps, so decoding
can begin inside; a CRC-32 covers its bytes, another one its ids.  Groups are rows of a
Parquet table, so any engine finds, prunes and splits them, and a lost task repeats only
its own range.

Reading.  Each group is decoded on its own; a wrong checksum or a truncated block fails
the job instead of returning other ids.  Only the number of ids per range (one number a
partition) goes to the driver, to turn places within a range into places in the corpus.

A task holds one group of ids (2 or 4 bytes each) or, if that is longer, one document.
Null and empty texts consist of the end id alone.  An empty table gives no rows.
"""

from __future__ import annotations

import json
import struct
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from .bpe import _assigned, byte_alphabet
from .common import give_back, holds, map_arrow, written

GROUP_TOKENS = 1 << 21
BLOCK_TOKENS = 1 << 20
CHECKPOINT_STEPS = 128
LANES = 4096
SCALE, FINER = 16, 3  # frequencies add up to 2 ** SCALE, or so many bits more than the ids of a table need
LOW = 31  # states stay in [2 ** LOW, 2 ** (LOW + 32))
STRETCH = 1 << 16  # characters that are encoded at a time
_HEAD = struct.Struct("<4sIIIIII")  # magic, lanes, ids, words, checkpoints, crc of ids, crc of what follows
_MAGIC = b"KRA1"

GROUPS = (
    "part int, seq int, first long, n_tokens long, doc_ids array<bigint>, lengths array<bigint>, "
    "width int, symbols binary, frequencies binary, blocks array<binary>"
)


def _parse(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


# --- tokens ---------------------------------------------------------------------------


def _ranked(path: str) -> tiktoken.Encoding | None:
    """The same merges for tiktoken's merger; None unless ids rise with the rank of their merge.

    Both mergers join the pair of lowest rank, leftmost first.  One knows pairs, the other
    the bytes they join to; inside the bytes of a token, merges run in the same order
    whatever stands around it, so no other pair for the same bytes ever meets.
    """
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    back = {c: b for b, c in enumerate(byte_alphabet())}
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    vocab = model["vocab"]
    order = [vocab[a + b] for a, b in merges]
    known = {*back, *(a + b for a, b in merges)}
    alone = max(vocab[c] for c in back) < order[0] if order and back.keys() <= vocab.keys() else False
    if model["type"] != "BPE" or not alone or any(x >= y for x, y in zip(order, order[1:], strict=False)):
        return None
    ranks = {bytes(back[c] for c in token): vocab[token] for token in known}
    return tiktoken.Encoding("same", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class Tokens:
    """Texts to ids as the tokenizers library makes them.

    The library's merges are carried out by tiktoken, which takes a fifth of its time.  Texts
    with a special token or with characters newer than our Unicode tables, and tokenizers
    that ``_ranked`` refuses, go through the library itself, cut into stretches of about
    ``STRETCH`` characters at blanks between other signs, where a new piece always begins.
    """

    _cut = regex.compile(r"(?<=\S) (?=\S)")

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        size = self.library.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.code = "H" if size <= 1 << 16 else "I"  # the same in an array of the standard library
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.merger = _ranked(path)

    def ids(self, text: str | None) -> bytes:
        """All ids of a whole text as little-endian integers; null is empty."""
        if not text:
            return b""
        if self.merger is None or any(s in text for s in self.special) or not self._known(text):
            return b"".join(map(self._whole, self._stretches(text)))
        ids = array(self.code, self.merger.encode_ordinary(text))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def _known(self, text: str) -> bool:
        # Printable text holds assigned characters only; most texts are, but for line breaks.
        return text.replace("\n", "").isprintable() or _assigned("".join(set(text)))

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _stretches(self, text: str) -> Iterator[str]:
        at = 0
        while cut := self._cut.search(text, at + STRETCH):
            yield text[at : cut.start()]
            at = cut.start()
        yield text[at:]


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokens:
    """One per worker process and file."""
    return Tokens(path)


holds(tokenizer.cache_clear)


# --- coder ----------------------------------------------------------------------------


class Table:
    """Symbols and frequencies that add up to a power of two, 2 ** scale."""

    def __init__(self, symbols: np.ndarray, frequencies: np.ndarray):
        self.symbols, self.frequencies = symbols.astype(np.int64), frequencies.astype(np.uint64)
        whole = int(self.frequencies.sum())
        self.scale = whole.bit_length() - 1
        if whole != 1 << self.scale or not SCALE <= self.scale < LOW or len(symbols) != len(frequencies):
            raise ValueError("damaged frequency table")
        self.starts = np.concatenate(([0], np.cumsum(self.frequencies)[:-1])).astype(np.uint64)

    @classmethod
    def of(cls, ids: np.ndarray) -> Table:
        """From all ids; every id that occurs gets one part of the scale at least."""
        counts = np.bincount(ids)
        symbols = np.flatnonzero(counts)
        whole = 1 << max(SCALE, len(symbols).bit_length() + FINER)
        scaled = np.maximum(counts[symbols] * (whole / len(ids)), 1).astype(np.int64)
        order = np.argsort(-scaled, kind="stable")
        missing = whole - int(scaled.sum())
        scaled[order[0]] += max(missing, 0)
        at = 0
        while missing < 0:  # the least of one took too much: the most frequent give it back
            give = min(-missing, int(scaled[order[at]]) // 2)
            scaled[order[at]] -= give
            missing += give
            at += 1
        return cls(symbols, scaled)

    def encoder(self) -> tuple[int, np.ndarray, np.ndarray]:
        """Scale; frequency and start by id."""
        size = int(self.symbols[-1]) + 1
        frequency, start = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        frequency[self.symbols], start[self.symbols] = self.frequencies, self.starts
        return self.scale, frequency, start

    def decoder(self) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Scale; place among the symbols by slot of the scale; symbols, frequencies and starts by place."""
        kind = np.uint16 if len(self.symbols) <= 1 << 16 else np.uint32
        places = np.repeat(np.arange(len(self.symbols), dtype=kind), self.frequencies.astype(np.int64))
        return self.scale, places, self.symbols, self.frequencies, self.starts


_SHIFT, _WORD, _LOWEST = np.uint64(32), np.uint64(0xFFFFFFFF), np.uint64(1 << LOW)


def encode_block(ids: np.ndarray, table: tuple[int, np.ndarray, np.ndarray], lanes: int = LANES, every: int = CHECKPOINT_STEPS) -> bytes:
    """One independent block of one id or more; all of them must be in the table."""
    n = len(ids)
    lanes = max(1, min(lanes, n >> 4))
    scale, room = np.uint64(table[0]), np.uint64(LOW + 32 - table[0])
    frequency, start = table[1][ids], table[2][ids]
    state = np.full(lanes, _LOWEST, np.uint64)
    chunks, points, sent = [], [], 0
    for step in range((n - 1) // lanes, -1, -1):
        begin, end = step * lanes, min(n, (step + 1) * lanes)
        f, x = frequency[begin:end], state[: end - begin]
        full = x >= (f << room)
        out = x[full]
        if len(out):
            chunks.append((out & _WORD).astype("<u4"))
            sent += len(out)
            x[full] = out >> _SHIFT
        whole = x // f
        x -= whole * f
        x += (whole << scale) + start[begin:end]
        if step and step % every == 0:
            points.append((step, sent, state.copy()))
    body = bytearray(state.astype("<u8").tobytes())
    for step, after, states in reversed(points):
        body += struct.pack("<II", step, sent - after) + states.astype("<u8").tobytes()
    for chunk in reversed(chunks):
        body += chunk.tobytes()
    ids_crc = zlib.crc32(ids.astype("<u4").tobytes())
    return _HEAD.pack(_MAGIC, lanes, n, sent, len(points), ids_crc, zlib.crc32(body)) + bytes(body)


def checkpoints(block: bytes) -> list[int]:
    """Places among the ids of a block from which it can be decoded; the first is 0."""
    _, lanes, _, _, points, _, _ = _HEAD.unpack_from(block)
    at = _HEAD.size + 8 * lanes
    return [0, *(struct.unpack_from("<I", block, at + i * (8 + 8 * lanes))[0] * lanes for i in range(points))]


def decode_block(block: bytes, table: tuple, checkpoint: int = 0) -> np.ndarray:
    """The ids of a block from its ``checkpoint``-th checkpoint on; damage raises ValueError."""
    if len(block) < _HEAD.size:
        raise ValueError("truncated block")
    magic, lanes, n, sent, points, ids_crc, body_crc = _HEAD.unpack_from(block)
    size = 8 * lanes + points * (8 + 8 * lanes) + 4 * sent
    if magic != _MAGIC or len(block) != _HEAD.size + size or zlib.crc32(memoryview(block)[_HEAD.size :]) != body_crc:
        raise ValueError("damaged block")
    at, step, word = _HEAD.size, 0, 0
    if checkpoint:
        at += 8 * lanes + (checkpoint - 1) * (8 + 8 * lanes)
        step, word = struct.unpack_from("<II", block, at)
        at += 8
    state = np.frombuffer(block, "<u8", lanes, at).astype(np.uint64)
    words = np.frombuffer(block, "<u4", sent, len(block) - 4 * sent).astype(np.uint64)
    bits, places, symbols, frequency, start = table
    scale, mask = np.uint64(bits), np.uint64((1 << bits) - 1)
    found = np.empty(n - step * lanes, places.dtype)
    for begin in range(0, len(found), lanes):
        end = min(len(found), begin + lanes)
        x = state[: end - begin]
        slot = x & mask
        place = places[slot]
        found[begin:end] = place
        x >>= scale
        x *= frequency[place]
        x += slot - start[place]
        empty = x < _LOWEST
        need = int(np.count_nonzero(empty))
        if need:
            x[empty] = (x[empty] << _SHIFT) | words[word : word + need]
            word += need
    ids = symbols[found]
    if word != sent or (not checkpoint and zlib.crc32(ids.astype("<u4").tobytes()) != ids_crc):
        raise ValueError("damaged ids")
    return ids


# --- files ----------------------------------------------------------------------------


def default_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def _group(part: int, seq: int, first: int, names: list, lengths: list[int], ids: np.ndarray, block: int) -> dict:
    row = {"part": part, "seq": seq, "first": first, "n_tokens": len(ids), "doc_ids": names, "lengths": lengths, "width": ids.dtype.itemsize}
    table = Table.of(ids)
    coder = table.encoder()
    row["symbols"] = zlib.compress(table.symbols.astype("<u4").tobytes(), 1)
    row["frequencies"] = zlib.compress(table.frequencies.astype("<u4").tobytes(), 1)
    row["blocks"] = [encode_block(ids[at : at + block], coder) for at in range(0, len(ids), block)]
    return row


def write(
    docs: DataFrame, path: str | None = None, end_id: int = 0, group: int = GROUP_TOKENS, block: int = BLOCK_TOKENS
) -> DataFrame:
    """The groups of all documents in ascending doc_id order, as a table in the shared folder.

    Every text is followed by ``end_id``.  Columns of ``docs`` other than doc_id and text do
    not matter.
    """
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        coder, part = tokenizer(path), TaskContext.get().partitionId()
        end = np.array([end_id], coder.dtype).tobytes()
        seq = first = size = 0
        names, texts = [], []

        def closed() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(texts), coder.dtype)
            lengths = [len(t) // coder.dtype.itemsize for t in texts]
            return pa.RecordBatch.from_pylist([_group(part, seq, first, names, lengths, ids, block)], schema)

        for batch in batches:
            for name, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = coder.ids(text.as_py()) + end
                names.append(name)
                texts.append(ids)
                size += len(ids) // coder.dtype.itemsize
                if size >= group:
                    yield closed()
                    seq, first, size = seq + 1, first + size, 0
                    names, texts = [], []
        if texts:
            yield closed()

    schema = to_arrow_schema(_parse(GROUPS))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("_h", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "_h").sortWithinPartitions("doc_id", "_h", "text").select("doc_id", "text")
    return written(map_arrow(ordered, run, GROUPS), "token-files", maxRecordsPerFile=16)


def _decoded(row: dict) -> np.ndarray:
    symbols = np.frombuffer(zlib.decompress(row["symbols"]), "<u4")
    table = Table(symbols, np.frombuffer(zlib.decompress(row["frequencies"]), "<u4")).decoder()
    ids = np.concatenate([decode_block(b, table) for b in row["blocks"]])
    if len(ids) != row["n_tokens"] or sum(row["lengths"]) != len(ids):
        raise ValueError("a group does not hold the ids that it names")
    return ids


def _each_document(groups: DataFrame, schema: str, values) -> DataFrame:
    """One row per document of every group: doc_id, start, n_tokens and what ``values`` makes of its ids."""
    sizes = groups.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()  # a number per partition
    before, total = {}, 0
    for row in sizes:
        before[row.part] = total
        total += row.n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids = _decoded(row).astype("<u4")
                ends = np.cumsum(np.array(row["lengths"], np.int64))
                starts = ends - np.array(row["lengths"], np.int64)
                found = [values(ids[a:b]) for a, b in zip(starts, ends, strict=True)]
                columns = [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(starts + (before[row["part"]] + row["first"])),
                    pa.array(ends - starts),
                    pa.array(found, kind),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    parsed = to_arrow_schema(_parse(schema))
    names, kind = parsed.names, parsed.field(3).type
    return map_arrow(groups, run, schema)


def read(groups: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) from the files; ``start`` counts the ids of all documents before."""
    return _each_document(groups, "doc_id long, start long, n_tokens long, ids array<bigint>", lambda ids: ids.astype(np.int64))


def digests(groups: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the files, without sending ids back."""
    return _each_document(groups, "doc_id long, start long, n_tokens long, ids_crc32 long", lambda ids: zlib.crc32(ids.tobytes()))
