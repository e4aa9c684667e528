"""Conversation structure repair: a run-length dynamic program over role/fault symbols.

Legal conversations read ``(s?(ua)+)?`` in the initials of their roles, a machine of four
states (nothing, after s, after u, after a).  A row is a symbol: its initial (s, u, a or
another) and what its fault allows (nothing wrong, only deletion, or a truncated text).
Passing a symbol is a 4 x 4 min-plus matrix over the states: insertions before the row,
then Keep, Rerole or Delete.  Equal consecutive symbols are one *run*; a run of n rows
is passed by the cached binary powers of its symbol's matrix.  Backward over the runs this
gives what any state still has to pay, and forward the choices are unrolled: at each step
the ASCII-least edit that still reaches the least cost, which makes the least audit.

On Spark.  Rows are reduced to symbols and digests before any shuffle; equal rows become
one with a number of copies; rows get their order from a range partitioning by
(conv_id, turn, digest), so a conversation of a third of all rows is spread.  First
occurrences come from an aggregate and an N:1 join.  Segments of at most ``SEGMENT``
consecutive rows are collapsed to runs, and one task per conversation then sees its runs
and writes its audit, which is one cell of the result anyway.  Texts are shuffled once, to
meet the audit: they stream past it in order, one at a time, as SHA-256 demands.

Defined cases: a null role or text is one blank; rows without conv_id form a conversation
of their own; rows of one turn are ordered by the SHA-256 of ``length:role`` and text;
equal rows are duplicates of each other; an empty table gives no rows; other columns of
the input do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import SPACES, give_back, map_arrow, written

SEGMENT = 12  # a segment holds 2 ** SEGMENT rows at most
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1  # costs
INITIALS = "sua"
FINE, LOST, CUT = range(3)  # what a fault allows: anything, only deletion, anything at a price

# --- the machine ----------------------------------------------------------------------

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
_AFTER = (USER, USER, ASSISTANT, USER)  # the one state that an inserted or reroled turn leads to
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_FAR = 1 << 60


def _kept(initial: int, state: int) -> int | None:
    """Where a kept row leads; initial is a place in INITIALS, or 3."""
    if initial == 0:
        return SYSTEM if state == NOTHING else None
    if initial == 1:
        return USER if state != USER else None
    return ASSISTANT if initial == 2 and state == USER else None


def _times(a, b):
    return tuple(tuple(min(x + b[k][j] for k, x in enumerate(row)) for j in range(4)) for row in a)


def _ahead(matrix, costs):
    """Costs before the rows of ``matrix``, given those after them."""
    a, b, c, d = costs
    return tuple([min(w + a, x + b, y + c, z + d) for w, x, y, z in matrix])


def _insertions():
    out = []
    for state in range(4):
        row, at, paid = [_FAR] * 4, state, 0
        while paid < row[at]:
            row[at] = paid
            at, paid = _AFTER[at], paid + INSERT
        out.append(tuple(row))
    return tuple(out)


FREE = _insertions()
END = _ahead(FREE, (0, _FAR, _FAR, 0))


@lru_cache(maxsize=None)  # 12 symbols x 64 powers at most
def power(symbol: int, k: int):
    """The matrix of 2 ** k rows of one symbol."""
    if k:
        half = power(symbol, k - 1)
        return _times(half, half)
    initial, fault = divmod(symbol, 3)
    row = [[_FAR] * 4 for _ in range(4)]
    for state in range(4):
        row[state][state] = DELETE
        if fault != LOST:
            extra = TRUNCATED if fault == CUT else 0
            row[state][_AFTER[state]] = min(row[state][_AFTER[state]], REROLE + extra)
            to = _kept(initial, state)
            if to is not None:
                row[state][to] = min(row[state][to], KEEP + extra)
    return _times(FREE, row)


def _before(symbol: int, n: int, costs):
    """Costs before a run of n rows, by the binary powers of its symbol."""
    k = 0
    while n:
        if n & 1:
            costs = _ahead(power(symbol, k), costs)
        n, k = n >> 1, k + 1
    return costs


def _unroll(symbol: int, n: int, after, state: int, out: list[str]) -> int:
    """Appends the edits of a run to ``out``; returns the state behind it."""
    if n > 64:  # halves, so that costs are held for few rows at a time
        half = n >> 1
        state = _unroll(symbol, half, _before(symbol, n - half, after), state, out)
        return _unroll(symbol, n - half, after, state, out)
    costs = [after]
    for _ in range(n):
        costs.append(_ahead(power(symbol, 0), costs[-1]))
    initial, fault = divmod(symbol, 3)
    extra = TRUNCATED if fault == CUT else 0
    for left in range(n, 0, -1):
        here, then = costs[left], costs[left - 1]
        while True:
            least = here[state]
            if DELETE + then[state] == least:
                out.append("D")
                break
            if INSERT + here[_AFTER[state]] == least:
                out.append("I")
                state = _AFTER[state]
                continue
            to = _kept(initial, state)
            if to is not None and KEEP + extra + then[to] == least:
                out.append("K")
                state = to
                break
            out.append("R")
            state = _AFTER[state]
            break
    return state


def solve(runs: list[tuple[int, int]]) -> tuple[int, str]:
    """(cost, audit) of a conversation given as (symbol, rows) runs."""
    costs = [END]
    for symbol, n in reversed(runs):
        costs.append(_before(symbol, n, costs[-1]))
    state, out = NOTHING, []
    for number, (symbol, n) in enumerate(runs):
        state = _unroll(symbol, n, costs[-2 - number], state, out)
    while state not in (NOTHING, ASSISTANT):
        out.append("I")
        state = _AFTER[state]
    return costs[-1][NOTHING], "".join(out)


@lru_cache(maxsize=10_000)
def _solved(runs: tuple[tuple[int, int], ...]) -> tuple[int, str]:
    return solve(list(runs))


class Replay:
    """Carries out an audit, row by row; ``row`` and ``finish`` give the turns of the repaired conversation."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, NOTHING

    def _inserted(self) -> Iterator[tuple[str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at, self.state = self.at + 1, _AFTER[self.state]
            yield _ROLE[self.state], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self._inserted()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "K":
            self.state = _kept(INITIALS.find(role[:1]), self.state)
            yield role, text
        elif edit == "R":
            self.state = _AFTER[self.state]
            yield _ROLE[self.state], text

    def finish(self) -> Iterator[tuple[str, str]]:
        yield from self._inserted()
        if self.at != len(self.audit):
            raise ValueError("an audit is longer than its conversation")


# --- on Spark -------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows dropped (no copy), emptied, cut, repeated or given to the user."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce(F.col("role"), F.lit(" ")), F.coalesce(F.col("text"), F.lit(" "))
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def _digest():
    return F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256))


def _symbols(rows: DataFrame) -> DataFrame:
    """Rows without their texts: (conv_id, turn, at, copies, initial, blank, cut, again)."""
    end = F.rtrim(F.col("text"), F.lit(SPACES))
    narrow = rows.select(
        "conv_id", "turn", "copies", _digest().alias("digest"), F.substring("role", 1, 1).alias("initial"),
        (F.length(end) == 0).alias("blank"), (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("cut"),
    )
    one = narrow.groupBy("conv_id", "turn", "digest").agg(
        F.sum("copies").alias("copies"), *[F.any_value(c).alias(c) for c in ("initial", "blank", "cut")]
    )
    order = ["conv_id", "turn", "digest"]
    ordered = one.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    ordered = written(ordered, "repair-rows")
    said = ordered.filter("copies > 0 AND NOT blank").groupBy("conv_id", "digest")
    said = said.agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    said = said.select(F.col("conv_id").alias("c"), F.col("digest").alias("d"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d"))
    again = F.coalesce(F.col("at") != F.col("first"), F.lit(False)).alias("again")
    return ordered.join(said, same, "left").select("conv_id", "turn", "at", "copies", "initial", "blank", "cut", again)


_SEGMENTS = (
    "conv_id long, at long, low long, high long, turns long, blank long, duplicate long, truncated long, illegal long, "
    "head string, tail string, symbols array<int>, counts array<bigint>"
)
_LEGAL = {"su", "ua", "au"}


class _Segment:
    """Consecutive rows of one conversation, collapsed."""

    def __init__(self, conv_id, at):
        self.conv_id, self.at = conv_id, at
        self.low = self.high = self.head = self.tail = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.symbols, self.counts = [], []

    def add(self, row: dict) -> None:
        copies, initial = row["copies"], row["initial"]
        if not copies:
            return
        if row["turn"] is not None:
            self.low = row["turn"] if self.low is None else self.low
            self.turns += row["turn"] != self.high
            self.high = row["turn"]
        if self.head is None:
            self.head = initial
        elif self.tail + initial not in _LEGAL:
            self.illegal += 1
        self.illegal += copies - 1  # a row followed by itself is never legal
        self.tail = initial
        fresh = 0 if row["blank"] or row["again"] else 1
        if row["blank"]:
            self.blank += copies
        else:
            self.duplicate += copies - fresh
            self.truncated += fresh and row["cut"]
        kind = INITIALS.find(initial) if initial in INITIALS and initial else 3
        if fresh:
            self._run(3 * kind + (CUT if row["cut"] else FINE), 1)
        self._run(3 * kind + LOST, copies - fresh)

    def _run(self, symbol: int, n: int) -> None:
        if n and self.symbols and self.symbols[-1] == symbol:
            self.counts[-1] += n
        elif n:
            self.symbols.append(symbol)
            self.counts.append(n)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for begin in range(0, batch.num_rows, 1024):
            yield from batch.slice(begin, 1024).to_pylist()


def _collected(rows: Iterator[dict], schema: pa.Schema, size: int = 2048) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def _segments(symbols: DataFrame) -> DataFrame:
    def collapse(rows: Iterator[dict]) -> Iterator[dict]:
        now, key = None, None
        for row in rows:
            if key != (row["at"] >> SEGMENT, row["conv_id"]):
                if now:
                    yield vars(now)
                now, key = _Segment(row["conv_id"], row["at"]), (row["at"] >> SEGMENT, row["conv_id"])
            now.add(row)
        if now:
            yield vars(now)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        yield from _collected(collapse(_rows(batches)), schema)

    schema = _arrow(_SEGMENTS)
    dealt = symbols.repartition(F.shiftright("at", SEGMENT)).sortWithinPartitions("at")
    return map_arrow(dealt, run, _SEGMENTS)


AUDITS = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
)


def _audit(segments: list[dict]) -> dict:
    total = {"conv_id": segments[0]["conv_id"], "gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
    low = high = tail = None
    turns, runs = 0, []
    for s in segments:
        for name in ("blank", "duplicate", "truncated", "illegal"):
            total[name] += s[name]
        if s["low"] is not None:
            turns += s["turns"] - (s["low"] == high)
            low, high = s["low"] if low is None else low, s["high"]
        if s["head"] is not None:
            total["illegal"] += tail is not None and tail + s["head"] not in _LEGAL
            tail = s["tail"]
        for symbol, n in zip(s["symbols"], s["counts"], strict=True):
            if runs and runs[-1][0] == symbol:
                runs[-1] = (symbol, runs[-1][1] + n)
            else:
                runs.append((symbol, n))
    if low is not None:
        total["gaps"] = (high - low + 1 - turns + (1 << 63)) % (1 << 64) - (1 << 63)
    total["cost"], total["audit"] = _solved(tuple(runs)) if len(runs) <= 64 else solve(runs)
    return total


def audits(rows: DataFrame) -> DataFrame:
    """One row per conversation: its gaps, faults, illegal neighbours, least cost and least audit.

    ``rows`` has conv_id, turn, role, text (no nulls in these two) and copies; a row of no
    copies only names its conversation.  A gap count beyond 64 bits wraps around.
    """

    def gather(found: Iterator[dict]) -> Iterator[dict]:
        held: list[dict] = []
        for s in found:
            if held and held[0]["conv_id"] != s["conv_id"]:
                yield _audit(held)
                held = []
            held.append(s)
        if held:
            yield _audit(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        yield from _collected(gather(_rows(batches)), schema)

    schema = _arrow(AUDITS)
    segments = _segments(_symbols(rows))
    return map_arrow(segments.repartition("conv_id").sortWithinPartitions("conv_id", "at"), run, AUDITS)


def _replayed(rows: DataFrame, found: DataFrame, schema: str, values) -> DataFrame:
    """``values(audit row, turns)`` rows of each conversation; its turns are streamed, not held."""
    names = [f.name for f in StructType.fromDDL(AUDITS).fields]
    heads = found.select("conv_id", F.struct(*names).alias("head"), *[F.lit(None).cast(t).alias(c) for c, t in _TURN])
    texts = rows.filter("copies > 0").select(
        "conv_id", F.lit(None).cast(heads.schema["head"].dataType).alias("head"), "turn", _digest().alias("digest"), "role", "text",
        F.col("copies").cast("long").alias("copies"),
    )
    merged = heads.unionByName(texts).repartition("conv_id")
    merged = merged.sortWithinPartitions("conv_id", F.col("head").isNull(), "turn", "digest")

    def conversations(found: Iterator[dict]) -> Iterator[dict]:
        row = next(found, None)
        while row is not None:
            head, after = row["head"], []

            def turns(head=head, after=after) -> Iterator[tuple[str, str]]:
                replay = Replay(head["audit"])
                for one in found:
                    if one["head"] is not None:
                        after.append(one)
                        break
                    for _ in range(one["copies"]):
                        yield from replay.row(one["role"], one["text"])
                yield from replay.finish()

            yield from values(head, turns())
            row = after[0] if after else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        yield from _collected(conversations(_rows(batches)), kinds, 512)

    kinds = _arrow(schema)
    return map_arrow(merged, run, schema)


_TURN = [("turn", "long"), ("digest", "binary"), ("role", "string"), ("text", "string"), ("copies", "long")]


def repaired(rows: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """(conv_id, place, role, text): the turns of every repaired conversation."""

    def values(head: dict, turns: Iterator[tuple[str, str]]) -> Iterator[dict]:
        for place, (role, text) in enumerate(turns):
            yield {"conv_id": head["conv_id"], "place": place, "role": role, "text": text}

    found = written(audits(rows), "repair-audits") if found is None else found
    return _replayed(rows, found, "conv_id long, place long, role string, text string", values)


def repair_digests(rows: DataFrame) -> DataFrame:
    """``audits`` with repaired_sha256, the SHA-256 of the repaired ``role:text`` lines."""

    def values(head: dict, turns: Iterator[tuple[str, str]]) -> Iterator[dict]:
        digest = hashlib.sha256()
        for place, (role, text) in enumerate(turns):
            digest.update(f"{chr(10) if place else ''}{role}:{text}".encode())
        yield head | {"repaired_sha256": digest.hexdigest()}

    return _replayed(rows, written(audits(rows), "repair-audits"), f"{AUDITS}, repaired_sha256 string", values)
