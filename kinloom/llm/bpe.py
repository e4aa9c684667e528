"""BPE encoding as a bounded-lookahead streaming transducer, decoding as a state machine.

Encoding.  A text is cut into pieces (letters, one digit, other signs), a piece is a
chain of byte symbols of which the last carries the end-of-word mark, and merges apply
by rank.  A token boundary j of a prefix can only vanish through a merge across j whose
right part was, in the prefix, broken by a merge of a lower rank across the right part's
end, and so on with falling ranks.  ``lookahead`` adds up the longest such chain of
right parts over the whole merge list: a boundary followed by that many symbols is
final, and what follows a final boundary is encoded as if it stood alone.  So the
encoder holds one window of twice the lookahead, emits the tokens that are stable and
goes on with the rest: constant memory for a piece of any length.

Decoding.  ``Decoder`` is fed ids one by one.  Raw mode writes what the tokenizer file
asks for without a decoder, the token strings with spaces between them; text mode turns
bytes into text with an incremental UTF-8 machine and word ends into spaces.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import holds, map_batches

END = "</w>"
REMEMBERED, LONGEST_REMEMBERED = 200_000, 64  # words a worker remembers, and their length
_NONE = 1 << 62
# Str.split takes these four for white space, the tokenizer does not.
_SEPARATORS = "\x1c\x1d\x1e\x1f"
_SPACE = regex.compile(r"\s+")
# Fixed value: the splitting pattern of the tokenizer file.
_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def byte_alphabet() -> list[str]:
    """The printable character of each byte: itself, or for the others 256, 257, ... in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    table, spare = [], 256
    for byte in range(256):
        table.append(chr(byte if byte in shown else spare))
        spare += byte not in shown
    return table


def lookahead(merges: list[tuple[str, str]]) -> int:
    """Symbols behind a boundary that make it final, for any text."""

    def symbols(token: str) -> int:
        return len(token.removesuffix(END)) or 1

    parts: dict[str, tuple[str, str]] = {}
    reach: dict[str, int] = {}  # by left part: the longest chain that starts with it, of ranks seen so far
    longest = 1
    for left, right in merges:
        tail, most = right, 0
        while tail:
            most = max(most, reach.get(tail, 0))
            tail = parts[tail][1] if tail in parts else ""
        here = symbols(right) + most
        reach[left] = max(here, reach.get(left, 0))
        longest = max(longest, here)
        parts[left + right] = (left, right)
    return longest


class Encoder:
    """Texts to ids for one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        # Rank and new id in one number: the smallest code is the next merge.
        self.merges = {(vocab[a], vocab[b]): rank << 32 | vocab[a + b] for rank, (a, b) in enumerate(merges)}
        alphabet = byte_alphabet()
        self.inner = [vocab[c] for c in alphabet]
        self.final = [vocab[c + END] for c in alphabet]
        self.lookahead = lookahead(merges)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("|".join(map(regex.escape, names))) if names else None
        tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.tokens = [tokens.get(i, "") for i in range(max(tokens) + 1)]
        self.size = [len(t.removesuffix(END)) or 1 for t in self.tokens]
        self.decimal = [str(i) for i in range(len(self.tokens))]
        self.library = Tokenizer.from_file(path)
        self.pieces = _Memory(self._piece_ids)
        self.words = _Memory(self._word_ids)

    def _merged(self, ids: list[int]) -> list[int]:
        """Merges by rank, leftmost first, until none applies."""
        code, ids = self.merges.get, list(ids)
        codes = [code(pair, _NONE) for pair in zip(ids, ids[1:], strict=False)]
        while codes and (least := min(codes)) != _NONE:
            i = codes.index(least)
            ids[i : i + 2] = [least & 0xFFFFFFFF]
            del codes[i]
            if i < len(codes):
                codes[i] = code((ids[i], ids[i + 1]), _NONE)
            if i:
                codes[i - 1] = code((ids[i - 1], ids[i]), _NONE)
        return ids

    def stream(self, piece: Iterator[int]) -> Iterator[int]:
        """Tokens of one piece, given byte by byte and emitted once stable."""
        window: list[int] = []
        waiting = next(piece, None)
        for byte in piece:
            window.append(self.inner[waiting])
            waiting = byte
            if len(window) >= 2 * self.lookahead:
                window = yield from self._stable(window)
        if waiting is not None:
            yield from self._merged([*window, self.final[waiting]])

    def _stable(self, window: list[int]) -> Iterator[int]:
        at, safe = 0, len(window) - self.lookahead
        for token in self._merged(window):
            end = at + self.size[token]
            if end > safe:
                break
            yield token
            at = end
        return window[at:]

    def _word_ids(self, word: str) -> tuple[int, ...]:
        """Ids of a normalised text without white space."""
        pieces = _PIECE.findall(word) if _assigned(word) else self._library_pieces(word)
        return tuple(chain.from_iterable(map(self.pieces.__getitem__, pieces)))

    def _piece_ids(self, piece: str) -> tuple[int, ...]:
        symbols = piece.encode("utf-8", "surrogatepass")
        if len(symbols) < 2 * self.lookahead:  # one window holds it
            return tuple(self._merged([*map(self.inner.__getitem__, symbols[:-1]), self.final[symbols[-1]]]))
        return tuple(self.stream(iter(symbols)))

    def _library_pieces(self, word: str) -> list[str]:
        """Characters newer than our Unicode tables: the tokenizer's own normaliser and splitter decide."""
        plain = self.library.normalizer.normalize_str(word)
        back = {c: b for b, c in enumerate(byte_alphabet())}
        split = self.library.pre_tokenizer.pre_tokenize_str(plain)
        return [bytes(back[c] for c in piece).decode("utf-8") for piece, _ in split]

    def ids(self, text: str | None) -> list[int]:
        """All ids of a whole text; null is empty.  Special tokens in the text are ids of their own."""
        if not text:
            return []
        out: list[int] = []
        at = 0
        for cut in self.cut.finditer(text) if self.cut else ():
            out += self._plain_ids(text[at : cut.start()])
            out.append(self.special[cut[0]])
            at = cut.end()
        return out + self._plain_ids(text[at:]) if at else self._plain_ids(text)

    def _plain_ids(self, text: str) -> list[int]:
        # No piece spans white space and white space has no ids, so words are looked up whole.
        # Letters are lower-cased one by one: a final sigma is no special case.
        plain = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        if any(c in plain for c in _SEPARATORS):
            plain = _SPACE.sub(" ", plain)
            return list(chain.from_iterable(map(self.words.__getitem__, plain.split(" "))))
        return list(chain.from_iterable(map(self.words.__getitem__, plain.split())))


class _Memory(dict):
    """Words met before; forgets everything when full, so a worker's memory is bounded."""

    def __init__(self, compute):
        super().__init__()
        self.compute = compute

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = self.compute(word)
        if len(word) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = ids
        return ids


def _assigned(word: str) -> bool:
    return word.isascii() or all(map(_assigned_character, word))


@lru_cache(maxsize=100_000)
def _assigned_character(character: str) -> bool:
    return unicodedata.category(character) != "Cn"


class Decoder:
    """Ids to text in any number of steps; ``feed`` returns the text that its ids complete."""

    def __init__(self, encoder: Encoder, raw: bool = True):
        self.raw = raw
        self.tokens = encoder.tokens
        self.special = set(encoder.special.values())
        self.byte = {c: b for b, c in enumerate(byte_alphabet())}
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")
        self.started = False

    def feed(self, ids: list[int]) -> str:
        if not ids:
            return ""
        if self.raw:
            lead, self.started = " " if self.started else "", True
            return lead + " ".join(map(self.tokens.__getitem__, ids))
        return "".join(map(self._text, ids))

    def _text(self, token: int) -> str:
        text = self.tokens[token]
        if token in self.special:
            return self.machine.decode(b"", True) + text
        ends = text.endswith(END)
        done = self.machine.decode(bytes(map(self.byte.__getitem__, text.removesuffix(END))), ends)
        return f"{done} " if ends else done

    def finish(self) -> str:
        return "" if self.raw else self.machine.decode(b"", True)


def decode(coder: Encoder, ids: list[int], raw: bool = True) -> str:
    machine = Decoder(coder, raw)
    return machine.feed(ids) + machine.finish()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file, with the pieces it remembers."""
    return Encoder(path)


holds(encoder.cache_clear)


def default_path() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def tokens(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded) per row of ``docs``; a null text has no ids and decodes to nothing."""
    path = path or default_path()

    def make():
        coder = encoder(path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = [coder.ids(text) for text in batch.column("text").to_pylist()]
            decoded = [decode(coder, row) for row in ids]
            arrays = [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
            return pa.RecordBatch.from_arrays(arrays, ["doc_id", "ids", "decoded"])

        return step

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), make, "doc_id long, ids array<int>, decoded string", holding=True)


def _sha(parts) -> str:
    return hashlib.sha256(" ".join(parts).encode()).hexdigest()


def token_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) per row, without sending ids or texts back."""
    path = path or default_path()

    def make():
        coder = encoder(path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts, hashes, decoded = [], [], []
            for text in batch.column("text").to_pylist():
                ids = coder.ids(text)
                counts.append(len(ids))
                hashes.append(_sha(map(coder.decimal.__getitem__, ids)))
                decoded.append(hashlib.sha256(decode(coder, ids).encode()).hexdigest())
            arrays = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(hashes), pa.array(decoded)]
            return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

        return step

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), make, schema, holding=True)
