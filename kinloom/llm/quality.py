"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

* Terms say how a text is written, in any language: hashed 1- to 4-grams of its shape
  (letter case, digits, spaces and signs, runs of small letters collapsed), and words
  that repeat the word before.  Weights are sqrt(share of the text) x IDF.
* Document frequencies are counted over all documents, one number per bucket.
* The latent space is a truncated SVD of at most ``LABELLED`` labelled rows, taken by
  hash of the id; the same rows are the neighbours.  Their vectors, bounded by
  ``LABELLED`` x ``DIMENSIONS`` numbers whatever the corpus, are broadcast.
* Every document meets every labelled vector in exact blocked products; its ``NEAREST``
  vote with the cosine, sharpened, as weight.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, map_arrow, map_batches

BUCKETS = 2048
LABELLED, DIMENSIONS, NEAREST = 8192, 48, 24
SHARPNESS = 8
BLOCK = 256  # documents per product
_LOWER, _UPPER, _DIGIT, _SPACE, _BREAK, _SIGN = 1, 2, 3, 4, 5, 6
_MIXERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)  # fixed values: odd multipliers


def _shapes() -> np.ndarray:
    table = np.full(256, _SIGN, np.uint32)
    table[33:48] = np.arange(33, 48)  # ASCII signs stand for themselves
    for first, last in ((58, 65), (91, 97), (123, 127)):
        table[first:last] = np.arange(first, last)
    table[48:58] = _DIGIT
    table[65:91] = _UPPER
    table[97:123] = _LOWER
    table[[9, 11, 12, 13, 32]] = _SPACE
    table[10] = _BREAK
    table[128:] = _LOWER  # bytes of other letters
    return table


_SHAPE = _shapes()


def terms(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, weights before IDF) of a whole text; empty without text."""
    if not text:
        return np.empty(0, np.int64), np.empty(0)
    shape = _SHAPE[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]
    new = np.append(True, (shape[1:] != _LOWER) | (shape[:-1] != _LOWER))
    shape = shape[new]
    grams, keys = [], np.zeros(len(shape), np.uint32)
    for n in range(min(4, len(shape))):
        last = len(shape) - n
        keys = (keys[:last] ^ shape[n:]) * _MIXERS[n]
        keys ^= keys >> np.uint32(15)
        grams.append(keys)
    counts = np.bincount(np.concatenate(grams) % np.uint32(BUCKETS - 1), minlength=BUCKETS).astype(float)
    words = text.split()
    counts[BUCKETS - 1] = 8 * sum(map(operator.eq, words, words[1:]))
    at = np.flatnonzero(counts)
    return at, np.sqrt(counts[at] / counts.sum())


@dataclass
class Model:
    idf: np.ndarray
    axes: np.ndarray  # bucket x dimension
    vectors: np.ndarray  # labelled row x dimension, length 1
    labels: np.ndarray
    prior: float

    def project(self, texts: list[str | None]) -> np.ndarray:
        """Latent vectors of length 1; zero for a text without terms."""
        x = np.zeros((len(texts), BUCKETS), np.float32)
        for row, text in zip(x, texts, strict=True):
            at, weights = terms(text)
            row[at] = weights * self.idf[at]
        return _unit(x @ self.axes)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Share of label 1 among the nearest labelled rows, weighted by similarity."""
        out = np.full(len(texts), self.prior)
        if not len(self.labels):
            return out
        k = min(NEAREST, len(self.labels))
        for at in range(0, len(texts), BLOCK):
            near = self.project(texts[at : at + BLOCK]) @ self.vectors.T
            best = np.argpartition(-near, k - 1, axis=1)[:, :k]
            weight = np.clip(np.take_along_axis(near, best, 1), 0, 1).astype(float) ** SHARPNESS
            total = weight.sum(axis=1)
            voted = (weight * self.labels[best]).sum(axis=1) / np.maximum(total, 1e-300)
            out[at : at + BLOCK] = np.where(total > 0, voted, self.prior)
        return np.clip(out, 0.0, 1.0)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _axes(x: np.ndarray, dimensions: int) -> np.ndarray:
    """Leading right singular vectors by subspace iteration from a fixed start."""
    dimensions = min(dimensions, *x.shape)
    basis = np.linalg.qr(np.random.default_rng(11).normal(size=(x.shape[1], min(dimensions + 16, x.shape[1]))))[0]
    for _ in range(6):
        basis = np.linalg.qr(x.T @ (x @ basis))[0]
    _, _, right = np.linalg.svd(x @ basis, full_matrices=False)
    return (basis @ right.T)[:, :dimensions].astype(np.float32)


def _frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Documents with text, and per bucket the documents that have it; all rows count."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                at, _ = terms(text)
                df[at] += 1
                n += len(at) > 0
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(df[at], n), pa.int64())], ["bucket", "n"]
        )

    counted = map_arrow(docs.select("text"), count, "bucket int, n long")
    rows = counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # a row per bucket at most
    counts = {row.bucket: row.n for row in rows}
    df = np.array([counts.get(i, 0) for i in range(BUCKETS)], float)
    return counts.get(-1, 0), df


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, dimensions: int = DIMENSIONS) -> Model:
    """A model from rows whose crc32(doc_id) is not 0 modulo 5.

    Rows of ``labels`` without quality or doc_id teach nothing; of a doc_id labelled
    more than once the larger label counts.  Without any label every score is 0.5.
    """
    n, df = _frequencies(docs)
    idf = np.log((1 + n) / (1 + df)) + 1
    known = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").filter(crc_mod(F.col("doc_id"), 5) != 0)
    chosen = (
        known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    found = rows.select("text", "quality").orderBy("doc_id", "text").toLocalIterator()
    x, votes = [], []
    for text, quality in found:
        at, weights = terms(text)
        row = np.zeros(BUCKETS, np.float32)
        row[at] = weights * idf[at]
        x.append(row)
        votes.append(float(quality > 0))
    if not x:
        return Model(idf, np.zeros((BUCKETS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0), 0.5)
    matrix = np.array(x)
    axes = _axes(matrix, dimensions)
    return Model(idf, axes, _unit(matrix @ axes), np.array(votes), float(np.mean(votes)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) per row of ``docs``, from the whole text alone.

    A null or empty text has no vector and gets the share of label 1 among all labelled rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scores = sent.value.scores

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = scores(batch.column("text").to_pylist())
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"])

        return step

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), make, "doc_id long, score double")
