"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

* Features: hashed character 1- to 3-grams of the lower-cased text, every run of other
  characters than letters being one space.  TF is 1 + log(count), rows have length 1.
* Document frequencies are counted over all training documents: tasks add up bucket
  counts, Spark merges them per bucket, and the table of ``BUCKETS`` numbers is small
  whatever the corpus.
* Weights: follow the regularised leader (proximal) with L1 and L2 penalties, per
  coordinate, on a training sample of at most ``TRAIN_DOCS`` documents, taken in equal
  shares per language by hash of the id.  The sample bounds fitting only.
* Temperature: one number fitted by Newton steps to the log-loss of ``CALIBRATION_DOCS``
  sampled training documents that the weights have not seen.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.groups import top_per_group
from .common import crc_mod, map_arrow, map_batches

BUCKETS = 1 << 15
TRAIN_DOCS = 6000
CALIBRATION_DOCS = 1500
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)  # fixed values: odd multipliers
_SHIFT = np.uint32(32 - BUCKETS.bit_length() + 1)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Per code point: 2 for letters, 1 for marks, 0 for everything else."""
    kinds = {"L": 2, "M": 1}
    return np.array([kinds.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)], np.uint8)


def ngram_buckets(text: str | None) -> np.ndarray:
    """The bucket of every 1-, 2- and 3-gram of the whole text, in no order; none without a letter."""
    points = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = _classes()[points]
    if not (kinds == 2).any():
        return np.empty(0, np.uint32)
    inside = kinds > 0
    kept = inside.copy()
    kept[1:] |= inside[:-1]  # a letter's run and the one space behind it
    kept[0] = True
    points = np.where(inside, points, np.uint32(32))[kept]
    a, b, c = (points * factor for factor in _FACTORS)
    one = points * np.uint32(0x27D4EB2F)  # fixed value: another odd multiplier
    two = (a[:-1] ^ (b[1:] >> np.uint32(7))) * _FACTORS[1]
    three = ((a[:-2] ^ (b[1:-1] >> np.uint32(7))) * _FACTORS[2] ^ (c[2:] >> np.uint32(11))) * _FACTORS[0]
    return np.concatenate((one, two, three)) >> _SHIFT


def features(text: str | None, idf: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, weights): TF, or with ``idf`` the TF-IDF row of length 1."""
    counts = np.bincount(ngram_buckets(text), minlength=BUCKETS)
    at = np.flatnonzero(counts)
    weights = 1 + np.log(counts[at])
    if idf is not None and len(at):
        weights *= idf[at]
        weights /= np.sqrt(weights @ weights)
    return at, weights


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray  # per bucket
    weights: np.ndarray  # bucket x language
    temperature: float = 1.0

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, probability); ``und`` and 0 for a text without letters."""
        at, x = features(text, self.idf)
        if not len(at) or not self.languages:
            return "und", 0.0
        p = _softmax(x @ self.weights[at] / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(
    rows: list[tuple[np.ndarray, np.ndarray]],
    labels: list[int],
    n_classes: int,
    alpha: float = 0.5,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.5,
    epochs: int = 2,
) -> np.ndarray:
    """Weights by FTRL-proximal (McMahan et al., 2013) with the multinomial log-loss.

    A weight is zero while its summed gradient stays within ``l1``, so the model is sparse.
    """
    z, n = np.zeros((BUCKETS, n_classes)), np.zeros((BUCKETS, n_classes))

    def solved(zs: np.ndarray, ns: np.ndarray) -> np.ndarray:
        pulled = np.sign(zs) * l1 - zs
        return np.where(np.abs(zs) <= l1, 0.0, pulled / ((beta + np.sqrt(ns)) / alpha + l2))

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, x = rows[i]
            w = solved(z[at], n[at])
            p = _softmax(x @ w)
            p[labels[i]] -= 1.0
            g = x[:, None] * p
            squares = g * g
            sigma = (np.sqrt(n[at] + squares) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += squares
    return solved(z, n)


def fit_temperature(logits: np.ndarray, labels: np.ndarray, least: float = 0.05, most: float = 20.0) -> float:
    """The temperature of the smallest log-loss, by Newton steps on its inverse (a convex problem)."""
    if not len(labels):
        return 1.0
    s, picked = 1.0, logits[np.arange(len(labels)), labels]
    for _ in range(50):
        p = _softmax(s * logits)
        mean = (p * logits).sum(axis=1)
        slope = (mean - picked).mean()
        bend = ((p * logits**2).sum(axis=1) - mean**2).mean()
        step = slope / max(bend, 1e-9)
        s = float(np.clip(s - np.clip(step, -s / 2, s), 1 / most, 1 / least))
        if abs(step) < 1e-6:
            break
    return 1.0 / s


def _frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """Number of documents and, per bucket, of documents that have it; all rows count."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                buckets = ngram_buckets(text)
                if len(buckets):
                    df += np.bincount(buckets, minlength=BUCKETS) > 0
                    docs += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(df[at], docs), pa.int64())], ["bucket", "n"]
        )

    counted = map_arrow(texts.select("text"), count, "bucket int, n long")
    rows = counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # a row per bucket at most
    counts = {row.bucket: row.n for row in rows}
    df = np.zeros(BUCKETS)
    for bucket, n in counts.items():
        if bucket >= 0:
            df[bucket] = n
    return counts.get(-1, 0), df


def train(labelled: DataFrame, train_docs: int = TRAIN_DOCS, calibration_docs: int = CALIBRATION_DOCS) -> Model:
    """A model from (doc_id, text, lang) rows; rows without language or letters teach nothing.

    The sample is chosen on ids alone; the texts of the chosen rows (at most
    ``train_docs`` + ``calibration_docs``, and one per language) come to the driver.
    """
    labelled = labelled.filter("lang IS NOT NULL").select(F.col("doc_id").cast("string").alias("doc_id"), "text", "lang")
    n_docs, df = _frequencies(labelled)
    idf = np.log((1 + n_docs) / (1 + df)) + 1
    languages = [r.lang for r in labelled.select("lang").distinct().orderBy("lang").collect()]
    if not languages:
        return Model([], idf, np.zeros((BUCKETS, 0)))
    share = -(-(train_docs + calibration_docs) // len(languages))
    unseen_from = share * train_docs / (train_docs + calibration_docs)
    chosen = top_per_group(
        labelled.select("doc_id", "lang").distinct(), ["lang"], [F.xxhash64("doc_id"), F.col("doc_id")], share
    )
    ranked = chosen.select("doc_id", "lang", (F.xxhash64("doc_id", F.lit("fold")) % share).alias("fold"))
    sample = labelled.join(F.broadcast(ranked), ["doc_id", "lang"])  # at most the sample's ids
    at = {name: i for i, name in enumerate(languages)}
    rows, labels, held, held_labels = [], [], [], []
    for lang, text, fold in sample.select("lang", "text", "fold").orderBy("doc_id", "text").toLocalIterator():
        row = features(text, idf)
        if not len(row[0]):
            continue
        unseen = abs(fold) >= unseen_from
        (held if unseen else rows).append(row)
        (held_labels if unseen else labels).append(at[lang])
    weights = ftrl(rows, labels, len(languages))
    logits = np.array([x @ weights[b] for b, x in held]).reshape(len(held), len(languages))
    return Model(languages, idf, weights, fit_temperature(logits, np.array(held_labels, int)))


def fit(docs: DataFrame, **sizes: int) -> Model:
    """The model learnt from documents whose crc32(doc_id) is not 1 modulo 3."""
    return train(docs.filter(crc_mod(F.col("doc_id"), 3) != 1), **sizes)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) per row of ``docs``, from the whole text alone.

    A text that is null or has no letter is ``und`` with score 0, and so is any text if
    no language was learnt.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        predict = sent.value.predict

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [predict(text) for text in batch.column("text").to_pylist()]
            arrays = [
                batch.column("doc_id"),
                pa.array([lang for lang, _ in found], pa.string()),
                pa.array([score for _, score in found], pa.float64()),
            ]
            return pa.RecordBatch.from_arrays(arrays, ["doc_id", "lang_pred", "score"])

        return step

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return map_batches(rows, make, "doc_id long, lang_pred string, score double")


def accepted(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows whose language is known: a letter, and a calibrated probability of ``least`` or more."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        predict, learnt = sent.value.predict, bool(sent.value.languages)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            if learnt:
                keep = [score >= least for _, score in map(predict, texts)]
            else:
                keep = [len(ngram_buckets(text)) > 0 for text in texts]
            return batch.filter(pa.array(keep, pa.bool_()))

        return step

    return map_batches(docs, make, docs.schema)
