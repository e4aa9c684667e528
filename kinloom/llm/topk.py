"""Exact top-k inner products by MaxScore over sharded postings.

A vector is a sparse document: its components, scaled to integers, are postings of two
terms per dimension, one for positive and one for negative values.  A term's bound for a
query is its largest contribution in the shard, or zero where the signs differ.

Rows are dealt to shards by hash of their id and vector and every shard meets every block of the
stated queries.  Per query a shard is scored in blocks of rows.  Terms are ordered by
bound; those whose bounds together cannot lift a row over the k-th score so far are
non-essential.  The essential postings are traversed, then the others are probed from
the largest bound down, only for rows still competitive; the last may be left out.  The
best k of each shard are merged by rank.  Scores are exact integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import with_package

SCALE = 1024
SHARD_ROWS = 4096  # rows of a shard
QUERY_ROWS = 128  # queries of a block
BLOCK_ROWS = 1024  # rows scored before the k-th score is looked at again


class Shard:
    """Integer vectors with per-dimension columns and the bounds of their postings."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        self.columns = np.ascontiguousarray(vectors[order].T)
        self.most = self.columns.max(axis=1, initial=0)  # the positive term's largest value
        self.least = self.columns.min(axis=1, initial=0)  # the negative term's

    def top(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(ids, scores) of the k best other rows, and how many postings were read."""
        size = min(len(query), len(self.columns))
        query = query[:size]
        bounds = np.maximum(query * self.most[:size], query * self.least[:size])
        order = np.argsort(-bounds, kind="stable")
        order = order[query[order] != 0]
        # What the terms from the i-th on can still add.
        rest = np.append(np.cumsum(bounds[order][::-1])[::-1], 0)
        ids, scores, read = np.empty(0, np.int64), np.empty(0, np.int64), 0
        for start in range(0, len(self.ids), BLOCK_ROWS):
            block = slice(start, start + BLOCK_ROWS)
            rows = np.flatnonzero(self.ids[block] != query_id) + start
            least = scores[-1] if len(scores) == k else None
            # Essential terms: with the others alone a row stays below the k-th score.  Rows come by
            # rising id, so a row that only equals it loses the tie.
            essential = len(order) if least is None else int(np.count_nonzero(rest[:-1] > least))
            partial = np.zeros(len(rows), np.int64)
            for i, term in enumerate(order):
                if least is not None and (i >= essential or i % 8 == 0):
                    alive = partial + rest[i] > least
                    if not alive.all():
                        rows, partial = rows[alive], partial[alive]
                    if not len(rows):
                        break
                partial += query[term] * self.columns[term, rows]
                read += len(rows)
            if least is not None:
                alive = partial > least
                rows, partial = rows[alive], partial[alive]
            ids, scores = np.append(ids, self.ids[rows]), np.append(scores, partial)
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
        return ids, scores, read


def integer_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): floor(scale * x) per component, of rows that can take part.

    Rows without id, null vectors and vectors with null or non-finite components take no
    part.  Every distinct vector of a vec_id is a row; rows that repeat both count once.
    Scores must fit a long.
    """
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * scale).cast("long"))
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(finite)
    single = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").distinct()
    return single.select("vec_id", x.alias("v"))


def _packed(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.collect_list(F.struct("vec_id", "v")).alias("rows"))


def _matrix(rows) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors, short vectors filled up with zeros."""
    ids = np.array([r["vec_id"] for r in rows], np.int64)
    out = np.zeros((len(rows), max((len(r["v"]) for r in rows), default=0)), np.int64)
    for line, r in zip(out, rows, strict=True):
        line[: len(r["v"])] = r["v"]
    return ids, out


def top_k(vectors: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of each query, ties to smaller ids.

    Queries are the rows whose vec_id is divisible by ``every``; other rows are those of
    another vec_id.  A vec_id with several vectors can be found with each of them, and as a
    query takes the best of all their pairs.  Vectors of unequal length meet in the
    components both have.
    """
    rows = integer_vectors(vectors)
    asks = F.col("vec_id") % every == 0
    total, asking = rows.select(F.count(F.lit(1)), F.count_if(asks)).first()
    if total == 0:
        return rows.select(
            F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score")
        )
    shards = -(-total // SHARD_ROWS)
    blocks = max(1, -(-asking // QUERY_ROWS))
    shard = F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards))
    sharded = _packed(rows.withColumn("shard", shard).repartition(shards, "shard"), "shard")
    queries = rows.filter(asks)
    asked = _packed(queries.withColumn("block", F.pmod(F.xxhash64("vec_id", "v", F.lit(1)), F.lit(blocks))), "block")
    # Every block of queries goes to every shard; the join is on the shard, a task each.
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<long>")))
    asked = asked.withColumnRenamed("rows", "queries").repartition(shards, "shard")
    met = sharded.join(asked.hint("shuffle_merge"), "shard")

    def best(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, shard = None, None
        for frame in frames:
            for number, held, queries in zip(frame["shard"], frame["rows"], frame["queries"], strict=True):
                if number != at:
                    at, shard = number, Shard(*_matrix(held))
                found = []
                for query_id, query in zip(*_matrix(queries), strict=True):
                    ids, scores, _ = shard.top(int(query_id), query, k)
                    found.append(pd.DataFrame({"query_id": query_id, "vec_id": ids, "score": scores}))
                yield pd.concat(found)

    found = with_package(met).mapInPandas(best, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
