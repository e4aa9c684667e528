"""A keyed table that takes small changes as deltas: merge on read, compaction, roll-back.

Base rows lie in buckets of their key (``buckets``).  A change writes only the rows it is
about, new values whole and deletions as bare keys, into a delta next to the buckets they
fall into, and a manifest that names it.  Reading a bucket puts its deltas over its base:
the newest delta of a key decides, and base rows of changed keys do not count.  Compaction
rewrites buckets that have gathered deltas, splitting those that grew; nothing else moves.
Every version stays readable; rolling back commits an old version's content as the newest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.groups import top_per_group
from ..session import cut_lineage
from . import manifest
from .buckets import MAX_ROWS, BucketStore, read_buckets, write_rows

_GONE, _SEQ = "_deleted", "_seq"


class LoggedTable(BucketStore):
    """One version of a table; ``change``, ``compact`` and ``roll_back`` commit the next one.

    All three raise ``manifest.Conflict`` when another job committed first.
    """

    def __init__(self, spark: SparkSession, folder: str, version: int):
        super().__init__(spark, folder, version)
        self.keys: list[str] = self.content["keys"]
        self.deltas: dict[str, list[list]] = self.content["deltas"]  # by bucket: [folder, sequence number]

    @classmethod
    def create(cls, rows: DataFrame, keys: Sequence[str], folder: str, max_rows: int = MAX_ROWS) -> LoggedTable:
        """Version 0 from rows with one row per key."""
        return cls.first(rows.sparkSession, folder, {"base": (rows, _hash(keys))}, max_rows, keys=list(keys), deltas={}, seq=0)

    def _delta_schema(self) -> T.StructType:
        return T.StructType([*self.schemas["base"].fields, T.StructField(_GONE, T.BooleanType())])

    def _newest(self, names: Sequence[str]) -> DataFrame | None:
        """The deciding delta row of each changed key of some buckets."""
        parts: dict[tuple[str, int], list[tuple[str, str]]] = {}
        for name in names:
            for path, seq in self.deltas.get(name, []):
                parts.setdefault((path, seq), []).append((path, name))
        out = None
        for (_, seq), found in sorted(parts.items(), key=lambda x: x[0][1]):
            rows = read_buckets(self.spark, self._delta_schema(), found).withColumn(_SEQ, F.lit(seq))
            out = rows if out is None else out.unionByName(rows)
        return None if out is None else top_per_group(out, self.keys, [F.desc(_SEQ)])

    def rows(self, names: Sequence[str] | None = None) -> DataFrame:
        """The table, or some of its buckets, with all changes in."""
        names = list(self.tables["base"].buckets if names is None else names)
        base, newest = self.read("base", names), self._newest(names)
        if newest is None:
            return base
        same = None
        changed = newest.select(*[F.col(k).alias(f"_k_{k}") for k in self.keys])
        for k in self.keys:
            equal = F.col(k).eqNullSafe(F.col(f"_k_{k}"))
            same = equal if same is None else same & equal
        kept = base.join(changed, same, "left_anti")
        return kept.unionByName(newest.filter(~F.col(_GONE)).drop(_GONE, _SEQ))

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows of some keys; only their buckets are read."""
        wanted = keys.select(*self.keys).distinct()
        names = self.tables["base"].names(wanted.select(_hash(self.keys).alias("h")), "h")
        return self.rows(names).join(wanted, self.keys, "left_semi")

    def change(self, upserts: DataFrame | None, deletes: DataFrame | None, batch_id: str) -> list[str]:
        """Commits whole new rows and deleted keys as one delta; returns the buckets it touches.

        A key that is both upserted and deleted is upserted; one key may be upserted once only.
        """
        parts = []
        if upserts is not None:
            parts.append(upserts.select(*self.schemas["base"].names).withColumn(_GONE, F.lit(False)))
        if deletes is not None:
            gone = deletes.select(*self.keys).distinct()
            if upserts is not None:
                gone = gone.join(upserts.select(*self.keys), self.keys, "left_anti")
            parts.append(gone.withColumn(_GONE, F.lit(True)))
        delta = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
        label = self.tables["base"].name_of(_hash(self.keys))
        for field in self.schemas["base"].fields:
            if field.name not in delta.columns:
                delta = delta.withColumn(field.name, F.lit(None).cast(field.dataType))
        # Folders by the rows of the delta: a small one falls into many buckets, with few rows in each.
        delta = cut_lineage(delta)
        buckets = min(len(self.tables["base"].buckets), -(-delta.count() // self.max_rows))
        path, counts = write_rows(delta, label, f"{self.folder}/delta", buckets, self.max_rows)
        touched = sorted(counts)
        seq = self.content["seq"] + 1
        deltas = dict(self.deltas)
        for name in touched:
            deltas[name] = [*deltas.get(name, []), [path, seq]]
        self.commit({}, batch_id, deltas=deltas, seq=seq)
        return touched

    def compact(self, batch_id: str, least: int = 1) -> list[str]:
        """Rewrites the buckets with ``least`` deltas or more; returns the buckets they become."""
        names = [n for n, found in self.deltas.items() if len(found) >= least]
        if not names:
            return []
        merged = cut_lineage(self.rows(names))
        before = self.tables["base"]
        old = {n: before.buckets[n].rows for n in names}
        counts = dict(merged.groupBy(before.name_of(_hash(self.keys))).count().collect())
        grown, written = before.grown({n: counts.get(n, 0) - old[n] for n in names}, self.max_rows)
        table = self.write("base", merged, grown, written, _hash(self.keys))
        self.commit({"base": table}, batch_id, deltas={n: d for n, d in self.deltas.items() if n not in names})
        return written

    def roll_back(self, version: int, batch_id: str) -> None:
        """Makes the content of an old version the newest one; what came between stays in its versions."""
        old = manifest.load(self.spark, self.folder, version)
        content = old | {"batches": [*self.content["batches"], batch_id], "seq": self.content["seq"]}
        manifest.commit(self.spark, self.folder, self.version + 1, content)


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)
