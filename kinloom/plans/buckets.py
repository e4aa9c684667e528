"""Tables in hash buckets that split, named by versioned manifests.

A bucket is named by (depth, code): it holds the rows whose hash ends in the ``depth`` low
bits ``code``.  One that outgrows ``max_rows`` splits into deeper ones (extendible hashing),
so files and write tasks follow the data; depths differ from bucket to bucket and nothing
else is rewritten.  Data files are never changed once written, so old versions stay readable.

A write puts several small buckets into one folder (``part``), sorted by bucket, so the number
of files follows the amount of data and not the number of buckets.  Each row names the write
and the bucket it belongs to, as another version may hold a bucket in another write.
"""

from __future__ import annotations

import math
import os
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shuffles_freed
from . import manifest

MAX_ROWS = 50_000
MAX_DEPTH = 40  # equal hashes never part; the writer spreads what is left over several files
PART_ROWS = 50_000  # buckets share a folder up to this many rows, and beyond where there are
MOST_PARTS = 1 << 10  # more folders than this
_LISTED = 64  # as many values are compared one by one; more are looked up
_MARKED = 1 << 22
_BUCKET, _PART, _CODE = "_bucket", "_part", "_code"


@dataclass(frozen=True)
class Bucket:
    """``path`` is the folder of the write that holds it, None while it is empty."""

    depth: int
    code: int
    path: str | None
    rows: int

    @property
    def name(self) -> str:
        return f"{self.depth}-{self.code}"


class Directory:
    """The buckets of one table: together they cover every hash exactly once."""

    def __init__(self, buckets: Iterable[Bucket]):
        self.buckets = {b.name: b for b in buckets}

    @classmethod
    def sized(cls, rows: int, max_rows: int) -> Directory:
        depth = min(max(0, math.ceil(math.log2(max(rows, 1) / max_rows))), MAX_DEPTH)
        return cls(Bucket(depth, code, None, 0) for code in range(1 << depth))

    def name_of(self, h: Column) -> Column:
        """The bucket of a hash; one look-up per depth in use but the commonest, which has all others."""
        codes: dict[int, list[int]] = {}
        for b in self.buckets.values():
            codes.setdefault(b.depth, []).append(b.code)
        found = []
        for depth, known in sorted(codes.items(), key=lambda x: (len(x[1]), x[0])):
            low = h.bitwiseAND(F.lit((1 << depth) - 1).cast("long"))
            name = F.concat(F.lit(f"{depth}-"), low.cast("string"))
            found.append(name if len(found) + 1 == len(codes) else F.when(_among(low, known, 1 << depth), name))
        return F.coalesce(*found)

    def names(self, hashes: DataFrame, column: str, bits: int = MAX_DEPTH) -> list[str]:
        """The buckets of some hashes of which ``bits`` low bits are known; at most as many as there are."""
        under: dict[str, list[str]] = {}
        for b in self.buckets.values():
            short = Bucket(min(b.depth, bits), b.code & ((1 << min(b.depth, bits)) - 1), None, 0)
            under.setdefault(short.name, []).append(b.name)
        known = Directory(Bucket(*map(int, name.split("-")), None, 0) for name in under)
        found = hashes.select(known.name_of(F.col(column))).distinct().collect()
        return sorted(name for r in found for name in under[r[0]])

    def read(self, spark: SparkSession, schema: T.StructType, names: Iterable[str]) -> DataFrame:
        """The rows of some buckets."""
        return read_buckets(spark, schema, [(self.buckets[n].path, n) for n in names if self.buckets[n].path])

    def grown(self, added: dict[str, int], max_rows: int) -> tuple[Directory, list[str]]:
        """The directory in which the buckets of ``added`` rows are small enough, and its names for them."""
        buckets, names = dict(self.buckets), []
        for name, more in added.items():
            old = buckets.pop(name)
            levels = max(0, math.ceil(math.log2(max(old.rows + more, 1) / max_rows)))
            depth = max(old.depth, min(old.depth + levels, MAX_DEPTH))
            for high in range(1 << (depth - old.depth)):
                new = Bucket(depth, old.code | high << old.depth, None, 0)
                buckets[new.name] = new
                names.append(new.name)
        return Directory(buckets.values()), names


class BucketStore:
    """One version of some bucketed tables; ``commit`` makes the next one."""

    def __init__(self, spark: SparkSession, folder: str, version: int):
        self.spark, self.folder, self.version = spark, folder.rstrip("/"), version
        self.content = manifest.load(spark, self.folder, version)
        self.max_rows = self.content["max_rows"]
        self.schemas = {t: T.StructType.fromJson(s) for t, s in self.content["schemas"].items()}
        self.tables = {t: Directory(Bucket(*b) for b in found) for t, found in self.content["tables"].items()}

    @classmethod
    def latest(cls, spark: SparkSession, folder: str):
        return cls(spark, folder, manifest.versions(spark, folder)[-1])

    @classmethod
    def first(cls, spark: SparkSession, folder: str, tables: dict[str, tuple[DataFrame, Column]], max_rows: int, **content):
        """Version 0 from whole tables, each with the hash that deals its rows."""
        written = {name: dealt(frame, h, folder, max_rows) for name, (frame, h) in tables.items()}
        return cls.begun(spark, folder, {t: frame.schema for t, (frame, _) in tables.items()}, written, max_rows, **content)

    @classmethod
    def begun(cls, spark: SparkSession, folder: str, schemas: dict[str, T.StructType], written: dict[str, Directory], max_rows: int, **content):
        """Version 0 from tables as ``dealt`` wrote them."""
        shown = {t: schema.jsonValue() for t, schema in schemas.items()}
        manifest.commit(spark, folder, 0, content | {"batches": [], "schemas": shown, "max_rows": max_rows, "tables": listed(written)})
        return cls(spark, folder, 0)

    def read(self, table: str, names: Iterable[str]) -> DataFrame:
        """The rows of some buckets."""
        return self.tables[table].read(self.spark, self.schemas[table], names)

    def whole(self, table: str) -> DataFrame:
        return self.read(table, self.tables[table].buckets)

    def note(self, table: str, hashes: DataFrame, column: str, seen: dict[str, list[str]]) -> list[str]:
        """The buckets of some hashes, entered in ``seen``."""
        names = self.tables[table].names(hashes, column)
        seen[table] = sorted({*seen.get(table, []), *names})
        return names

    def rewritten(self, table: str, touched: list[str], rest: DataFrame, added: DataFrame, h: Column) -> tuple[Directory, list[str]]:
        """The directory after the touched buckets are written as ``rest`` and ``added``; its names for them."""
        directory = self.tables[table]
        counts = dict(added.groupBy(directory.name_of(h)).count().collect())
        grown, names = directory.grown({n: counts.get(n, 0) for n in touched}, self.max_rows)
        frame = rest.unionByName(added, allowMissingColumns=True)
        return write_buckets(frame, h, grown, names, self.folder, self.max_rows), names

    def write(self, table: str, frame: DataFrame, directory: Directory, names: list[str], h: Column) -> Directory:
        """Some buckets of ``directory`` as written from whole rows."""
        return write_buckets(frame.select(*self.schemas[table].names), h, directory, names, self.folder, self.max_rows)

    def commit(self, tables: dict[str, Directory], batch_id: str, **content) -> None:
        """The next version; raises ``manifest.Conflict`` when another job was first."""
        whole = self.content | content | {"batches": [*self.content["batches"], batch_id], "tables": listed(self.tables | tables)}
        manifest.commit(self.spark, self.folder, self.version + 1, whole)

    def applied(self, batch_id: str) -> bool:
        return batch_id in self.content["batches"]


def listed(tables: dict[str, Directory]) -> dict[str, list]:
    return {t: [[b.depth, b.code, b.path, b.rows] for b in d.buckets.values()] for t, d in tables.items()}


def _among(low: Column, codes: list[int], size: int) -> Column:
    """Whether a number below ``size`` is one of ``codes``: many are marked in one literal, a byte each."""
    if len(codes) <= _LISTED or size > _MARKED:
        return low.isin(codes)
    marks = bytearray(size)
    for code in codes:
        marks[code] = 1
    return F.substr(F.lit(marks), (low + 1).cast("int"), F.lit(1)) == F.lit(bytearray(b"\x01"))


def write_rows(frame: DataFrame, name: Column, folder: str, buckets: int, max_rows: int) -> tuple[str, dict[str, int]]:
    """Writes rows of about ``buckets`` buckets; the folder of the write and how many rows of each it holds."""
    together = max(1, PART_ROWS // max_rows)
    bits = max(0, math.ceil(math.log2(min(max(buckets, 1) / together, MOST_PARTS))))
    path = f"{folder}/{uuid.uuid4().hex}-{bits}"
    rows = frame.withColumn(_PART, F.substring_index(name, "-", -1).cast("long").bitwiseAND(F.lit((1 << bits) - 1).cast("long")))
    # One task per folder, or several where it is large; names are no part of what is shuffled, nor that of the write of what is sorted.
    rows = rows.hint("rebalance", _PART).withColumn(_BUCKET, name)
    rows = rows.withColumn(_CODE, F.substring_index(_BUCKET, "-", -1).cast("long")).sortWithinPartitions(_PART, _CODE).drop(_CODE)
    rows = rows.withColumn(_BUCKET, F.concat(F.lit(f"{os.path.basename(path)}/"), _BUCKET)).select(*frame.columns, _BUCKET, _PART)
    with shuffles_freed(frame.sparkSession):
        rows.write.partitionBy(_PART).parquet(path)
    schema = T.StructType([T.StructField(_BUCKET, T.StringType()), T.StructField(_PART, T.LongType())])
    counts = frame.sparkSession.read.schema(schema).parquet(path).groupBy(_BUCKET).count().collect()
    return path, {b.rpartition("/")[2]: n for b, n in counts}


def read_buckets(spark: SparkSession, schema: T.StructType, found: Iterable[tuple[str, str]]) -> DataFrame:
    """The rows of some buckets, given as (folder of the write, name)."""
    folders, wanted = set(), []
    for path, name in found:
        bits = int(path.rpartition("-")[2])
        folders.add(f"{path}/{_PART}={int(name.rpartition('-')[2]) & ((1 << bits) - 1)}")
        wanted.append(f"{os.path.basename(path)}/{name}")
    if not folders:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])  # no Python tasks
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(_BUCKET, T.StringType())])).parquet(*sorted(folders))
    if len(wanted) <= _LISTED:
        rows = rows.filter(F.col(_BUCKET).isin(wanted))
    else:
        rows = rows.join(spark.createDataFrame(pa.table({_BUCKET: wanted})), _BUCKET, "left_semi")
    return rows.select(*schema.names)


def dealt(frame: DataFrame, h: Column, folder: str, max_rows: int) -> Directory:
    """A whole table, written into buckets of about ``max_rows`` rows; the frame is read twice."""
    directory = Directory.sized(frame.count(), max_rows)
    return write_buckets(frame, h, directory, list(directory.buckets), folder.rstrip("/"), max_rows)


def write_buckets(frame: DataFrame, h: Column, directory: Directory, names: list[str], folder: str, max_rows: int) -> Directory:
    """Writes the rows of some buckets to a folder of its own and enters them in the directory."""
    path, counts = write_rows(frame, directory.name_of(h), f"{folder}/data", len(names), max_rows)
    found = dict(directory.buckets)
    for name in names:
        b = found[name]
        found[name] = Bucket(b.depth, b.code, path if counts.get(name) else None, counts.get(name, 0))
    return Directory(found.values())
