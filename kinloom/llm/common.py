"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_folder

# The two alphabets of ASCII lower-casing and ASCII white space.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
SPACES = " \t\n\x0b\x0c\r"
BATCH_BYTES = 16 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, everything else unchanged; pure ASCII takes the built-in short cut."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def written(df: DataFrame, label: str, **options) -> DataFrame:
    """The rows as a Parquet table in the shared folder: computed once, safe from lost executors."""
    path = new_folder(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_package(df: DataFrame) -> DataFrame:
    """``df`` in a session whose Python workers find this package and get small batches.

    On a cluster the package is installed or sent along as usual; the path is for
    sessions on one machine that were started from another folder.  Texts are long, so
    batches of more than ``BATCH_BYTES`` would be held several times by every worker.
    """
    conf = df.sparkSession.conf
    now = conf.get(_BATCH).rstrip("b")
    if now.isdigit() and int(now) > BATCH_BYTES:  # a size with a unit was set on purpose
        conf.set(_BATCH, str(BATCH_BYTES))
    env = df.sparkSession.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if _ROOT not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, (known, _ROOT)))
    return df


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    return with_package(df).mapInArrow(run, schema)


_held: list[Callable[[], None]] = []


def holds(release: Callable[[], None]) -> None:
    """Registers how a worker process gives back what it keeps between the tasks of one operator."""
    _held.append(release)


def give_back() -> None:
    for release in _held:
        release()


def map_batches(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema, holding: bool = False
) -> DataFrame:
    """``map_arrow`` batch by batch, with state made once per task by ``make``.

    A task that is not ``holding`` first makes its worker give back what another operator kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not holding:
            give_back()
        step = make()
        for batch in batches:
            yield step(batch)

    return map_arrow(df, run, schema)


def crc_mod(key: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a row without id falls into fold 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % divisor, F.lit(0))
