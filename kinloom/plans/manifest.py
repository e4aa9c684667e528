"""Versioned manifests that two jobs can race for.

A manifest is one JSON file per version.  It is written beside its place and renamed to it,
which fails if another job was faster, so of two jobs that read version n one commits
version n + 1 and the other gets ``Conflict`` and starts again from what it lost to.  Data
files are never changed once a manifest names them, so every version stays readable.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Conflict(Exception):
    """Another job has committed this version."""


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _name(folder: str, version: int) -> str:
    return f"{folder.rstrip('/')}/manifest/{version:010d}.json"


def versions(spark: SparkSession, folder: str) -> list[int]:
    """All committed versions, oldest first."""
    path, fs = _path(spark, f"{folder.rstrip('/')}/manifest")
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(int(n.removesuffix(".json")) for n in names if n[0] not in "._" and n.endswith(".json"))


def load(spark: SparkSession, folder: str, version: int) -> dict:
    path, fs = _path(spark, _name(folder, version))
    stream = fs.open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def commit(spark: SparkSession, folder: str, version: int, content: dict) -> None:
    """Makes ``content`` the manifest of ``version``; Conflict if there is one."""
    final = _name(folder, version)
    path, fs = _path(spark, final)
    draft, _ = _path(spark, f"{folder.rstrip('/')}/manifest/.{version:010d}-{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    stream.write(bytearray(json.dumps(content).encode()))
    stream.close()
    jvm = spark._jvm
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = getattr(jvm.org.apache.hadoop.fs.Options.Rename, "NONE")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(draft, path, options)
    except Py4JJavaError as error:
        fs.delete(draft, False)
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            raise Conflict(final) from error
        raise
