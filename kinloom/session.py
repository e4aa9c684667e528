"""Session settings and the shared scratch folder."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# One local scratch folder per driver process; used on local masters only.
_local_scratch: dict[str, str] = {}


_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def package_for_workers(spark: SparkSession) -> None:
    """Lets Python workers on this machine import the package, wherever the session was started.

    On a cluster the package is installed or sent along as usual.
    """
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if _ROOT not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, (known, _ROOT)))


def build_session(app_name: str = "kinloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume: UTC, AQE, skew splitting."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Split hot partitions also where a second join would reuse their layout.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        # A checkpoint goes once nothing refers to it any more.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local master without that setting gets a private temporary folder (tests,
    notebooks).  A cluster without it is an error: a folder on one machine would
    be lost together with that machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        app = context.applicationId
        if app not in _local_scratch:
            _local_scratch[app] = tempfile.mkdtemp(prefix="kinloom-")
        folder = _local_scratch[app]
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Actions on frames that are made inside drop their shuffle files when they end.

    For results that are kept elsewhere: a frame that is read again would compute them anew.
    """
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of any executor.  The shuffle files behind it go at once.

    A frame that is nothing but such a checkpoint is returned as it is.
    """
    shared_dir(df.sparkSession)
    plan = df._jdf.queryExecution().analyzed()
    if plan.getClass().getSimpleName() == "LogicalRDD" and plan.rdd().getCheckpointFile().isDefined():
        return df
    with shuffles_freed(df.sparkSession):
        return df.select("*").checkpoint(eager=True)


def drop_unused(spark: SparkSession) -> None:
    """Lets Spark's cleaner find checkpoints and shuffles that nothing refers to any more.

    It learns of them from the driver's garbage collector, which may see no cause to run for hours.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
