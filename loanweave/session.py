"""Spark session defaults and lineage cutting."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "loanweave", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs rely on; anything in ``conf`` wins."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings.update({key.replace("__", "."): str(value) for key, value in conf.items()})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return ship_package(builder.getOrCreate())


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers of the session, once per application."""
    context = spark.sparkContext
    if getattr(context, "_loanweave_shipped", False):
        return spark
    home = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="loanweave-code-"), "loanweave_code.zip")
    with zipfile.ZipFile(archive, "w") as bundle:
        for folder, _, names in os.walk(home):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    bundle.write(path, os.path.relpath(path, os.path.dirname(home)))
    context.addPyFile(archive)
    context._loanweave_shipped = True
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder the cluster names; fall back to a temporary one only on a local master."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="loanweave-checkpoint-")
    context.setCheckpointDir(shared)
    return context.getCheckpointDir()


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries made and run inside leave no shuffle files; else these stay until the driver collects garbage."""
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)


def cut_lineage(frame: DataFrame) -> DataFrame:
    """Write ``frame`` to the checkpoint folder, so later stages re-read it instead of recomputing it."""
    ensure_checkpoint_dir(frame.sparkSession)
    with shuffles_dropped(frame.sparkSession):
        # a query of its own: if ``frame`` ran before, its shuffles may be looked for again
        return frame.select("*").checkpoint(eager=True)


def forget(frame: DataFrame) -> None:
    """Delete the files of a frame that :func:`cut_lineage` made once no frame that reads them is needed."""
    path = frame._jdf.logicalPlan().rdd().getCheckpointFile()
    if path.isDefined():
        discard(frame.sparkSession, path.get())


def stored(frame: DataFrame) -> tuple[DataFrame, str]:
    """``frame`` as Parquet below the checkpoint folder, and its path for :func:`discard`.

    Columns are compressed, so a long table of ids takes a small part of the room of a checkpoint, whose rows are not.
    """
    spark = frame.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/rows-{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        frame.select("*").write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete files that a job wrote below the checkpoint folder and needs no more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def task_slots(spark: SparkSession) -> int:
    """Cores of the cluster: the least task count for numpy-heavy stages, whose byte size says little."""
    return max(2, spark.sparkContext.defaultParallelism)
