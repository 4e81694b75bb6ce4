"""Session settings and lineage cutting shared by every job."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that a query may also apply to a running session.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    # A generated method above 8000 bytes of code is never compiled by the JVM: let Spark use smaller pieces instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
SETTINGS = {
    **RUNTIME,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs that start inside go as soon as their job has ended.

    Otherwise they stay until the driver happens to collect its garbage, so that a job of several steps holds those of
    all steps at once. For jobs that store their result: nobody reads their shuffles again. Spark before 4.1 ignores it.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of `df` with a reliable checkpoint, and let go of the shuffle files that led to it.

    The folder is the cluster's `spark.checkpoint.dir`. Only a local session without that setting (tests) gets
    a temporary folder; on a cluster a machine-local folder would not survive the loss of an executor.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if context.master != "local" and not context.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
            folder = tempfile.mkdtemp(prefix="bazaarlake-checkpoint-")
        context.setCheckpointDir(folder)
    with released(spark):
        return df.select("*").checkpoint(eager=True)  # a frame of its own: one that was made outside keeps its files
