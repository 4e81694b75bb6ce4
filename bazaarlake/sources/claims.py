"""Which run works on which document file: claims and completions in a stored table.

One row per file that was ever claimed: `path`, `run`, `state` (claimed, done or failed), `claimed_at`, `finished_at`
and the day `claimed_on`, by which the table is partitioned. A claim is an upsert that names the version it was chosen
from. Of two runs that choose at the same time one loses the swap of the manifest and chooses again, so no file is
given to two runs. A claim that is not finished within the lease, because its run died, is given out again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.functions import scalars as S
from bazaarlake.operators import snapshots
from bazaarlake.session import checkpointed
from bazaarlake.sources.readers import pending_documents

LEASE_HOURS = 6
SCHEMA = "path string, run string, state string, claimed_at timestamp, finished_at timestamp, claimed_on date"


def ledger(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """Every file that was claimed, with its state; no rows before the first claim."""
    if version == 0 or snapshots.manifest(spark, folder, version) is None:
        return spark.createDataFrame([], SCHEMA)
    return snapshots.read(spark, folder, version)


def _version(spark: SparkSession, folder: str) -> int:
    return (snapshots.versions(spark, folder) or [0])[-1]


def held(rows: DataFrame, at, lease_hours: int = LEASE_HOURS) -> DataFrame:
    """Files that no run may take now: done, or claimed within the lease."""
    since = S.as_timestamp(at) - F.make_interval(hours=F.lit(lease_hours))
    return rows.filter((F.col("state") == "done") | ((F.col("state") == "claimed") & (F.col("claimed_at") > since)))


def claim(spark: SparkSession, files: DataFrame, folder: str, run: str, at, batch: int = 50,
          lease_hours: int = LEASE_HOURS) -> DataFrame:
    """The files (`path`) of this run: the `batch` oldest that are free, written to the ledger before they are returned.

    A run that starts again under its own name gets the files that it holds already. Repeated paths count once. A file
    that failed queues again as if it had come when it failed, so files that always fail do not block the others. A run
    that loses a race chooses again from the newer version; each loss means that another run has got its files.
    """
    while True:
        version = _version(spark, folder)
        known = ledger(spark, folder, version)
        own = known.filter((F.col("run") == run) & (F.col("state") == "claimed"))
        if not own.isEmpty():
            return own.select("path")
        oldest = files.filter(F.col("path").isNotNull()).groupBy("path").agg(
            F.min("modificationTime").alias("modificationTime"))
        failed = known.filter("state = 'failed'").select("path", "finished_at")
        oldest = oldest.join(failed, "path", "left").withColumn(
            "modificationTime", F.greatest("modificationTime", "finished_at")).drop("finished_at")
        at_ = S.as_timestamp(at)
        taken = checkpointed(pending_documents(oldest, batch, held(known, at, lease_hours)).select(
            "path", F.lit(run).alias("run"), F.lit("claimed").alias("state"), at_.alias("claimed_at"),
            F.lit(None).cast("timestamp").alias("finished_at"), at_.cast("date").alias("claimed_on")))
        if taken.isEmpty():
            return taken.select("path")
        try:
            snapshots.upsert(spark, taken, folder, ["path"], "claimed_on", expected=version)
            return taken.select("path")
        except snapshots.Conflict:
            continue


def finish(spark: SparkSession, worked: DataFrame, folder: str, run: str, at, state: str = "done") -> None:
    """Mark the files of `worked` (`path`) that this run still holds; those that another run took over stay its own."""
    while True:
        version = _version(spark, folder)
        known = ledger(spark, folder, version)
        rows = known.filter((F.col("run") == run) & (F.col("state") == "claimed")).join(
            worked.select("path").distinct(), "path", "left_semi")
        closed = rows.withColumns({"state": F.lit(state), "finished_at": S.as_timestamp(at)}).select(*known.columns)
        if closed.isEmpty():
            return
        try:
            snapshots.upsert(spark, closed, folder, ["path"], "claimed_on", expected=version)
            return
        except snapshots.Conflict:
            continue
