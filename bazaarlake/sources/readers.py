"""Named tables, daily partitions, the customer file, identity documents and incremental slices."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake import constants as C
from bazaarlake import schemas
from bazaarlake.functions import scalars as S


@dataclass(frozen=True)
class Source:
    path: str
    loaded_at: str
    format: str = "parquet"


class Registry:
    """Logical table name to location; every job asks here instead of building paths.

    The format is Parquet unless the cluster offers another one, such as Delta.
    """

    def __init__(self, base: str, format: str = "parquet"):
        self.base, self.format = base.rstrip("/"), format
        names = {
            "bronze.payments": "ingested_at", "bronze.clickstream": "ingested_at", "bronze.logistics": "ingested_at",
            "bronze.crm": "ingested_at", "silver.payments": "silver_loaded_at", "silver.sessions": "silver_loaded_at",
            "silver.clickstream": "ingested_at", "silver.logistics": "ingested_at", "silver.crm": "pii_anonymized_at",
            "quarantine.payments": "ingested_at", "gold.fact_orders": "event_date", "gold.dim_customers": "",
            "gold.dim_products": "", "gold.dim_merchants": "", "gold.dim_date": "", "gold.kpi_daily": "event_date",
            "gold.fraud_feature_store": "event_timestamp", "gold.fact_fraud_scores": "event_timestamp",
        }
        self.tables = {n: Source(f"{self.base}/{n.replace('.', '/')}", at, format) for n, at in names.items()}

    def path(self, name: str) -> str:
        return self.tables[name].path

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        """The table with columns of every schema version: later columns are NULL in older files."""
        reader = spark.read.format(self.format)
        if self.format == "parquet":
            reader = reader.option("mergeSchema", "true")
        return reader.load(self.path(name))


def of_day(df: DataFrame, run_date: str | date) -> DataFrame:
    """One ingestion day by its partition columns, so only that folder is read."""
    day = date.fromisoformat(str(run_date))
    return df.filter((F.col("year") == day.year) & (F.col("month") == day.month) & (F.col("day") == day.day))


def is_ready(df: DataFrame, run_date: str | date) -> bool:
    """Whether the day has at least one row."""
    return not of_day(df, run_date).isEmpty()


def read_crm(spark: SparkSession, base: str, ingested_at=None, **extra: str) -> DataFrame:
    """The daily customer CSV under year=/month=/day= folders, by a fixed schema. `extra` adds text columns."""
    added = {**extra, "year": "int", "month": "int", "day": "int"}
    schema = T.StructType(schemas.CRM.fields + [T.StructField(n, schemas.KINDS[k]) for n, k in added.items()])
    at = F.current_timestamp() if ingested_at is None else S.as_timestamp(ingested_at)
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(base).withColumn(
        "ingested_at", at)


def document_files(spark: SparkSession, base: str, pattern: str = "*.{jpg,jpeg,png,webp}") -> DataFrame:
    """Identity document files with user (parent folder), size and age. File contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    return files.load(base).select(
        "path", F.regexp_extract("path", "([^/]+)/[^/]+$", 1).alias("user_id"), "length", "modificationTime")


def accepted_uploads(files: DataFrame, max_bytes: int = C.UPLOAD_MAX_BYTES) -> DataFrame:
    return files.filter(F.lower("path").rlike(r"\.(jpe?g|png|webp)$") & (F.col("length") <= max_bytes))


def pending_documents(files: DataFrame, batch: int = 50, finished: DataFrame | None = None) -> DataFrame:
    """The oldest files that are not in `finished` (its column `path`). The batch size is the feature: a run stores the
    paths it has worked on, and later runs take the rest."""
    if finished is not None:
        files = files.join(finished.select("path").distinct(), "path", "left_anti")
    return files.orderBy("modificationTime", "path").limit(batch)


def expired_documents(files: DataFrame, as_of, hours: int = C.RETENTION_HOURS) -> DataFrame:
    return files.filter(F.col("modificationTime") < S.as_timestamp(as_of) - F.make_interval(hours=F.lit(hours)))


def newer_than_target(source: DataFrame, target: DataFrame | None, column: str, full_refresh: bool = False,
                      target_column: str | None = None) -> DataFrame:
    """Source rows newer than the newest loaded row. The maximum is one value, compared as a literal."""
    if full_refresh or target is None:
        return source
    newest = target.agg(F.max(target_column or column)).first()[0]
    return source if newest is None else source.filter(F.col(column) > F.lit(newest))


def newer_rows(source: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """`newer_than_target` as one lazy plan: the maximum is a scalar subquery, not a join."""
    newest = target.agg(F.coalesce(F.max(column), F.lit("1970-01-01").cast("timestamp"))).scalar()
    return source.filter(F.col(column) > newest)


def lookback(df: DataFrame, column: str, as_of, days: int = 3, full_refresh: bool = False) -> DataFrame:
    if full_refresh:
        return df
    return df.filter(F.col(column) >= F.date_sub(S.as_day(as_of), days).cast("timestamp"))
