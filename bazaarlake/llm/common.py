"""Helpers that several operators share: stored tables, words, exact ranks, components."""

from __future__ import annotations

import pickle
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A-Z to a-z on UTF-8 bytes; bytes of other characters stay.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`; a local session without that setting gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="bazaarlake-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` as a table in the shared folder: cuts the lineage and survives the loss of executors.

    Tables lie in one folder per application, which may be removed when the application has ended.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def share(spark: SparkSession, model: object) -> Broadcast:
    """Broadcast an object of a class of this package. Its size must be bounded by a parameter of the caller."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(model))


def loaded(shared: Broadcast):
    """What `share` was given, rebuilt once per Python worker; the pickled form is not kept beside it."""
    if getattr(shared, "_made", None) is None:
        shared._made = pickle.loads(shared.value)
        shared.__dict__.pop("_value", None)
    return shared._made


def with_text(df: DataFrame, columns: list[str], text: str) -> DataFrame:
    """`columns` of `df` as one struct `_rest`, which also holds the text, once: as itself or as `_text_of_row`."""
    own = [F.col(text).alias("_text_of_row")] if text not in columns else []
    return df.select(F.struct(*columns, *own).alias("_rest"))


def texts_of(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Batches of `with_text` with the text beside the struct, sharing its memory."""
    for batch in batches:
        rest = batch.column(0)
        inside = {rest.type.field(k).name: k for k in range(rest.type.num_fields)}
        yield pa.RecordBatch.from_arrays([rest, rest.field(inside.get("_text_of_row", inside.get(text)))], ["_rest", "text"])


def pieces(batches: Iterator[pa.RecordBatch], limit: int, *texts: str) -> Iterator[pa.RecordBatch]:
    """The batches in slices whose text columns hold about `limit` bytes (one row at least), without copying."""
    for batch in batches:
        size = np.zeros(batch.num_rows, np.int64)
        for name in texts:
            size += pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy().astype(np.int64)
        ends, start = np.cumsum(size), 0
        while start < batch.num_rows:
            held = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, held + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def lower_ascii(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def positions(df: DataFrame, order: list[Column], keys: list[str], name: str, at: str) -> DataFrame:
    """Add `at`, the gapless position from 0 of each row within `keys` in the order of `order`.

    No key is gathered in one task: rows are range-partitioned by key and order and written once; a position is the
    position inside the partition plus the rows of the key in earlier partitions (one row per key and partition).
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorting = [*[F.col(k) for k in keys], *order]
    placed = df.repartitionByRange(parts, *sorting).withColumn("_part", F.spark_partition_id())
    placed = stored(placed, name)
    inside = Window.partitionBy("_part", *keys).orderBy(*order)
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("_part", *keys).agg(F.count(F.lit(1)).alias("_rows")).select(
        "_part", *keys, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_base"))
    match = [F.col("l._part") == F.col("r._part"), *[F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]]
    ranked = placed.withColumn(at, F.row_number().over(inside) - 1)
    return ranked.alias("l").join(counts.alias("r"), match).select(
        *[F.col(f"l.{c}") for c in df.columns], (F.col(f"l.{at}") + F.col("r._base")).alias(at))


def components(links: DataFrame) -> DataFrame:
    """(node, component) of the nodes in `links` (a, b); a component is named by its smallest node.

    Every round each node takes the smallest label among its neighbours, hands it to the node that its own label names,
    so that a whole region moves at once, and then takes the label of its label. Rounds go on until no label moves,
    which is right for any links; on paths in any order of ids they grew with the logarithm of the length. Each round
    is stored. Labels never leave Spark.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = stored(both, "links")
    labels = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("a", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        lower = stored(labels.join(near, "a"), "near")
        hooks = lower.groupBy(F.col("label").alias("a")).agg(F.min("near").alias("hook"))
        own = labels.join(hooks, "a", "left").select(
            F.col("a").alias("next"), F.least("label", F.coalesce("hook", "label")).alias("jump"))
        next_label = lower.select("a", F.least("label", "near").alias("next"), "label")
        moved = stored(next_label.join(own, "next").select(
            "a", F.least("next", "jump").alias("label"), (F.least("next", "jump") < F.col("label")).alias("moved")), "labels")
        labels = moved.select("a", "label")
        if moved.filter("moved").isEmpty():
            return labels.select(F.col("a").alias("node"), F.col("label").alias("component"))
