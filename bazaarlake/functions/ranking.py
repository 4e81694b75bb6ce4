"""Latest-version selection and exact quantile tiles without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.session import checkpointed


def dedup_latest(df: DataFrame, keys: list[str], order_by: list[Column]) -> DataFrame:
    """Keep one row per key: the first in `order_by`, which must be a total order for repeatable results.

    `row_number() = 1` makes Spark prune to one row per key before the shuffle, so a key with very many copies
    costs one row per map task.
    """
    latest = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(latest)).filter("_rank = 1").drop("_rank")


def _tile(rank: Column, total: Column, tiles: int) -> Column:
    size = F.floor(total / tiles)
    longer = total % tiles
    border = longer * (size + 1)
    return F.when(rank < border, F.floor(rank / (size + 1)) + 1).otherwise(
        longer + F.floor((rank - border) / F.greatest(size, F.lit(1))) + 1
    ).cast("int")


def ntile_by_sort(df: DataFrame, key: str, order_by: list[Column], tiles: int, name: str) -> DataFrame:
    """(key, tile) from a distributed sort: position inside the partition plus the sizes of earlier partitions.

    The sorted rows are checkpointed, since both the positions and the sizes must come from one placement.
    """
    placed = checkpointed(df.orderBy(*order_by).select(key, F.monotonically_increasing_id().alias("_place")))
    placed = placed.select(
        key, F.shiftright("_place", 33).alias("_part"), F.col("_place").bitwiseAND((1 << 33) - 1).alias("_at")
    )
    # One row per sort partition, so at most spark.sql.shuffle.partitions rows reach this window.
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sizes = sizes.select(
        "_part",
        F.coalesce(F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_base"),
        F.sum("_size").over(everything).alias("_total"),
    )
    return placed.join(sizes, "_part").select(
        key, _tile(F.col("_base") + F.col("_at"), F.col("_total"), tiles).alias(name)
    )


def add_ntiles(df: DataFrame, key: str, scores: dict[str, list[Column]], tiles: int = 5) -> DataFrame:
    """Add one NTILE column per score, each from a distributed sort."""
    stable = checkpointed(df)
    out = stable
    for name, order in scores.items():
        out = out.join(ntile_by_sort(stable, key, order, tiles, name), key)
    return out


def running_totals(df: DataFrame, by: list[str], order_by: list[Column], sums: list[str]) -> DataFrame:
    """Add `before_<name>` per name of `sums`: its sum over the earlier rows of the same `by` in the order.

    Rows are sorted by range, so a group that holds most rows is spread over many tasks: a row adds up its own sort
    partition, and the totals of earlier partitions are added to that. The order must be total within a group. Columns
    of `by` hold no NULL; a NULL in a summed column counts as 0.
    """
    placed = checkpointed(df.orderBy(*by, *order_by).withColumn("_place", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_place", 33))
    earlier = Window.partitionBy("_part", *by).orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    inside = placed.withColumns({f"_in_{s}": F.coalesce(F.sum(s).over(earlier), F.lit(0)) for s in sums})
    # One row per sort partition and group that it holds.
    ends = placed.groupBy("_part", *by).agg(*(F.sum(s).alias(f"_sum_{s}") for s in sums))
    parts = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("_part", *by, *(F.coalesce(F.sum(f"_sum_{s}").over(parts), F.lit(0)).alias(f"_base_{s}") for s in sums))
    return inside.join(ends, ["_part", *by]).select(
        *df.columns, *((F.col(f"_base_{s}") + F.col(f"_in_{s}")).alias(f"before_{s}") for s in sums))
