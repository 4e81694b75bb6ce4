"""Parcel events: typing, carriers, delays, stock, order timelines and service levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake import constants as C
from bazaarlake.functions import scalars as S
from bazaarlake.functions.timeline import previous


def clean(df: DataFrame) -> DataFrame:
    """Typed parcel events with delivery days (whole days from order to delivery)."""
    out = df.withColumns({
        "event_timestamp": S.parse_timestamp(F.col("timestamp")),
        "ordered_at": S.parse_timestamp(F.col("order_date")),
        "estimated_at": S.parse_timestamp(F.col("estimated_delivery")),
        "delivered_at": S.parse_timestamp(F.col("actual_delivery")),
    })
    return out.withColumn("delivery_days", F.datediff("delivered_at", "ordered_at")).drop("timestamp")


def _mean(total: Column, count: Column) -> Column:
    return total.cast("double") / F.nullif(count, F.lit(0)).cast("double")


def carrier_kpis(parcels: DataFrame) -> DataFrame:
    """Delay rate, mean delivery days and cost per kilogram per carrier."""
    cents = F.sum(F.round(F.col("shipping_cost_eur") * 100).cast("bigint"))
    grams = F.sum(F.round(F.col("weight_kg") * 1000).cast("bigint"))
    return parcels.groupBy("carrier").agg(
        F.count(F.lit(1)).alias("parcels"), F.count_if("is_delayed").alias("delayed"),
        _mean(F.sum("delivery_days"), F.count("delivery_days")).alias("avg_delivery_days"),
        S.safe_divide(cents * 10, grams).alias("cost_per_kg"),
    ).withColumn("delay_rate", S.safe_divide(F.col("delayed"), F.col("parcels")))


def zone_delays(parcels: DataFrame) -> DataFrame:
    return parcels.groupBy("delivery_country", "product_category_id").agg(
        F.count(F.lit(1)).alias("parcels"), F.count_if("is_delayed").alias("delayed"),
    ).withColumn("delay_rate", S.safe_divide(F.col("delayed"), F.col("parcels")))


def delay_reasons(parcels: DataFrame) -> DataFrame:
    return parcels.filter("is_delayed").groupBy("delay_reason").agg(F.count(F.lit(1)).alias("parcels"))


def critical_stock(parcels: DataFrame) -> DataFrame:
    """Warehouses whose latest reported level is critical; the maximum is combined on the map side."""
    order = F.struct("event_timestamp", "event_id")
    return parcels.groupBy("warehouse_id").agg(
        F.max_by("warehouse_stock_level", order).alias("stock_level"), F.max("event_timestamp").alias("seen_at"),
    ).filter(F.col("stock_level") == "critical")


def latest_status(parcels: DataFrame) -> DataFrame:
    order = F.struct("event_timestamp", "event_id")
    return parcels.groupBy("order_id").agg(
        F.max_by("status", order).alias("status"), F.max("event_timestamp").alias("status_at"),
        F.count(F.lit(1)).alias("events"))


def step_no(status: Column) -> Column:
    """1..8 along the delivery flow, NULL for an exception status."""
    return F.nullif(F.array_position(F.array(*[F.lit(s) for s in C.STATUS_FLOW]), status), F.lit(0))


def transitions(parcels: DataFrame, **options) -> DataFrame:
    """Each event with the order's previous status and whether the step is legal.

    Legal: the first event, a step forward or a repeat along the flow, or any step from or to an exception. An
    order id that holds very many events (a placeholder, say) is split by day.
    """
    rows = parcels.select("event_id", "order_id", "event_timestamp", "status").withColumn(
        "_at", S.ticks(parcels, "event_timestamp"))
    out = previous(rows, "order_id", "_at", "event_id", "status", "came_from", 86_400_000_000, **options)
    now, was = step_no(F.col("status")), step_no(F.col("came_from"))
    return out.drop("_at").withColumn("is_legal", F.coalesce(now >= was, F.lit(True)))


def delivery_sla(parcels: DataFrame) -> DataFrame:
    """Delivered parcels, mean days, late parcels, share within three days, share of returns."""
    days = F.col("delivery_days")
    return parcels.agg(
        F.count(F.lit(1)).alias("parcels"), F.count(days).alias("delivered"),
        _mean(F.sum(days), F.count(days)).alias("avg_delivery_days"),
        F.count_if(days > C.LATE_DAYS).alias("late"),
        S.safe_divide(F.count_if(days <= C.FAST_DAYS) * 100, F.count(days)).alias("within_3_days_pct"),
        S.safe_divide(F.count_if(F.col("status") == "returned") * 100, F.count(F.lit(1))).alias("return_pct"),
    )


def status_funnel(parcels: DataFrame) -> DataFrame:
    """Different orders seen in each of the reported stages."""
    stages = ["order_placed", "shipped", "delivered", "returned"]
    return parcels.filter(F.col("status").isin(stages)).groupBy("status").agg(
        F.count_distinct("order_id").alias("orders"))


def delivery_matrix(parcels: DataFrame, zone: str = "delivery_country") -> DataFrame:
    """Mean delivery days by zone and month: twelve fixed pivot columns, so no extra pass finds the values."""
    tall = parcels.filter(F.col("delivery_days").isNotNull()).withColumn("_month", F.month("ordered_at"))
    wide = tall.groupBy(zone).pivot("_month", list(range(1, 13))).agg(
        _mean(F.sum("delivery_days"), F.count("delivery_days")))
    return wide.select(zone, *[F.col(str(m)).alias(f"m{m:02d}") for m in range(1, 13)])


def returns_trend(parcels: DataFrame) -> DataFrame:
    return parcels.filter(F.col("status") == "returned").groupBy(
        F.to_date("event_timestamp").alias("day")).agg(F.count(F.lit(1)).alias("returns"))
