"""Shopping funnel, abandonment, attribution and clickstream signals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake import constants as C
from bazaarlake.functions import scalars as S


def funnel(events: DataFrame) -> DataFrame:
    """Sessions that reached each step in order, and the conversion from the step before.

    A step is reached at its first event at or after the step before was reached, so an earlier visit of a page does
    not hide a later one. Each step reads its own events, joined to one row per session that reached the step before.
    """
    seen = events.select("session_id", "page", F.col("event_timestamp").alias("at")).filter(
        F.col("at").isNotNull() & F.col("session_id").isNotNull())
    reached, totals = None, None
    for i, step in enumerate(C.FUNNEL_STEPS):
        own = seen.filter(F.col("page") == step)
        if reached is not None:
            own = own.join(reached, "session_id").filter(F.col("at") >= F.col("since"))
        reached = own.groupBy("session_id").agg(F.min("at").alias("since"))
        count = reached.agg(F.count(F.lit(1)).alias(f"n{i}"))
        totals = count if totals is None else totals.crossJoin(count)  # one row each
    rows = [
        F.struct(F.lit(i + 1).alias("step_no"), F.lit(step).alias("step"), F.col(f"n{i}").alias("sessions"),
                 (S.safe_divide(F.col(f"n{i}"), F.col(f"n{i - 1}")) if i else F.lit(1.0)).alias("step_conversion"))
        for i, step in enumerate(C.FUNNEL_STEPS)
    ]
    return totals.select(F.inline(F.array(*rows)))


def abandonment(events: DataFrame) -> DataFrame:
    """Sessions with a cart, sessions that left it without confirmation, and the share."""
    flags = events.groupBy("session_id").agg(
        F.bool_or(F.col("event_type") == "cart_add").alias("cart"),
        F.bool_or(F.col("page") == "order_confirmation").alias("ordered"))
    counted = flags.agg(F.count_if("cart").alias("cart_sessions"),
                        F.count_if(F.col("cart") & ~F.col("ordered")).alias("abandoned_sessions"))
    return counted.withColumn("abandonment_rate",
                              S.safe_divide(F.col("abandoned_sessions"), F.col("cart_sessions")))


def attribution(events: DataFrame) -> DataFrame:
    """Conversion by the referrer of a session's first event."""
    per_session = events.groupBy("session_id").agg(
        F.min_by(F.coalesce("referrer", F.lit("direct")), F.struct("event_timestamp", "event_id")).alias("source"),
        F.bool_or(F.col("page") == "checkout_start").alias("converted"))
    return per_session.groupBy("source").agg(
        F.count(F.lit(1)).alias("sessions"), F.count_if("converted").alias("conversions"),
    ).withColumn("conversion_rate", S.safe_divide(F.col("conversions"), F.col("sessions")))


def cart_without_view(events: DataFrame) -> DataFrame:
    """Sessions that fill a cart without having seen a product."""
    return events.groupBy("session_id").agg(
        F.count_if(F.col("event_type") == "cart_add").alias("cart_adds"),
        F.count_if(F.col("page") == "product_detail").alias("product_views"),
    ).filter((F.col("cart_adds") > 0) & (F.col("product_views") == 0))


def multi_device_users(events: DataFrame) -> DataFrame:
    return events.groupBy("user_id").agg(F.count_distinct("device_type").alias("devices")).filter("devices > 1")


def bot_rate(events: DataFrame) -> DataFrame:
    return events.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("events"), F.count_if("is_bot_suspected").alias("bot_events"),
    ).withColumn("bot_rate", S.safe_divide(F.col("bot_events"), F.col("events")))


def kyc_events(events: DataFrame) -> DataFrame:
    """Identity events per user and the rate of successful verifications."""
    counts = events.filter(F.col("event_type").isin(C.KYC_EVENTS)).groupBy("user_id").agg(
        *[F.count_if(F.col("event_type") == e).alias(e) for e in C.KYC_EVENTS])
    return counts.withColumn("success_rate", S.safe_divide(
        F.col("id_verification_success"), F.col("id_verification_started")))
