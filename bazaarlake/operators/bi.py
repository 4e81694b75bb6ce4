"""Commercial and fraud measures on facts and scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.functions import scalars as S


def revenue(facts: DataFrame) -> DataFrame:
    """Total revenue, active customers and mean basket."""
    return facts.agg(
        F.sum("amount_eur").cast("double").alias("revenue_eur"), F.count_distinct("user_id").alias("active_customers"),
        F.count(F.lit(1)).alias("orders"),
    ).withColumn("avg_basket_eur", F.col("revenue_eur") / F.col("orders").cast("double"))


def monthly_growth(facts: DataFrame) -> DataFrame:
    """Revenue per month and growth over the calendar month before; a missing month gives NULL.

    The window runs over one row per month, after aggregation.
    """
    monthly = facts.groupBy(F.trunc("event_date", "month").alias("month")).agg(
        F.sum("amount_eur").cast("double").alias("revenue_eur"))
    ordered = Window.orderBy("month")
    adjacent = F.add_months(F.lag("month").over(ordered), 1) == F.col("month")
    before = F.when(adjacent, F.lag("revenue_eur").over(ordered))
    return monthly.withColumn("previous_eur", before).withColumn(
        "growth", S.safe_divide(F.col("revenue_eur") - F.col("previous_eur"), F.col("previous_eur")))


def retention(facts: DataFrame) -> DataFrame:
    """Customers with more than one order in some 30-day window, over all active customers."""
    per_user = facts.groupBy("user_id").agg(F.max("user_txn_count_30d").alias("_most"))
    return per_user.agg(
        F.count_if(F.col("_most") > 1).alias("retained"), F.count(F.lit(1)).alias("active"),
    ).withColumn("retention_rate", S.safe_divide(F.col("retained"), F.col("active")))


def top_merchants(facts: DataFrame, merchants: DataFrame, count: int = 10) -> DataFrame:
    """The best merchants by revenue. Only the ten best rows reach the join."""
    best = facts.groupBy("merchant_id").agg(F.sum("amount_eur").alias("_revenue"), F.count(F.lit(1)).alias("orders"))
    best = best.orderBy(F.col("_revenue").desc(), "merchant_id").limit(count)
    return best.join(merchants, "merchant_id", "left").select(
        "merchant_id", "merchant_name", "region", "orders", F.col("_revenue").cast("double").alias("revenue_eur"))


def by_category(facts: DataFrame) -> DataFrame:
    return facts.groupBy("category_id", "risk_category").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("amount_eur").cast("double").alias("revenue_eur"))


def by_country(facts: DataFrame) -> DataFrame:
    return facts.groupBy("billing_country_iso").agg(
        F.count(F.lit(1)).alias("orders"), F.count_distinct("user_id").alias("customers"))


def vip_customers(facts: DataFrame) -> DataFrame:
    return facts.filter(F.col("customer_segment") == "vip").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("amount_eur").cast("double").alias("revenue_eur"),
    ).withColumn("avg_basket_eur", F.col("revenue_eur") / F.col("orders").cast("double"))


def fraud_monitor(scores: DataFrame) -> DataFrame:
    """Blocked payments, mean score, block rate, estimated false positives and amount saved."""
    blocked = F.col("fraud_decision") == "BLOCK"
    points = F.round(F.col("fraud_probability") * 10_000).cast("bigint")
    return scores.agg(
        F.count(F.lit(1)).alias("payments"), F.count_if(blocked).alias("blocked"),
        (F.sum(points).cast("double") / 10_000 / F.count(F.lit(1)).cast("double")).alias("avg_score"),
        S.safe_divide(F.count_if(blocked) * 100, F.count(F.lit(1))).alias("blocked_pct"),
        F.count_if(blocked & ~F.coalesce("confirmed_fraud", F.lit(False))).alias("false_positives"),
        F.coalesce(F.sum(F.when(blocked, F.col("amount_eur"))), F.lit(0)).cast("double").alias("saved_eur"),
    )


def decision_mix(scores: DataFrame) -> DataFrame:
    return scores.groupBy("fraud_decision").agg(F.count(F.lit(1)).alias("payments"))


def score_histogram(scores: DataFrame) -> DataFrame:
    """Bins of 0.1; a probability of 1 belongs to the last bin."""
    tenth = F.floor(S.round_to(F.col("fraud_probability") * 10, 6))
    return scores.groupBy((F.when(tenth > 9, 9).otherwise(tenth) / 10.0).cast("double").alias("bin")).agg(F.count(F.lit(1)).alias("payments"))


def blocked_trend(scores: DataFrame) -> DataFrame:
    return scores.filter(F.col("fraud_decision") == "BLOCK").groupBy("event_date").agg(
        F.count(F.lit(1)).alias("blocked"))


def review_queue(scores: DataFrame) -> DataFrame:
    return scores.filter(F.col("fraud_decision") == "BLOCK").select(
        "transaction_id", "user_id", F.col("amount_eur").cast("double").alias("amount_eur"), "billing_country_iso",
        "fraud_probability")


def distance_vs_score(scores: DataFrame) -> DataFrame:
    return scores.filter(F.col("geo_distance_km").isNotNull()).select(
        "transaction_id", "geo_distance_km", "fraud_probability")
