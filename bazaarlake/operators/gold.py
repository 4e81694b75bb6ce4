"""Star schema, daily KPIs and the feature store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake import constants as C
from bazaarlake.functions import scalars as S
from bazaarlake.functions.ranking import add_ntiles
from bazaarlake.functions.skew import hot_keys
from bazaarlake.functions.timeline import trailing
from bazaarlake.operators import payments as P


def calendar(days: DataFrame, column: str = "date_actual") -> DataFrame:
    """Calendar attributes of a frame of days."""
    d = F.col(column)
    dom, dow, month = F.dayofmonth(d), F.dayofweek(d), F.month(d)
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"), d.alias("date_actual"),
        F.year(d).alias("year"), F.quarter(d).alias("quarter"), month.alias("month"),
        F.date_format(d, "MMMM").alias("month_name"), F.weekofyear(d).alias("week_of_year"),
        dow.alias("day_of_week"), F.date_format(d, "EEEE").alias("day_name"), dom.alias("day_of_month"),
        dow.isin(1, 7).alias("is_weekend"),
        ((month == 1) & (dom == 1)).alias("is_new_year"),
        ((month == 7) & (dom == 14)).alias("is_bastille_day"),
        ((month == 12) & (dom == 25)).alias("is_christmas"),
        ((month == 11) & (dow == 6) & dom.between(23, 29)).alias("is_black_friday"),
        month.isin(11, 12).alias("is_holiday_season"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.concat(F.lit("Q"), F.quarter(d), F.lit(" "), F.year(d)).alias("year_quarter"),
    )


def dim_date(spark: SparkSession, start: str = "2020-01-01", end: str = "2025-12-31") -> DataFrame:
    """One row per day of [start, end)."""
    bounds = spark.range(1).select(S.as_day(start).alias("a"), F.date_sub(S.as_day(end), 1).alias("b"))
    return dim_date_of(bounds)


def dim_date_of(bounds: DataFrame) -> DataFrame:
    """One row per day between the columns `a` and `b` of a one-row frame, both included."""
    return calendar(bounds.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 DAY"))).alias("date_actual")))


def payment_totals(payments: DataFrame) -> DataFrame:
    """Lifetime totals of successful payments per user. `transaction_id` is unique, so rows are orders."""
    return payments.filter(F.col("status") == "success").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("lifetime_orders"),
        F.sum("amount_eur").alias("lifetime_value_eur"),
        F.max("event_date").alias("last_purchase_date"),
        F.min("event_date").alias("first_purchase_date"),
    )


def fraud_attempts(payments: DataFrame) -> DataFrame:
    return payments.groupBy("user_id").agg(F.count_if("fraud_label").alias("fraud_attempts"))


def session_totals(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_sessions"),
        (F.sum("session_duration_seconds").cast("double") / F.count(F.lit(1))).alias("avg_session_duration_s"),
        (F.count_if("has_conversion").cast("double") / F.count(F.lit(1))).alias("conversion_rate"),
    )


def dim_customers(crm: DataFrame, payments: DataFrame, sessions: DataFrame, as_of, tie: str = "user_id",
                  compat: bool = False) -> DataFrame:
    """One row per customer with recency, frequency and money scores.

    Facts are aggregated before the joins, so the joins are one row per user on each side. A customer who never
    bought gets the lowest recency score; `compat=True` puts them last in the descending order instead.
    """
    totals = payment_totals(payments).join(fraud_attempts(payments), "user_id", "full")
    joined = crm.join(totals, "user_id", "left").join(session_totals(sessions), "user_id", "left")
    orders, value = F.coalesce("lifetime_orders", F.lit(0)), F.coalesce("lifetime_value_eur", F.lit(0))
    rows = joined.select(
        S.surrogate_key("user_id").alias("customer_key"), "user_id", "age",
        S.age_group(F.col("age")).alias("age_group"), "city", "postal_zone", "country",
        F.col("id_verification_status").alias("kyc_status"), "is_minor",
        (F.col("is_minor") & (F.col("id_verification_status") == "verified")).alias("kyc_minor_anomaly"),
        "customer_segment",
        F.datediff(S.as_day(as_of), "last_purchase_date").alias("recency_days"),
        orders.alias("frequency"), value.cast("decimal(38,2)").alias("monetary_eur"),
        F.when(orders > 0, value.cast("double") / orders.cast("double")).otherwise(0.0).alias("avg_order_value_eur"),
        F.coalesce("total_sessions", F.lit(0)).alias("total_sessions"),
        F.coalesce("conversion_rate", F.lit(0.0)).alias("session_conversion_rate"),
        F.coalesce("fraud_attempts", F.lit(0)).alias("fraud_attempts_count"),
        (F.coalesce("fraud_attempts", F.lit(0)) > 0).alias("has_fraud_history"),
        "registration_date", "first_purchase_date", "last_purchase_date", "gdpr_consent_date", "newsletter_optin",
    )
    recency = F.col("recency_days").desc_nulls_last() if compat else F.col("recency_days").desc_nulls_first()
    return add_ntiles(rows, "user_id", {
        "rfm_recency_score": [recency, F.col(tie)],
        "rfm_frequency_score": [F.col("frequency"), F.col(tie)],
        "rfm_monetary_score": [F.col("monetary_eur"), F.col(tie)],
    })


def risk_category(adult: Column, price_max: Column) -> Column:
    """Risk of a product from its catalogue row: age-restricted, expensive or ordinary goods."""
    return F.when(adult, "high").when(price_max >= C.GEO_MISMATCH_MIN, "medium").otherwise("low")


def dim_products(catalogue: DataFrame) -> DataFrame:
    return catalogue.select(
        S.surrogate_key("product_id").alias("product_key"), "product_id", "name", "category_id", "adult_only",
        risk_category(F.col("adult_only"), F.col("price_max")).alias("risk_category"),
    )


def dim_merchants(merchants: DataFrame) -> DataFrame:
    return merchants.select(
        S.surrogate_key("merchant_id").alias("merchant_key"), "merchant_id", "merchant_name", "region")


def fact_orders(payments: DataFrame, customers: DataFrame, products: DataFrame, dates: DataFrame,
                statuses: tuple[str, ...] = ("success",)) -> DataFrame:
    """One row per payment with the wanted status, joined to its dimensions.

    No side is forced to broadcast: Spark broadcasts a dimension whose measured size is below its threshold and
    otherwise sorts and merges, splitting skewed keys at run time. The date key is computed, not looked up, where
    the calendar covers the day.
    """
    c = customers.select("user_id", "customer_key", "customer_segment", "kyc_status", "age_group")
    p = products.select("product_id", "product_key", "category_id", "risk_category")
    d = dates.select(F.col("date_actual").alias("event_date"), F.col("date_key").alias("order_date_key"))
    return (
        payments.filter(F.col("status").isin(*statuses))
        .join(c, "user_id", "left").join(p, "product_id", "left").join(d, "event_date", "left")
        .select(
            S.surrogate_key("transaction_id").alias("fact_key"), "transaction_id", "order_id", "user_id",
            "merchant_id", "customer_key", "product_key", "order_date_key", "amount_eur", "currency_code",
            "payment_method", "quantity", "billing_country_iso", "shipping_country_iso", "is_cross_border",
            "ip_geo_mismatch", "geo_distance_km", "user_is_minor", "is_first_transaction", "is_new_card",
            "is_new_merchant", "user_txn_count_30d", "amount_vs_avg_ratio", "fraud_label", "fraud_score_label",
            "fraud_type", "customer_segment", "kyc_status", "age_group", "category_id", "risk_category",
            "event_date", "event_timestamp", "status",
        )
    )


def orphans(facts: DataFrame, dimension: DataFrame, key: str, error: str) -> DataFrame:
    """Facts whose key is missing in the dimension."""
    return facts.join(dimension.select(key), key, "left_anti").select(
        "transaction_id", F.lit(error).alias("integrity_error"))


def referential_integrity(facts: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Zero rows mean that every fact has its customer and its product."""
    return orphans(facts, customers, "customer_key", "missing_customer").unionByName(
        orphans(facts, products, "product_key", "missing_product"))


def kpi_daily(facts: DataFrame) -> DataFrame:
    return facts.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("amount_eur").cast("double").alias("revenue_eur"),
        F.count_distinct("user_id").alias("active_customers"),
        (F.sum("amount_eur").cast("double") / F.count(F.lit(1)).cast("double")).alias("avg_basket_eur"),
        F.count_if("is_cross_border").alias("cross_border_orders"),
        F.count_if("is_first_transaction").alias("first_orders"),
    )


def feature_store(facts: DataFrame, hot: DataFrame | list | str | None = None, **options) -> DataFrame:
    """Point-in-time features, one row per labelled payment.

    The short windows are exact to the microsecond; the 30-day figures are at day grain, so all payments of a day
    see the whole day. Heavy users are searched once for all windows if `hot` does not name them.
    """
    options["hot"] = hot_keys(facts.select("user_id"), "user_id") if hot is None else hot
    counted = P.velocity(P.velocity(facts, 300, "txn_count_5min", **options), 3_600, "txn_count_1h", **options)
    cents = (F.col("amount_eur") * 100).cast("bigint")
    daily = trailing(
        counted.withColumns({"_day": F.unix_date("event_date"), "_cents": cents}), "user_id", "_day", 30,
        {"_n": F.lit(1), "_sum": F.col("_cents"),
         "_squares": F.col("_cents").cast("decimal(19,0)") * F.col("_cents").cast("decimal(19,0)")},
        chunk=365, **options,
    )
    n, mean = F.col("_n").cast("double"), F.col("_sum").cast("double") / 100 / F.col("_n").cast("double")
    spread = (F.col("_n") * F.col("_squares") - F.col("_sum") * F.col("_sum")).cast("double")
    return daily.filter(F.col("fraud_label").isNotNull()).select(
        "transaction_id", "user_id", F.col("event_date").alias("feature_date"),
        "txn_count_5min", "txn_count_1h", F.col("_n").cast("bigint").alias("txn_count_30d"),
        mean.alias("avg_amount_30d"), S.safe_divide(F.col("amount_eur"), mean).alias("amount_vs_avg_ratio"),
        F.when(F.col("_n") > 1, S.round_to(F.sqrt(spread / (n * (n - 1))) / 100)).alias("amount_stddev_30d"),
        "geo_distance_km", "kyc_status", "age_group", "risk_category", "category_id", "payment_method",
        "billing_country_iso", "shipping_country_iso", "is_cross_border", "user_is_minor", "is_first_transaction",
        "is_new_card", "is_new_merchant", "ip_geo_mismatch", F.col("fraud_label").alias("is_fraud"),
        "fraud_score_label", "fraud_type", "event_timestamp", "amount_eur",
    )
