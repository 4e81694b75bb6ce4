"""Every operator as a named query over whole tables: `QUERIES[name](spark, sf_dir)`."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake import constants as C
from bazaarlake.functions import scalars as S
from bazaarlake.functions.ranking import add_ntiles, dedup_latest
from bazaarlake.functions.skew import ALL, hot_keys, none_hot
from bazaarlake.operators import bi, crm, fraud, funnel, gold, kyc, logistics, ml, privacy, quality, sessions, snapshots, tables, training
from bazaarlake.operators import payments as P
from bazaarlake.plans import bindings as B
from bazaarlake.session import RUNTIME, checkpointed, released
from bazaarlake.sources import claims, readers, streams
from bazaarlake.sources.bronze import parse_json
from bazaarlake import schemas
from bazaarlake.streaming import jobs, scoring

AS_OF = B.AS_OF
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Zone-free timestamps and doubles instead of decimals, as the second engine returns them."""
    casts = []
    for f in df.schema.fields:
        kind = {T.TimestampType: "timestamp_ntz", T.DecimalType: "double"}.get(type(f.dataType))
        casts.append(F.col(f.name).cast(kind).alias(f.name) if kind else F.col(f.name))
    return df.select(*casts)


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        for name, value in RUNTIME.items():
            spark.conf.set(name, value)
        return comparable(function(spark, sf))

    QUERIES[function.__name__] = run
    return function


# Shared steps.

def clean(spark, sf):
    return P.clean(P.latest(B.payments(spark, sf)))


def valid(spark, sf):
    return P.split(clean(spark, sf))[0]


def heavy_users(spark, sf):
    """Users with many messages, from the lines of their orders: the wide messages are not computed for it.

    Cleaning only takes messages away and leaves `user_id` as it is, so no heavy user of a later table is missed.
    """
    return hot_keys(B.payment_users(spark, sf), "user_id", rows="rows")


def curated(spark, sf, heavy=None, rows=None):
    """The payments table; `rows` gives the valid payments if they are stored already."""
    rows = valid(spark, sf) if rows is None else rows
    return P.curated(P.enrich(rows, hot=heavy_users(spark, sf) if heavy is None else heavy), AS_OF)


def stored(spark, rows, name):
    """`rows` as a compressed table beside the checkpoints; the shuffle files that led to it go."""
    path = scratch(spark, name)
    with released(spark):
        rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def stored_valid(spark, sf, read):
    """Valid payments with the columns in `read`, stored between the two moves by transaction and by user.

    So the shuffle files of the first are gone when those of the second come; a table of columns is smaller than either.
    """
    rows = valid(spark, sf)
    return stored(spark, rows.select(*[c for c in rows.columns if c in read]), "valid")


def stored_payments(spark, sf):
    """What the payments table is made of, stored."""
    rows = stored_valid(spark, sf, P.carried(valid(spark, sf)))
    return rows.withColumn("reject_reason", F.lit(None).cast("string"))


def silver_crm(spark, sf):
    return crm.build(B.crm(spark, sf), B.SALT, AS_OF)


def silver_sessions_(spark, sf):
    return sessions.build(B.clickstream(spark, sf), AS_OF)


def events(spark, sf):
    return sessions.normalise(B.clickstream(spark, sf)).withColumn("event_date", F.to_date("event_timestamp"))


def typed_events(spark, sf):
    """Every event, bots included, for the funnel and signal reports."""
    return B.clickstream(spark, sf).withColumn("event_timestamp", S.parse_timestamp(F.col("timestamp"))).withColumn(
        "event_date", F.to_date("event_timestamp"))


def parcels(spark, sf):
    return logistics.clean(B.logistics(spark, sf))


def facts(spark, sf, statuses=("success",), heavy=None, rows=None):
    return facts_from(spark, sf, curated(spark, sf, heavy, rows), statuses)


def labelled_features(spark, sf, rows=None):
    heavy = heavy_users(spark, sf)
    return gold.feature_store(facts(spark, sf, ("success", "blocked"), heavy, rows), hot=heavy)


def facts_from(spark, sf, paid, statuses=("success",)):
    """Facts without the customer scores, which no report on facts reads."""
    people = silver_crm(spark, sf).select(
        "user_id", S.surrogate_key("user_id").alias("customer_key"), "customer_segment",
        F.col("id_verification_status").alias("kyc_status"), S.age_group(F.col("age")).alias("age_group"))
    since = F.datediff("o_orderdate", F.lit("1995-01-01").cast("date")) % 60
    first = F.lit(B.EPOCH).cast("date")
    days = B.table(spark, sf, "orders").agg(F.date_add(first, F.min(since)).alias("a"),
                                            F.date_add(first, F.max(since) + 1).alias("b"))
    return gold.fact_orders(paid, people, gold.dim_products(B.products(spark, sf)),
                            gold.dim_date_of(days), statuses)


def enriched_payments(spark, sf):
    """Payments with features, and the heavy users; without any, no later step searches again.

    Rules, scores and reports all read the rows, so they are stored once instead of computed per reader, with the
    columns that these read: a checkpoint takes what it is given, and the steps before it then carry no other column.
    Bursts lie inside a user, so without heavy users they are counted where the user's rows are.
    """
    heavy = heavy_users(spark, sf)
    enriched = P.enrich(stored_valid(spark, sf, {*fraud.JUDGED, *P.WINDOWED}), hot=heavy).select(*fraud.JUDGED)
    return stored(spark, fraud.add_burst(enriched, hot=[], lies="user_id") if none_hot(heavy) else enriched, "enriched"), heavy


def rule_hits(spark, sf):
    enriched, heavy = enriched_payments(spark, sf)
    return enriched, fraud.rules(enriched, hot=[] if none_hot(heavy) else None)


def scores(spark, sf):
    enriched, hits = rule_hits(spark, sf)
    placed = enriched.withColumn("geo_distance_km", S.round_to(S.country_distance_km(
        F.col("ip_country_code"), F.col("shipping_country_iso")), 1))
    return fraud.fact_fraud_scores(placed, fraud.rule_scores(hits))


# Sources.

@query
def bronze_parse_events(spark, sf):
    messages = B.kafka_messages(B.clickstream(spark, sf), "user_id", "clickstream-raw")
    return parse_json(messages, schemas.CLICKSTREAM, "clickstream-raw", AS_OF).select(
        "kafka_offset", "kafka_partition", "kafka_key", "_parse_error", "event_type", "page", "scroll_depth_pct",
        "duration_seconds", "is_adult_product", "year", "month", "day", "_source_topic",
        F.when(~F.col("_parse_error"), F.col("event_id")).alias("event_id")).select(
        "kafka_offset", "kafka_partition", "kafka_key", "_parse_error", "event_id", "year", "month", "day",
        "_source_topic", *[F.when(~F.col("_parse_error"), F.col(c)).alias(c) for c in (
            "event_type", "page", "scroll_depth_pct", "duration_seconds", "is_adult_product")])


@query
def bronze_parse_payments(spark, sf):
    messages = B.kafka_messages(B.payments(spark, sf), "transaction_id", "payments-raw")
    bronze = parse_json(messages, schemas.PAYMENTS, "payments-raw", AS_OF)
    return bronze.groupBy("_parse_error").agg(
        F.count(F.lit(1)).alias("messages"), F.count_if(F.col("_raw_json").isNull()).alias("empty_messages"),
        F.count_if(~F.col("_parse_error") & F.col("amount").isNull()).alias("missing_amounts"))


@query
def incremental_slice(spark, sf):
    source = B.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    target = source.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp"))
    return readers.newer_rows(source, target, "ts").select("event_id", "ts", "user_id", "value")


@query
def incremental_lookback(spark, sf):
    source = B.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return readers.lookback(source, "ts", "2024-01-30", 3).select("event_id", "ts", "user_id", "value")


@query
def source_readiness(spark, sf):
    """Rows per ingestion day, from which a job decides whether its day has arrived."""
    return B.payments(spark, sf).groupBy(F.to_date("ingested_at").alias("ingestion_day")).agg(
        F.count(F.lit(1)).alias("rows"))


# Payments.

@query
def payments_clean(spark, sf):
    return P.judge(clean(spark, sf)).select(
        "transaction_id", "user_id", "amount_eur", "currency_code", "event_timestamp", "event_date", "event_hour",
        "event_day_of_week", "time_of_day", "billing_country_iso", "shipping_country_iso", "ip_country_code",
        "is_cross_border", "ip_geo_mismatch", "user_is_minor", "reject_reason")


@query
def payments_dedup_latest(spark, sf):
    lines = B.table(spark, sf, "lineitem")
    order = [F.col("l_shipdate").desc(), F.col("l_partkey").desc(), F.col("l_suppkey").desc(),
             F.col("l_extendedprice").desc(), F.col("l_quantity").desc()]
    return dedup_latest(lines, ["l_orderkey", "l_linenumber"], order).select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")


@query
def payments_validity_split(spark, sf):
    return P.validity_counts(P.judge(clean(spark, sf)))


@query
def payments_quarantine(spark, sf):
    return P.split(clean(spark, sf))[1].select("transaction_id", "user_id", "amount", "currency_code", "reject_reason")


@query
def currency_conversion(spark, sf):
    """Daily rates derived from the nations; the table keeps the raw number where no rate is known."""
    rates = B.table(spark, sf, "orders").select(F.date_add(F.lit("2024-01-01").cast("date"), F.datediff(
        "o_orderdate", F.lit("1995-01-01").cast("date")) % 60).alias("rate_date")).distinct().select(
        "rate_date", F.explode(F.array(F.lit("USD"), F.lit("GBP"))).alias("currency_code")).withColumn(
        "rate", F.when(F.col("currency_code") == "USD", F.lit(0.9)).otherwise(1.2).cast("decimal(6,4)"))
    return P.convert(valid(spark, sf), rates).select("transaction_id", "currency_code", "amount_eur")


_MONTH = ["transaction_id", "user_id", "user_txn_count_30d", "user_avg_amount_30d", "user_amount_stddev_30d",
          "amount_vs_avg_ratio"]
_DISTINCT = {"user_distinct_countries_30d": "shipping_country_iso", "user_distinct_merchants_30d": "merchant_id"}

# What the heavy-key route reads besides the columns that it counts: it stores its rows, so it is given no others.
_SWEPT = ["transaction_id", "user_id", "event_timestamp", "amount_eur"]


@query
def user_rolling_30d(spark, sf):
    return P.trailing_month(valid(spark, sf), hot=heavy_users(spark, sf)).select(*_MONTH)


@query
def user_rolling_30d_swept(spark, sf):
    """The same figures with every user on the heavy-key route."""
    return P.trailing_month(valid(spark, sf).select(*_SWEPT), hot=ALL).select(*_MONTH)


@query
def user_distinct_30d(spark, sf):
    return P.trailing_month(valid(spark, sf), _DISTINCT, hot=heavy_users(spark, sf)).select(
        "transaction_id", *_DISTINCT)


@query
def user_distinct_30d_swept(spark, sf):
    return P.trailing_month(valid(spark, sf).select(*_SWEPT, *_DISTINCT.values()), _DISTINCT, hot=ALL).select(
        "transaction_id", *_DISTINCT)


@query
def velocity_5min_1h(spark, sf):
    purchases = B.table(spark, sf, "events").select(
        "event_id", "user_id", F.col("ts").cast("timestamp").alias("event_timestamp"))
    heavy = hot_keys(purchases.select("user_id"), "user_id")
    return P.velocity(P.velocity(purchases, 300, "events_5min", hot=heavy), 3_600, "events_1h", hot=heavy).drop(
        "event_timestamp")


@query
def first_transaction(spark, sf):
    return P.first_transaction(valid(spark, sf), hot=heavy_users(spark, sf)).select("transaction_id", "user_id", "is_first_transaction")


@query
def cross_border(spark, sf):
    return valid(spark, sf).groupBy("billing_country_iso", "shipping_country_iso", "is_cross_border").agg(
        F.count(F.lit(1)).alias("payments"), F.count_if("ip_geo_mismatch").alias("ip_mismatches"))


@query
def silver_payments(spark, sf):
    return P.build(B.payments(spark, sf), AS_OF, hot=heavy_users(spark, sf)).select(
        *[c for c in schemas.SILVER_PAYMENTS_COLUMNS if c not in (
            "is_new_card", "fraud_score_label", "silver_loaded_at", "pii_anonymized_at")],
        "product_id", "quantity", "status", "fraud_label")


@query
def incremental_refresh(spark, sf):
    """Late and new payments refresh the features they change; equal to a full rebuild on the affected rows."""
    # Old and new payments are read by several steps: stored once, with what the features read.
    everything = checkpointed(valid(spark, sf).select(*_SWEPT, "billing_country_iso", "merchant_id", "payment_method"))
    arriving = F.col("payment_method") == "paypal"
    return P.refresh(everything.filter(~arriving), everything.filter(arriving)).select(
        *_MONTH, "velocity_count_5min", "is_first_transaction", "user_distinct_merchants_30d")


@query
def upsert_latest(spark, sf):
    """Finished and open orders in the table; open and pending ones arrive, with a new price."""
    orders = B.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    existing = orders.filter(F.col("o_orderstatus").isin("F", "O"))
    incoming = orders.filter(F.col("o_orderstatus").isin("O", "P")).withColumn(
        "o_totalprice", F.col("o_totalprice") + 1)
    return tables.merged(existing, incoming, ["o_orderkey"])


# Sessions.

@query
def session_gap_30m(spark, sf):
    rows = B.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return sessions.sessionise(rows, "user_id", "ts", 1_800)


@query
def session_gap_30m_chunked(spark, sf):
    """The same sessions with every user on the heavy-key route."""
    rows = B.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return sessions.sessionise(rows, "user_id", "ts", 1_800, hot=ALL)


@query
def event_gaps_chunked(spark, sf):
    """The same pauses with every user on the heavy-key route."""
    rows = B.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return sessions.previous_event_gap(rows, "user_id", "ts", "event_id", hot=ALL).select("event_id", "gap_seconds")


@query
def silver_payments_swept(spark, sf):
    """All features of the payments table with every user on the heavy-key route."""
    return P.features(valid(spark, sf).select(*_SWEPT, "billing_country_iso", "merchant_id"), ALL).select(
        *_MONTH, "velocity_count_5min", "is_first_transaction", "user_distinct_countries_30d",
        "user_distinct_merchants_30d")


@query
def event_gaps(spark, sf):
    rows = B.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return sessions.previous_event_gap(rows, "user_id", "ts", "event_id").select("event_id", "gap_seconds")


@query
def clickstream_clean(spark, sf):
    return sessions.clean_events(B.clickstream(spark, sf)).select(
        "event_id", "event_timestamp", "event_date", "duration_seconds", "scroll_depth_pct", "device_category",
        "browser", "traffic_source")


@query
def device_class(spark, sf):
    return events(spark, sf).groupBy("device_category", "browser", "traffic_source", "canonical_type").agg(
        F.count(F.lit(1)).alias("events"))


@query
def session_metrics(spark, sf):
    return sessions.aggregate(events(spark, sf)).drop("entry_page", "exit_page")


@query
def session_entry_exit(spark, sf):
    return sessions.entry_exit(events(spark, sf))


@query
def silver_sessions(spark, sf):
    return silver_sessions_(spark, sf).drop("silver_loaded_at")


@query
def touched_sessions(spark, sf):
    return sessions.touched_sessions(B.clickstream(spark, sf), "2024-01-30", 3).groupBy("session_id").agg(
        F.count(F.lit(1)).alias("events"))


# Privacy and customers.

@query
def pseudonymise_crm(spark, sf):
    return silver_crm(spark, sf).select("user_id", "email_hashed", "phone_token", "postal_zone", "notes",
                                        "customer_segment", "pii_anonymized_at", "pii_anonymization_version")


@query
def crm_profile(spark, sf):
    return crm.profile(silver_crm(spark, sf))


@query
def mask_free_text(spark, sf):
    return B.table(spark, sf, "documents").select("doc_id", privacy.mask_text(F.col("text")).alias("masked"))


@query
def pii_leak_check(spark, sf):
    return privacy.leak_check(B.table(spark, sf, "documents").select("doc_id", "text", "lang", "source"), "doc_id")


@query
def gdpr_erase(spark, sf):
    """Customers in debt asked for erasure; their orders and customer rows change together."""
    people = B.table(spark, sf, "customer").select(
        B.user("c_custkey").alias("user_id"), S.surrogate_key(B.user("c_custkey")).alias("customer_key"), "c_acctbal")
    orders = B.table(spark, sf, "orders").select(
        B.user("o_custkey").alias("user_id"), S.surrogate_key(B.user("o_custkey")).alias("customer_key"),
        "o_orderkey", "o_totalprice")
    erased, _ = privacy.erase({"dim_customers": people, "fact_orders": orders},
                              people.filter("c_acctbal < 0"), B.SALT, AS_OF)
    return erased["fact_orders"]


@query
def gdpr_receipts(spark, sf):
    people = B.table(spark, sf, "customer").select(B.user("c_custkey").alias("user_id"), "c_acctbal")
    orders = B.table(spark, sf, "orders").select(B.user("o_custkey").alias("user_id"), "o_orderkey")
    _, receipts = privacy.erase({"dim_customers": people, "fact_orders": orders},
                                people.filter("c_acctbal < 0"), B.SALT, AS_OF)
    return receipts


@query
def privacy_violations(spark, sf):
    rows = B.crm(spark, sf)
    minors = privacy.minors_with_image(rows).select("user_id", F.lit("minor_with_image").alias("violation"))
    early = privacy.consent_before_registration(rows).select("user_id", F.lit("consent_too_early").alias("violation"))
    return minors.unionByName(early)


# Gold.

@query
def dim_date(spark, sf):
    bounds = B.table(spark, sf, "orders").agg(F.to_date(F.min("o_orderdate")).alias("a"),
                                              F.to_date(F.max("o_orderdate")).alias("b"))
    return gold.dim_date_of(bounds)


@query
def dim_customers_rfm(spark, sf):
    return gold.dim_customers(silver_crm(spark, sf), curated(spark, sf), silver_sessions_(spark, sf), AS_OF)


@query
def rfm_tiles_sorted(spark, sf):
    """Tiles of all orders by price from the distributed sort that replaces the single-task window."""
    orders = B.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return add_ntiles(orders, "o_orderkey", {"price_tile": [F.col("o_totalprice"), F.col("o_orderkey")]}).select("o_orderkey", "price_tile")


@query
def dim_products(spark, sf):
    return gold.dim_products(B.products(spark, sf))


@query
def dim_merchants(spark, sf):
    return gold.dim_merchants(B.merchants(spark, sf))


@query
def fact_orders(spark, sf):
    return facts(spark, sf, rows=stored_payments(spark, sf)).drop("is_new_card", "fraud_score_label", "geo_distance_km", "status")


@query
def kpi_daily(spark, sf):
    return gold.kpi_daily(facts(spark, sf))


@query
def feature_store(spark, sf):
    return labelled_features(spark, sf, stored_payments(spark, sf)).drop(
        "is_new_card", "fraud_score_label", "geo_distance_km", "event_timestamp")


@query
def referential_integrity(spark, sf):
    """The dimensions lack the smallest parts and the customers in debt, so that orphans exist."""
    parts = B.table(spark, sf, "part").filter("p_size > 1").select(
        S.surrogate_key(B.padded("PROD-", F.col("p_partkey"), 6)).alias("product_key"))
    people = B.table(spark, sf, "customer").filter("c_acctbal >= 0").select(
        S.surrogate_key(B.user("c_custkey")).alias("customer_key"))
    return gold.referential_integrity(facts(spark, sf), people, parts)


# Quality.

def to_check(spark, sf):
    return curated(spark, sf).withColumn("pii_anonymized_at", S.as_timestamp(AS_OF))


@query
def dq_payments_suite(spark, sf):
    return quality.run_suite(to_check(spark, sf), quality.payments_suite(AS_OF))


def stored_checks(spark, sf):
    """The folder with the results and failing rows of the payments suite."""
    folder = scratch(spark, "quality")
    rows = checkpointed(to_check(spark, sf))
    quality.store_results(rows, quality.payments_suite(AS_OF), "payments", folder, "2024-03-01")
    return folder


@query
def dq_stored_results(spark, sf):
    return spark.read.parquet(f"{stored_checks(spark, sf)}/results").select("rule", "severity", "failed", "total", "status")


@query
def dq_stored_failures(spark, sf):
    """How many stored rows break each rule."""
    found = spark.read.parquet(f"{stored_checks(spark, sf)}/failures")
    return found.select(F.explode("broken_rules").alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("rows"))


@query
def dq_sessions_suite(spark, sf):
    return quality.run_suite(silver_sessions_(spark, sf), quality.sessions_suite())


@query
def dq_suite(spark, sf):
    return quality.run_suite(B.crm(spark, sf), quality.crm_suite())


@query
def dq_failing_rows(spark, sf):
    return quality.failing_rows(B.crm(spark, sf), quality.crm_suite()).select(
        "user_id", F.array_join("broken_rules", ",").alias("broken_rules"))


@query
def dq_duplicates(spark, sf):
    return quality.duplicates(B.payments(spark, sf), "transaction_id")


@query
def dq_freshness(spark, sf):
    at = "2024-02-29 12:00:00"
    limits = quality.FRESHNESS_LIMITS
    return (
        quality.freshness(B.payments(spark, sf), "ingested_at", at, *limits["bronze.payments"], "bronze.payments")
        .unionByName(quality.freshness(B.clickstream(spark, sf), "ingested_at", at, *limits["bronze.clickstream"],
                                       "bronze.clickstream"))
        .unionByName(quality.freshness(B.crm(spark, sf), "ingested_at", at, *limits["bronze.crm"], "bronze.crm"))
    )


# Fraud.

@query
def fraud_rules(spark, sf):
    return rule_hits(spark, sf)[1]


@query
def rule_score(spark, sf):
    return fraud.rule_scores(rule_hits(spark, sf)[1])


@query
def fact_fraud_scores(spark, sf):
    return scores(spark, sf).drop("geo_distance_km")


@query
def ip_reputation(spark, sf):
    return fraud.ip_reputation(valid(spark, sf)).groupBy("ip_type", "is_tor", "is_vpn", "is_suspicious").agg(
        F.count(F.lit(1)).alias("payments"))


@query
def geo_distance(spark, sf):
    return valid(spark, sf).select("transaction_id", S.round_to(S.country_distance_km(
        F.col("ip_country_code"), F.col("shipping_country_iso")), 1).alias("geo_distance_km"))


@query
def country_mismatch(spark, sf):
    return fraud.country_mismatch(valid(spark, sf), parcels(spark, sf).withColumn(
        "delivery_country", F.when(F.col("is_delayed"), F.lit("NG")).otherwise(F.col("delivery_country"))))


@query
def payment_without_session(spark, sf):
    return fraud.without_session(valid(spark, sf), silver_sessions_(spark, sf), 21_600)


@query
def decision_mix(spark, sf):
    return bi.decision_mix(scores(spark, sf))


@query
def score_histogram(spark, sf):
    return bi.score_histogram(scores(spark, sf))


@query
def review_queue(spark, sf):
    return bi.review_queue(scores(spark, sf))


@query
def fraud_monitor(spark, sf):
    return bi.fraud_monitor(scores(spark, sf))


@query
def blocked_trend(spark, sf):
    return bi.blocked_trend(scores(spark, sf))


@query
def fraud_alerts(spark, sf):
    return fraud.alerts(scores(spark, sf)).select("transaction_id", "fraud_probability", "fraud_decision")


@query
def blocked_per_hour(spark, sf):
    return fraud.blocked_per_hour(scores(spark, sf))


@query
def distance_vs_score(spark, sf):
    return bi.distance_vs_score(scores(spark, sf))


# Clickstream reports.

@query
def funnel_steps(spark, sf):
    return funnel.funnel(typed_events(spark, sf))


@query
def abandonment(spark, sf):
    return funnel.abandonment(typed_events(spark, sf))


@query
def attribution(spark, sf):
    return funnel.attribution(typed_events(spark, sf))


@query
def cart_without_view(spark, sf):
    return funnel.cart_without_view(typed_events(spark, sf))


@query
def multi_device_users(spark, sf):
    return funnel.multi_device_users(typed_events(spark, sf))


@query
def bot_rate(spark, sf):
    return funnel.bot_rate(typed_events(spark, sf))


@query
def kyc_events(spark, sf):
    return funnel.kyc_events(typed_events(spark, sf))


# Logistics.

@query
def carrier_kpis(spark, sf):
    return logistics.carrier_kpis(parcels(spark, sf))


@query
def zone_delays(spark, sf):
    return logistics.zone_delays(parcels(spark, sf))


@query
def delay_reasons(spark, sf):
    return logistics.delay_reasons(parcels(spark, sf))


@query
def critical_stock(spark, sf):
    return logistics.critical_stock(parcels(spark, sf))


@query
def status_latest(spark, sf):
    return logistics.latest_status(parcels(spark, sf))


@query
def status_transitions(spark, sf):
    return logistics.transitions(parcels(spark, sf))


@query
def delivery_sla(spark, sf):
    return logistics.delivery_sla(parcels(spark, sf))


@query
def status_funnel(spark, sf):
    return logistics.status_funnel(parcels(spark, sf))


@query
def delivery_matrix(spark, sf):
    return logistics.delivery_matrix(parcels(spark, sf))


@query
def returns_trend(spark, sf):
    return logistics.returns_trend(parcels(spark, sf))


# Commercial reports.

@query
def bi_revenue(spark, sf):
    return bi.revenue(facts(spark, sf))


@query
def bi_mom(spark, sf):
    orders = B.table(spark, sf, "orders").select(
        F.to_date("o_orderdate").alias("event_date"), F.col("o_totalprice").cast("decimal(12,2)").alias("amount_eur"))
    return bi.monthly_growth(orders)


@query
def bi_retention(spark, sf):
    return bi.retention(facts(spark, sf))


@query
def bi_top10(spark, sf):
    return bi.top_merchants(facts(spark, sf), gold.dim_merchants(B.merchants(spark, sf)))


@query
def bi_category(spark, sf):
    return bi.by_category(facts(spark, sf))


@query
def bi_country(spark, sf):
    return bi.by_country(facts(spark, sf))


@query
def bi_vip(spark, sf):
    return bi.vip_customers(facts(spark, sf))


# Identity documents.

def checked_documents(spark, sf):
    return kyc.extract(kyc.assemble(B.document_words(spark, sf)), AS_OF)


@query
def kyc_extract(spark, sf):
    return checked_documents(spark, sf)


@query
def kyc_counters(spark, sf):
    return kyc.counters(checked_documents(spark, sf))


@query
def kyc_updates(spark, sf):
    return kyc.updates(silver_crm(spark, sf), checked_documents(spark, sf)).select(
        "user_id", "id_verification_status")


@query
def kyc_status_lookup(spark, sf):
    """Every ordering user asks for their status."""
    asking = B.table(spark, sf, "orders").select(
        F.when(F.col("o_totalprice") < 5_000, "USR-UNKNOWN").otherwise(B.user("o_custkey")).alias("user_id"))
    return kyc.status_lookup(asking, silver_crm(spark, sf))


@query
def document_claims(spark, sf):
    """The ledger after four runs of 50 over one document per customer: the first finishes, the second dies, the third
    takes others, the fourth comes after the lease and takes the oldest that are free, those of the second among them."""
    folder = f"{scratch(spark, 'claims')}/ledger"
    key = F.col("c_custkey")
    files = B.table(spark, sf, "customer").select(
        F.concat(B.user("c_custkey"), F.lit("/id.jpg")).alias("path"),
        F.timestamp_seconds(F.unix_timestamp(S.as_timestamp(B.EPOCH)) + key * 7_919 % 997).alias("modificationTime"))
    claims.finish(spark, claims.claim(spark, files, folder, "run-1", "2024-03-01 01:00:00"), folder, "run-1",
                  "2024-03-01 01:30:00")
    claims.claim(spark, files, folder, "run-2", "2024-03-01 02:00:00")
    claims.claim(spark, files, folder, "run-3", "2024-03-01 06:00:00")
    claims.claim(spark, files, folder, "run-4", "2024-03-01 09:00:00", batch=70)
    return claims.ledger(spark, folder)


# Model.

def labelled(spark, sf):
    return labelled_features(spark, sf)


@query
def class_balance(spark, sf):
    return ml.class_balance(ml.prepare(labelled(spark, sf)))


@query
def ml_time_split(spark, sf):
    return ml.time_split(labelled(spark, sf), AS_OF).groupBy("part").agg(F.count(F.lit(1)).alias("payments"))


@query
def ml_split(spark, sf):
    rows = ml.split(ml.prepare(labelled(spark, sf)))
    return rows.groupBy(ml.LABEL, "is_test").agg(F.count(F.lit(1)).alias("payments"))


@query
def ml_train_score(spark, sf):
    """Train on the labelled payments with all trees and score all of them. Features are written once, training reads them often:
    only what it reads is written."""
    rows = labelled(spark, sf)
    features = checkpointed(rows.select(*ml.read_columns(rows)))
    model, _ = ml.train(features)
    return ml.score(model, features, AS_OF, "gbt-1").select(
        "transaction_id", "fraud_probability", "fraud_decision", "scored_at", "model_version")


@query
def ml_gate(spark, sf):
    """Confusion metrics and promotion of the rule score as a classifier of the labelled fraud."""
    scored = scores(spark, sf).withColumn(ml.LABEL, F.col("confirmed_fraud").cast("double"))
    return ml.gate(ml.confusion(scored))


@query
def ml_medians(spark, sf):
    """What fills gaps of the model's numbers."""
    return training.medians(ml.prepare(labelled(spark, sf)), [c for c in C.NUMERIC_FEATURES if c != "geo_distance_km"])


@query
def ml_codes(spark, sf):
    return training.codes(ml.prepare(labelled(spark, sf)), C.CATEGORICAL_FEATURES)


@query
def ml_parts(spark, sf):
    rows = training.three_parts(ml.prepare(labelled(spark, sf)))
    return rows.groupBy(ml.LABEL, "part").agg(F.count(F.lit(1)).alias("payments"))


def rule_curve(spark, sf):
    return training.precision_recall(scores(spark, sf).withColumn(ml.LABEL, F.col("confirmed_fraud").cast("double")))


@query
def ml_precision_recall(spark, sf):
    """Precision and recall of the rule score at each of its values."""
    return rule_curve(spark, sf).select("threshold", "flagged", "hits", S.round_to(F.col("precision"), 6).alias("precision"),
                                        S.round_to(F.col("recall"), 6).alias("recall"))


@query
def ml_ranking_metrics(spark, sf):
    return training.ranking_metrics(rule_curve(spark, sf))


# Streams: the tables replayed as file streams, all available input, then read back.

def scratch(spark: SparkSession, name: str) -> str:
    """A new folder next to the checkpoints, which every executor can reach."""
    checkpointed(spark.range(1))
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def drained(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    return emitted(spark, df, name)[0]


def emitted(spark: SparkSession, df: DataFrame, name: str) -> tuple[DataFrame, object]:
    """What a stream over all available input has emitted, and the last watermark of its progress ledger."""
    base = scratch(spark, name)
    running = jobs.start_append(df, f"{base}/out", f"{base}/checkpoint", partition=(), name=name)
    running.awaitTermination()
    jobs.record(spark, running, f"{base}/ledger")
    return spark.read.schema(df.schema).parquet(f"{base}/out"), jobs.last_watermark(spark, f"{base}/ledger", name)


def timed_events(spark, sf):
    """The rows of `timed_stream` as a stored table."""
    return B.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def timed_stream(spark, sf):
    return B.event_stream(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))


@query
def stream_bronze(spark, sf):
    messages = B.kafka_messages(B.clickstream_of(B.event_stream(spark, sf)), "user_id", "clickstream-raw")
    bronze = jobs.to_bronze(messages, "clickstream-raw").select(
        "kafka_offset", "kafka_key", "_parse_error", F.when(~F.col("_parse_error"), F.col("event_id")).alias(
            "event_id"))
    return drained(spark, bronze, "bronze")


@query
def stream_dedup(spark, sf):
    """Every event delivered twice, kept once."""
    once = timed_stream(spark, sf).select("event_id", "ts", "user_id")
    return drained(spark, jobs.deduplicated(once.union(once), "event_id", "ts"), "dedup")


@query
def stream_velocity(spark, sf):
    closed, mark = emitted(spark, jobs.sliding_velocity(timed_stream(spark, sf), "user_id", "ts"), "velocity")
    return jobs.complete_windows(closed, timed_events(spark, sf), "ts", "5 minutes", mark,
                                 lambda rows: jobs.sliding_velocity(rows, "user_id", "ts"), F.col("window_end"))


@query
def stream_velocity_exact(spark, sf):
    return drained(spark, jobs.exact_velocity(timed_stream(spark, sf), "user_id", "ts", "event_id"), "exact")


@query
def stream_sessions(spark, sf):
    closed, _ = emitted(spark, jobs.session_stream(timed_stream(spark, sf), "user_id", "ts"), "sessions")
    return jobs.complete_sessions(closed, timed_events(spark, sf), "user_id", "ts")


def scored_purchases(events):
    """Purchases scored by their amount: a stand-in for model output on the stream."""
    purchases = events.filter(F.col("event_type") == "purchase")
    return purchases.withColumn("fraud_probability", F.least(F.col("value") / 100, F.lit(1.0))).withColumn(
        "fraud_decision", S.decide(F.col("fraud_probability")))


@query
def stream_alerts(spark, sf):
    return drained(spark, jobs.alerts(scored_purchases(timed_stream(spark, sf))).select(
        "event_id", "user_id", "fraud_probability", "fraud_decision"), "alerts")


@query
def stream_blocked_hourly(spark, sf):
    def blocked(events):
        return jobs.blocked_hourly(scored_purchases(events), "ts", limit=1)

    closed, mark = emitted(spark, blocked(timed_stream(spark, sf)), "blocked")
    return jobs.complete_windows(closed, timed_events(spark, sf), "ts", "1 hour", mark, blocked,
                                 F.col("hour") + F.expr("INTERVAL 1 HOUR"))


# Payments scored from messages in three micro-batches; the result is that of a run over all rows.

_SCORED: dict[tuple[str, str], str] = {}
ALL_FILES = 1_000_000_000


def score_messages(spark, sf):
    """The folder of one scoring job over all messages; the queries of one application share its tables."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _SCORED:
        base = scratch(spark, "scoring")
        parts = 3
        B.payment_messages(spark, sf, base, parts)
        for part in range(parts):  # a micro-batch each, of many files that tasks share
            B.deliver(spark, base, part)
            running = scoring.start(streams.files(spark, f"{base}/topic", ALL_FILES), f"{base}/tables", f"{base}/checkpoint",
                                    watermark_seconds=600)
            running.awaitTermination()
        _SCORED[key] = f"{base}/tables"
    return _SCORED[key]


@query
def stream_score(spark, sf):
    """Every payment of the topic with its features, rule score and decision."""
    return scoring.scores(spark, score_messages(spark, sf)).select(
        *_MONTH, "velocity_count_5min", "is_first_transaction", "user_distinct_countries_30d",
        "user_distinct_merchants_30d", "rules_hit", "fraud_probability", "fraud_decision")


@query
def stream_late_rows(spark, sf):
    """Messages behind the watermark of the micro-batches before theirs, and the micro-batch they came in."""
    return scoring.late(spark, score_messages(spark, sf)).select("transaction_id", "event_timestamp", "batch_id")


@query
def stream_progress(spark, sf):
    """What each micro-batch took in, rejected and scored."""
    return scoring.progress(spark, score_messages(spark, sf)).select(
        "batch_id", "rows_in", "unreadable", "valid", "rejected", "late")


# Stored tables with manifests: what is read back after changes equals a rebuild.

def stored_orders(spark, sf):
    """Orders by month, then a correction that moves and removes some; the folder of the table."""
    path = f"{scratch(spark, 'orders')}/table"
    rows = B.table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    snapshots.upsert(spark, rows, path, ["o_orderkey"], "month", ["o_orderkey"])
    moved = rows.filter("o_orderstatus = 'P'").withColumns({"o_totalprice": F.col("o_totalprice") + 1, "month": F.lit("1999-01")})
    gone = rows.filter("o_orderstatus = 'F' and o_orderkey % 10 = 0")
    snapshots.upsert(spark, moved, path, ["o_orderkey"], "month", ["o_orderkey"], removed=gone)
    return path


@query
def upsert_on_disk(spark, sf):
    return snapshots.read(spark, stored_orders(spark, sf))


@query
def upsert_changed_partitions(spark, sf):
    """The months that the correction rewrote; all others were not touched."""
    return snapshots.changed(spark, stored_orders(spark, sf), 1).select(F.col("value").alias("month"), "gone")


@query
def fact_orders_incremental(spark, sf):
    """Facts rebuilt only for the days that a late delivery changed; read back they equal a rebuild of everything."""
    base = scratch(spark, "facts")
    paid = valid(spark, sf)
    read = {*schemas.SILVER_PAYMENTS_COLUMNS, *schemas.SILVER_PAYMENTS_EXTRA, *fraud.JUDGED}
    rows = checkpointed(paid.select(*[c for c in paid.columns if c in read and c != "reject_reason"]))
    first, second = rows.filter("payment_method <> 'paypal'"), rows.filter("payment_method = 'paypal'")

    def silver(featured):
        return P.curated(featured.withColumn("reject_reason", F.lit(None).cast("string")), AS_OF)

    def facts_of(paid):
        return facts_from(spark, sf, paid)

    snapshots.upsert(spark, silver(P.enrich(first)), f"{base}/silver", ["transaction_id"], "event_date", ["user_id"])
    snapshots.refresh(spark, f"{base}/silver", f"{base}/facts", "event_date", facts_of, ["user_id"])
    snapshots.upsert(spark, silver(P.refresh(first, second)), f"{base}/silver", ["transaction_id"], "event_date", ["user_id"])
    snapshots.refresh(spark, f"{base}/silver", f"{base}/facts", "event_date", facts_of, ["user_id"])
    return snapshots.read(spark, f"{base}/facts").drop("is_new_card", "fraud_score_label", "geo_distance_km", "status")
