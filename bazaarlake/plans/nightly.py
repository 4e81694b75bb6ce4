"""The nightly run: raw day to curated tables to star schema, as one Spark application."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.functions import scalars as S
from bazaarlake.operators import crm as crm_ops
from bazaarlake.operators import fraud, gold, kyc, payments, quality, sessions, tables
from bazaarlake.session import checkpointed
from bazaarlake.sources import claims
from bazaarlake.sources.readers import Registry, is_ready, of_day


class NotReady(RuntimeError):
    pass


def judged_rows(registry: Registry, rows: DataFrame, suite: str, rules: list[quality.Rule] | None, run_date: str) -> DataFrame:
    """`rows`, computed once. With rules the suite runs over them first, and an error-level failure raises: what has not
    passed is not published. Results and failing rows are stored either way."""
    if rules is None:
        return rows
    staged = checkpointed(rows)
    quality.enforce(quality.store_results(staged, rules, suite, f"{registry.base}/quality", run_date))
    return staged


def run_payments(spark: SparkSession, registry: Registry, run_date: str, as_of: str,
                 rules: list[quality.Rule] | None = None) -> dict[str, int]:
    """One ingestion day of payments: clean, keep latest, quarantine, refresh features, upsert.

    Features of older payments inside the 30-day reach of new ones are recomputed with them, so the result equals a
    rebuild from all history. A payment whose newest version is rejected leaves the curated tables.
    """
    day = of_day(registry.read(spark, "bronze.payments"), run_date)
    judged = payments.judge(payments.clean(payments.latest(day)))
    quarantine = registry.path("quarantine.payments")
    valid, kept, rejected = tables.write_split(judged, quarantine, run_date)
    withdrawn = spark.read.schema(judged.schema).parquet(f"{quarantine}/run_date={run_date}").select("transaction_id")
    base_path = registry.path("silver.payments") + "_base"
    history_exists = tables.exists(spark, base_path)
    base = valid.drop("reject_reason")
    if history_exists:
        history = spark.read.option("mergeSchema", "true").parquet(base_path)
        featured = payments.refresh(history, base, withdrawn)
    else:
        featured = payments.enrich(base)
    curated = payments.curated(featured.withColumn("reject_reason", F.lit(None).cast("string")).withColumn(
        "pii_anonymized_at", F.lit(as_of).cast("timestamp")), as_of)
    curated = judged_rows(registry, curated, "payments", rules, run_date)
    for rows, path in ((curated, registry.path("silver.payments")), (base, base_path)):
        tables.upsert(spark, rows, path, ["transaction_id"], "event_date", ["user_id"], removed=withdrawn)
    return {"valid": kept, "rejected": rejected}


def run_clickstream(spark: SparkSession, registry: Registry, run_date: str) -> None:
    """Events of an ingestion day may carry any event date: every touched date is merged, the others stay."""
    events = sessions.clean_events(of_day(registry.read(spark, "bronze.clickstream"), run_date))
    tables.upsert(spark, events, registry.path("silver.clickstream"), ["event_id"], "event_date", ["user_id"])


def run_sessions(spark: SparkSession, registry: Registry, as_of: str, lookback_days: int = 3,
                 full_refresh: bool = False, rules: list[quality.Rule] | None = None, run_date: str | None = None) -> None:
    """Sessions with recent events, rebuilt whole; everything on the first run or on request."""
    bronze = registry.read(spark, "bronze.clickstream")
    first_run = not tables.exists(spark, registry.path("silver.sessions"))
    scope = bronze if full_refresh or first_run else sessions.touched_sessions(bronze, as_of, lookback_days)
    built = judged_rows(registry, sessions.build(scope, as_of), "sessions", rules, run_date or as_of[:10])
    tables.upsert(spark, built, registry.path("silver.sessions"), ["session_id"], "session_date", ["session_id"])


def run_documents(spark: SparkSession, registry: Registry, files: DataFrame, recognise: Callable[[DataFrame], DataFrame],
                  run: str, as_of: str, batch: int = 50) -> dict[str, int]:
    """One batch of identity documents: claim, read, decide, put the new status into the customers, finish.

    `recognise` turns the claimed files (`path`) into recognised words (doc_id, user_id, seq, word, conf). The claims are
    finished last, so a run that dies is repeated under its own name, or its files are given out again after the lease;
    the same decisions put the same status. Documents in which nothing is recognised are marked failed.
    """
    folder = f"{registry.base}/documents/claims"
    mine = checkpointed(claims.claim(spark, files, folder, run, as_of, batch))
    words = checkpointed(recognise(mine))
    checked = checkpointed(kyc.extract(kyc.assemble(words), as_of))
    news = kyc.updates(registry.read(spark, "silver.crm"), checked)
    tables.upsert(spark, news, registry.path("silver.crm"), ["user_id"], "customer_segment")
    read = mine.join(words.select("doc_id").distinct(), F.col("path") == F.col("doc_id"), "left_semi")
    claims.finish(spark, read, folder, run, as_of)
    claims.finish(spark, mine, folder, run, as_of, "failed")  # those that are still claimed
    return kyc.counters(checked).first().asDict()


def run_gold(spark: SparkSession, registry: Registry, as_of: str, catalogue: DataFrame,
             merchants: DataFrame) -> None:
    """Dimensions, facts, daily KPIs, feature store and rule-based fraud scores; facts are written once and read
    back for what builds on them."""
    paid, customers = registry.read(spark, "silver.payments"), registry.read(spark, "silver.crm")
    visits = registry.read(spark, "silver.sessions")
    products = gold.dim_products(catalogue)
    dims = gold.dim_customers(customers, paid, visits, as_of)
    tables.rebuild(spread_by(dims, "customer_segment"), registry.path("gold.dim_customers"))
    tables.rebuild(products, registry.path("gold.dim_products"))
    tables.rebuild(gold.dim_merchants(merchants), registry.path("gold.dim_merchants"))
    dates = gold.dim_date_of(paid.agg(F.min("event_date").alias("a"), F.max("event_date").alias("b")))
    tables.rebuild(dates, registry.path("gold.dim_date"))
    facts = gold.fact_orders(
        paid, registry.read(spark, "gold.dim_customers"), registry.read(spark, "gold.dim_products"),
        registry.read(spark, "gold.dim_date"), ("success", "blocked"))
    tables.rebuild(tables.spread(facts, "event_date", ["user_id"]), registry.path("gold.fact_orders"), ["event_date"])
    written = registry.read(spark, "gold.fact_orders")
    tables.rebuild(gold.kpi_daily(written.filter("status = 'success'")), registry.path("gold.kpi_daily"))
    tables.rebuild(gold.feature_store(written), registry.path("gold.fraud_feature_store"))
    tables.rebuild(tables.spread(fraud_scores(spark, registry), "event_date", ["user_id"]),
                   registry.path("gold.fact_fraud_scores"), ["event_date"])


def fraud_scores(spark: SparkSession, registry: Registry) -> DataFrame:
    """Every valid payment with its rule score; the rules need addresses and devices, which the curated table leaves out."""
    base = spark.read.option("mergeSchema", "true").parquet(registry.path("silver.payments") + "_base")
    enriched = checkpointed(payments.enrich(base))
    distance = S.country_distance_km(F.col("ip_country_code"), F.col("shipping_country_iso"))
    placed = enriched.withColumn("geo_distance_km", S.round_to(distance, 1))
    return fraud.fact_fraud_scores(placed, fraud.rule_scores(fraud.rules(enriched)))


def spread_by(df: DataFrame, column: str) -> DataFrame:
    """Cluster rows by a low-cardinality column; the user keeps a large segment from being one task."""
    return df.repartitionByRange(column, "user_id").sortWithinPartitions(column)


def run(spark: SparkSession, registry: Registry, run_date: str, as_of: str, salt: str, catalogue: DataFrame,
        merchants: DataFrame) -> dict[str, int]:
    """The whole night. `run_date` names the ingestion day and `as_of` the clock, so a rerun gives the same tables."""
    for name in ("bronze.payments", "bronze.clickstream", "bronze.crm"):
        if not is_ready(registry.read(spark, name), run_date):
            raise NotReady(f"{name} has no rows for {run_date}")
    counts = run_payments(spark, registry, run_date, as_of, quality.payments_suite(as_of))
    run_clickstream(spark, registry, run_date)
    run_sessions(spark, registry, as_of, rules=quality.sessions_suite(), run_date=run_date)
    people = checkpointed(crm_ops.build(of_day(registry.read(spark, "bronze.crm"), run_date), salt, as_of))
    tables.upsert(spark, people, registry.path("silver.crm"), ["user_id"], "customer_segment")
    run_gold(spark, registry, as_of, catalogue, merchants)
    facts = registry.read(spark, "gold.fact_orders")
    broken = gold.referential_integrity(facts, registry.read(spark, "gold.dim_customers"),
                                        registry.read(spark, "gold.dim_products"))
    if not broken.isEmpty():
        raise quality.QualityError("facts without customer or product")
    return counts
