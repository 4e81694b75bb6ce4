"""Data-quality suites: all row rules of a suite in one aggregation pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake import constants as C
from bazaarlake.functions import scalars as S


@dataclass(frozen=True)
class Rule:
    """A rule holds a condition that is true for a failing row, or a check of the whole table."""

    name: str
    failing: Column | None = None
    unique: str | None = None
    columns_present: tuple[str, ...] = ()
    columns_absent: tuple[str, ...] = ()
    rows_between: tuple[int, int] | None = None
    max_between: tuple[str, str, str] | None = None
    severity: str = "error"


def _only(condition: Column, where: Column | None) -> Column:
    return condition if where is None else condition & where


def not_null(column: str, severity: str = "error") -> Rule:
    return Rule(f"not_null_{column}", F.col(column).isNull(), severity=severity)


def unique(column: str, severity: str = "error") -> Rule:
    return Rule(f"unique_{column}", unique=column, severity=severity)


def accepted_values(column: str, values: list, where: Column | None = None, severity: str = "error") -> Rule:
    return Rule(f"accepted_values_{column}", _only(~F.col(column).isin(values), where), severity=severity)


def accepted_range(column: str, low=None, high=None, where: Column | None = None, severity: str = "error") -> Rule:
    outside = F.lit(False)
    if low is not None:
        outside = outside | (F.col(column) < low)
    if high is not None:
        outside = outside | (F.col(column) > high)
    return Rule(f"accepted_range_{column}", _only(outside, where), severity=severity)


def expression_is_true(name: str, condition: Column, severity: str = "error") -> Rule:
    return Rule(name, ~F.coalesce(condition, F.lit(False)), severity=severity)


def matches(column: str, pattern: str, severity: str = "error") -> Rule:
    return Rule(f"matches_{column}", ~F.col(column).rlike(pattern), severity=severity)


def length_equals(column: str, length: int, severity: str = "error") -> Rule:
    return Rule(f"length_{column}", F.length(column) != length, severity=severity)


def column_exists(column: str, severity: str = "error") -> Rule:
    return Rule(f"column_exists_{column}", columns_present=(column,), severity=severity)


def column_absent(column: str, severity: str = "error") -> Rule:
    return Rule(f"column_absent_{column}", columns_absent=(column,), severity=severity)


def row_count_between(low: int, high: int = 2**63 - 1, severity: str = "error") -> Rule:
    return Rule("row_count_between", rows_between=(low, high), severity=severity)


def max_between(column: str, low: str, high: str, severity: str = "error") -> Rule:
    return Rule(f"max_between_{column}", max_between=(column, low, high), severity=severity)


def run_suite(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """(rule, severity, failed, total, status) per rule.

    Row, volume and recency rules share one aggregation. Each uniqueness rule adds one aggregate by its key, since
    it needs that shuffle; it counts the rows that share a key.
    """
    aggregates, cells = [F.count(F.lit(1)).alias("total")], []
    for i, rule in enumerate(rules):
        slot = f"r{i}"
        if rule.failing is not None:
            aggregates.append(F.count_if(F.coalesce(rule.failing, F.lit(False))).alias(slot))
            failed = F.col(slot)
        elif rule.rows_between:
            low, high = rule.rows_between
            failed = F.when(F.col("total").between(low, high), 0).otherwise(1)
        elif rule.max_between:
            column, low, high = rule.max_between
            aggregates.append(F.max(column).alias(slot))
            inside = F.col(slot).between(F.lit(low).cast("timestamp"), F.lit(high).cast("timestamp"))
            failed = F.when(F.coalesce(inside, F.lit(False)), 0).otherwise(1)
        elif rule.unique:
            continue
        else:
            missing = [c for c in rule.columns_present if c not in df.columns]
            present = [c for c in rule.columns_absent if c in df.columns]
            failed = F.lit(len(missing) + len(present))
        cells.append(F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.severity).alias("severity"),
                              failed.cast("bigint").alias("failed"), F.col("total").alias("total")))
    parts = []
    if cells:
        parts.append(df.agg(*aggregates).select(F.inline(F.array(*cells))))
    for rule in rules:
        if rule.unique:
            per_key = df.filter(F.col(rule.unique).isNotNull()).groupBy(rule.unique).agg(
                F.count(F.lit(1)).alias("_n"))
            parts.append(per_key.agg(
                F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).cast("bigint").alias("failed"),
                F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("total"),
            ).select(F.lit(rule.name).alias("rule"), F.lit(rule.severity).alias("severity"), "failed", "total"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("status", F.when(F.col("failed") == 0, "pass").when(F.col("severity") == "warn", "warn")
                          .otherwise("fail"))


def failing_rows(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows that break at least one row rule, with the names of the rules they break, for a failures table."""
    broken = F.array_compact(F.array(*[
        F.when(F.coalesce(r.failing, F.lit(False)), F.lit(r.name)) for r in rules if r.failing is not None]))
    return df.withColumn("broken_rules", broken).filter(F.size("broken_rules") > 0)


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def freshness(df: DataFrame, loaded_at: str, as_of, warn_hours: float, error_hours: float, source: str) -> DataFrame:
    """Age of the newest row against two limits; an empty table is an error."""
    age = (F.unix_timestamp(S.as_timestamp(as_of)) - F.unix_timestamp(F.max(loaded_at))) / 3600.0
    return df.agg(F.max(loaded_at).alias("newest"), age.alias("age_hours")).select(
        F.lit(source).alias("source"), "newest", "age_hours",
        F.when(F.col("age_hours").isNull() | (F.col("age_hours") > error_hours), "error")
        .when(F.col("age_hours") > warn_hours, "warn").otherwise("pass").alias("status"),
    )


class QualityError(RuntimeError):
    pass


def enforce(results: DataFrame) -> list:
    """Raise when an error-level rule failed. The result has one row per rule, so collecting it is safe."""
    failed = [row["rule"] for row in results.filter(F.col("status") == "fail").collect()]
    if failed:
        raise QualityError("failed rules: " + ", ".join(sorted(failed)))
    return failed


def store_results(df: DataFrame, rules: list[Rule], suite: str, folder: str, run_date: str) -> DataFrame:
    """Run a suite and store what it found below `folder`; returns the results.

    `results` has one row per rule. `failures` has one row per row that breaks a rule of single rows, with the rules and
    the row as JSON, and one row per key that breaks a uniqueness rule. Both are partitioned by suite and run date, and a
    suite that runs again for a date replaces what it stored for it. Rows are masked before they get here: the suites
    read curated tables.
    """
    part = f"suite={suite}/run_date={run_date}"
    run_suite(df, rules).write.mode("overwrite").parquet(f"{folder}/results/{part}")
    found = failing_rows(df, rules).select("broken_rules", F.to_json(F.struct(*df.columns)).alias("row"))
    for rule in rules:
        if rule.unique:
            found = found.unionByName(duplicates(df, rule.unique).select(
                F.array(F.lit(rule.name)).alias("broken_rules"), F.to_json(F.struct(rule.unique, "rows")).alias("row")))
    found.write.mode("overwrite").parquet(f"{folder}/failures/{part}")
    return df.sparkSession.read.parquet(f"{folder}/results/{part}")


def payments_suite(as_of: str) -> list[Rule]:
    known = {c: F.col(c).isNotNull() for c in ("user_kyc_status", "user_age", "user_avg_amount_30d",
                                               "fraud_score_label")}
    return [
        not_null("transaction_id"), unique("transaction_id"), not_null("user_id"), not_null("amount_eur"),
        accepted_range("amount_eur", 0.01, 99999), not_null("currency_code"),
        accepted_values("currency_code", C.CURRENCIES), not_null("event_timestamp"), not_null("event_date"),
        accepted_range("event_hour", 0, 23), accepted_values("time_of_day", C.TIMES_OF_DAY),
        not_null("billing_country_iso"), length_equals("billing_country_iso", 2),
        length_equals("shipping_country_iso", 2),
        accepted_values("user_kyc_status", C.KYC_STATUSES, known["user_kyc_status"]),
        accepted_range("user_age", 0, 120, known["user_age"]), not_null("user_txn_count_30d"),
        accepted_range("user_txn_count_30d", 1), accepted_range("user_avg_amount_30d", 0.01, None,
                                                                known["user_avg_amount_30d"]),
        accepted_range("user_distinct_countries_30d", 1),
        accepted_range("fraud_score_label", 0.0, 1.0, known["fraud_score_label"]), not_null("ingested_at"),
        Rule("event_timestamp_between", (F.col("event_timestamp") < F.lit("2020-01-01").cast("timestamp"))
             | (F.col("event_timestamp") > S.as_timestamp(as_of))),
        not_null("pii_anonymized_at", "warn"), not_null("silver_loaded_at"), column_absent("email"),
        column_absent("first_name"), column_exists("pii_anonymized_at"), row_count_between(1),
        max_between("event_timestamp", "2020-01-01", as_of),
    ]


def sessions_suite() -> list[Rule]:
    return [
        not_null("session_id"), unique("session_id"), not_null("user_id"),
        accepted_values("device_category", C.DEVICE_CATEGORIES), accepted_values("traffic_source", C.TRAFFIC_SOURCES),
        not_null("session_start"), not_null("session_end"), not_null("session_date"),
        not_null("session_duration_seconds"), accepted_range("session_duration_seconds", C.MIN_SESSION_SECONDS),
        not_null("total_events"), accepted_range("total_events", C.MIN_SESSION_EVENTS),
        accepted_range("max_scroll_depth", 0, 100, F.col("max_scroll_depth").isNotNull()),
        not_null("engagement_score"), accepted_range("engagement_score", 0.0, 1.0), not_null("ingested_at"),
        not_null("silver_loaded_at"),
    ]


def crm_suite() -> list[Rule]:
    return [
        not_null("user_id"), unique("user_id"), matches("user_id", "^USR-[0-9]{6}$"), accepted_range("age", 0, 120),
        accepted_values("customer_segment", C.SEGMENTS),
        accepted_values("id_verification_status", C.KYC_STATUSES, severity="warn"),
        accepted_range("total_spent_eur", 0, severity="warn"),
        expression_is_true("consent_after_registration",
                           F.col("gdpr_consent_date").isNull() | (F.col("gdpr_consent_date") >= F.col(
                               "registration_date")), "warn"),
        expression_is_true("minor_without_image",
                           ~(F.col("is_minor") & F.col("id_document_image_path").isNotNull()), "warn"),
    ]


# Freshness limits in hours (warn, error) per table.
FRESHNESS_LIMITS = {
    "bronze.payments": (2, 6), "bronze.clickstream": (1, 4), "bronze.crm": (25, 48), "silver": (26, 50),
}
