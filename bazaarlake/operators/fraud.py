"""Fraud rules over valid payments, decisions and alerts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake import constants as C
from bazaarlake.functions import scalars as S
from bazaarlake.functions.timeline import trailing
from bazaarlake.operators import payments as P

# Weight of each rule in the combined score.
RULE_WEIGHTS = {
    "adult_product_minor": 0.90, "adult_product_kyc_bypass": 0.55, "velocity_attack": 0.60, "geo_mismatch": 0.70,
    "card_testing": 0.80, "account_takeover": 0.85, "high_count_30d": 0.20, "many_countries_30d": 0.30,
    "new_account_high_amount": 0.40,
}

# What the rules, the scored fact and its reports read of an enriched payment; a caller that stores payments for them
# needs no other column.
JUDGED = [
    "transaction_id", "user_id", "merchant_id", "amount_eur", "billing_country_iso", "shipping_country_iso",
    "ip_country_code", "ip_address", "device_fingerprint", "event_date", "event_timestamp", "fraud_label",
    "is_adult_product", "user_age", "user_kyc_status", "is_new_device", "ip_geo_mismatch", "amount_vs_avg_ratio",
    "user_txn_count_30d", "user_distinct_countries_30d", "is_first_transaction",
]


def ip_reputation(addresses: DataFrame, column: str = "ip_address") -> DataFrame:
    """Flags per address from a fixed table of prefixes: literal comparisons, no join."""
    address = F.col(column)

    def starts(prefixes: list[str]) -> Column:
        return reduce(lambda a, b: a | b, [address.startswith(p) for p in prefixes])

    kind = F.coalesce(*[F.when(starts(prefixes), name) for name, prefixes in C.IP_PREFIXES.items()], F.lit("CLEAN"))
    return addresses.withColumn("ip_type", kind).withColumns({
        "is_tor": F.col("ip_type") == "TOR_EXIT", "is_vpn": F.col("ip_type") == "VPN_KNOWN",
        "is_suspicious": F.col("ip_type") != "CLEAN",
    })


BURST_READS = ["user_id", "ip_address", "device_fingerprint", "merchant_id", "event_timestamp"]


def add_burst(df: DataFrame, **options) -> DataFrame:
    """Payments and different merchants of the same user, address and device in the last minute.

    `lies="user_id"` tells that the rows come from windows on the user, so that these need no shuffle of their own.
    """
    keyed = df.withColumns({
        # A missing part is a value of its own, so that it cannot shift the others.
        "_actor": F.concat_ws("|", *[F.coalesce(c, F.lit("\0")) for c in ("user_id", "ip_address", "device_fingerprint")]),
        "_second": F.unix_timestamp("event_timestamp"),
    })
    out = trailing(keyed, "_actor", "_second", C.VELOCITY_SECONDS, {"burst_count": F.lit(1)},
                   {"burst_merchants": "merchant_id"}, **options)
    return out.withColumn("burst_count", F.col("burst_count").cast("bigint")).drop("_actor", "_second")


def card_testing(df: DataFrame) -> DataFrame:
    """Micro-payments that lie in any five minutes in which at least three users pay from one address at one merchant.

    A payment ends a burst if the five minutes up to it hold enough users; one trailing window over reversed time then
    tells which payments have such an end within the next five minutes.
    """
    small = df.filter(
        (F.col("amount_eur") <= C.CARD_TEST_MAX) & F.col("ip_address").isNotNull() & F.col("merchant_id").isNotNull()
    ).select("transaction_id", "user_id", F.concat_ws("\0", "ip_address", "merchant_id").alias("_spot"),
             F.unix_timestamp("event_timestamp").alias("_second"))
    ends = trailing(small, "_spot", "_second", C.CARD_TEST_SECONDS, {"_n": F.lit(1)}, {"_users": "user_id"})
    marked = ends.withColumns({"_end": (F.col("_users") >= C.CARD_TEST_USERS).cast("bigint"), "_back": -F.col("_second")})
    spanned = trailing(marked, "_spot", "_back", C.CARD_TEST_SECONDS, {"_ends": F.col("_end")})
    return spanned.filter("_ends > 0").select("transaction_id")


def conditions() -> dict[str, Column]:
    """Rules that a single enriched row decides."""
    adult, age = F.col("is_adult_product"), F.col("user_age")
    shipped_away = F.col("shipping_country_iso") != F.col("billing_country_iso")
    return {
        "adult_product_minor": adult & (age < 18),
        "adult_product_kyc_bypass": adult & (age >= 18) & (
            F.coalesce(F.col("user_kyc_status"), F.lit("none")) != "verified"),
        "velocity_attack": (F.col("burst_count") >= C.VELOCITY_MIN_COUNT) & (F.col("burst_merchants") >= 2),
        "geo_mismatch": F.col("ip_geo_mismatch") & shipped_away & (F.col("amount_eur") >= C.GEO_MISMATCH_MIN)
        & F.col("shipping_country_iso").isin(C.RISKY_DESTINATIONS),
        "account_takeover": F.col("is_new_device") & (F.col("ip_geo_mismatch") | shipped_away)
        & (F.col("amount_vs_avg_ratio") > C.TAKEOVER_RATIO),
        "high_count_30d": F.col("user_txn_count_30d") > C.COUNT_30D_LIMIT,
        "many_countries_30d": F.col("user_distinct_countries_30d") > C.COUNTRIES_30D_LIMIT,
        "new_account_high_amount": F.col("is_first_transaction") & (F.col("amount_eur") >= C.GEO_MISMATCH_MIN),
    }


def score_rows(bursts: DataFrame) -> DataFrame:
    """rules_hit, fraud_probability and fraud_decision by the rules that a single row decides, without any shuffle.

    `bursts` are payments with features and `add_burst`. The weights combine as in `rule_scores`.
    """
    weights = F.array_compact(F.array(*[F.when(c, F.lit(RULE_WEIGHTS[name])) for name, c in conditions().items()]))
    hit = F.size("_weights").cast("bigint")
    score = F.when(hit > 0, F.least(F.lit(1.0), S.round_to(F.array_max("_weights") + 0.05 * (hit - 1), 4)))
    return bursts.withColumn("_weights", weights).withColumns({
        "rules_hit": hit, "fraud_probability": F.coalesce(score, F.lit(0.0)),
    }).withColumn("fraud_decision", S.decide(F.col("fraud_probability"))).drop("_weights")


def rules(enriched: DataFrame, **options) -> DataFrame:
    """(transaction_id, rule, score), one row per rule that fires.

    Row rules are one pass: an array of the rules that hold, exploded. Only card testing looks at other payments.
    `hot=[]` tells that no user is heavy, hence no user-address-device actor either. Rows may bring `add_burst` along.
    """
    bursts = enriched if "burst_count" in enriched.columns else add_burst(enriched, **options)
    hits = F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in conditions().items()]))
    row_rules = bursts.select("transaction_id", F.explode(hits).alias("rule"))
    tested = card_testing(enriched).withColumn("rule", F.lit("card_testing"))
    return row_rules.unionByName(tested).withColumn("score", S.lookup(RULE_WEIGHTS, F.col("rule")))


def rule_scores(hits: DataFrame) -> DataFrame:
    """Strongest rule score per transaction, 0.05 more for each further rule, at most 1."""
    return hits.groupBy("transaction_id").agg(
        F.max("score").alias("_top"), F.count(F.lit(1)).alias("rules_hit"),
    ).select(
        "transaction_id", "rules_hit",
        F.least(F.lit(1.0), S.round_to(F.col("_top") + 0.05 * (F.col("rules_hit") - 1), 4)).alias("fraud_probability"),
    )


def fact_fraud_scores(payments: DataFrame, scores: DataFrame) -> DataFrame:
    """Every payment with its probability and decision; no rule means probability 0."""
    return payments.join(scores, "transaction_id", "left").withColumns({
        "fraud_probability": F.coalesce("fraud_probability", F.lit(0.0)),
        "rules_hit": F.coalesce("rules_hit", F.lit(0)).cast("bigint"),
    }).withColumn("fraud_decision", S.decide(F.col("fraud_probability"))).select(
        "transaction_id", "user_id", "merchant_id", "amount_eur", "billing_country_iso", "shipping_country_iso",
        "geo_distance_km", "event_date", "event_timestamp", "fraud_probability", "fraud_decision", "rules_hit",
        F.col("fraud_label").alias("confirmed_fraud"),
    )


def alerts(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("fraud_probability") >= C.ALERT_AT)


def blocked_per_hour(scored: DataFrame, limit: int = C.BLOCKED_PER_HOUR) -> DataFrame:
    hour = F.date_trunc("hour", "event_timestamp")
    return scored.filter(F.col("fraud_decision") == "BLOCK").groupBy(hour.alias("hour")).agg(
        F.count(F.lit(1)).alias("blocked")).filter(F.col("blocked") > limit)


def country_mismatch(payments: DataFrame, parcels: DataFrame) -> DataFrame:
    """Orders delivered to another country than the billing one. Both sides are one row per order before the join."""
    paid = payments.groupBy("order_id").agg(F.min("billing_country_iso").alias("billing_country"))
    sent = parcels.groupBy("order_id").agg(
        F.max_by("delivery_country", F.struct("event_timestamp", "event_id")).alias("delivery_country"))
    return paid.join(sent, "order_id").filter(F.col("billing_country") != F.col("delivery_country"))


def without_session(payments: DataFrame, sessions: DataFrame, lookback_seconds: int = 86_400) -> DataFrame:
    """Payments with no session start of the same user in the lookback before them.

    A range join would pair every payment with every session of a user. Instead both are put on one timeline of
    distinct session starts and payments per user, and each payment takes the last start at or before it.
    """
    starts = sessions.select("user_id", F.unix_micros("session_start").alias("_micros"), F.lit(1).alias("_start"))
    paid = payments.select("user_id", F.unix_micros("event_timestamp").alias("_micros"), "transaction_id")
    line = paid.withColumn("_start", F.lit(0)).unionByName(
        starts.distinct().withColumn("transaction_id", F.lit(None).cast("string")))
    counted = trailing(line, "user_id", "_micros", lookback_seconds * 1_000_000, {"_starts": F.col("_start")},
                       chunk=P.DAY * 1_000_000)
    return counted.filter(F.col("transaction_id").isNotNull() & (F.col("_starts") == 0)).select(
        "transaction_id", "user_id")
