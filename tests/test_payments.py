import pytest
from pyspark.sql import functions as F

from bazaarlake import schemas
from bazaarlake.operators import fraud, gold, payments, quality

DEFAULTS = dict(
    transaction_id="t", user_id="u", amount=10.0, currency="EUR", payment_method="paypal", product_id="p",
    product_category_id="c", is_adult_product=False, billing_country="FR", shipping_country="FR", ip_address="78.1.1.1",
    ip_country_inferred="FR", device_fingerprint="d", is_new_device=False, is_new_merchant=False,
    user_kyc_status="verified", user_age=30, timestamp="2024-01-10T10:00:00.000001Z", merchant_id="m",
    fraud_label_ground_truth=False, fraud_scenario_label="none")


def bronze(spark, *changes):
    fields = [f for f in schemas.PAYMENTS.fields if f.name in DEFAULTS]
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    ddl += ", kafka_partition int, kafka_offset bigint, ingested_at timestamp"
    data = []
    for i, change in enumerate(changes):
        row = {**DEFAULTS, "transaction_id": f"t{i}", **change}
        at = row.pop("ingested", "2024-01-10 11:00:00")
        offset = row.pop("offset", i)
        data.append(tuple(row[f.name] for f in fields) + (0, offset, at))
    return spark.createDataFrame([(*d[:-1], None) for d in data], ddl).drop("ingested_at").join(
        spark.createDataFrame([(d[-2], d[-1]) for d in data], "kafka_offset bigint, at string"), "kafka_offset"
    ).withColumn("ingested_at", F.col("at").cast("timestamp")).drop("at")


def test_every_row_is_valid_or_rejected(spark, rows):
    df = payments.clean(bronze(
        spark, {}, {"amount": None}, {"amount": 0.0}, {"amount": -5.0}, {"currency": " usd "}, {"currency": None},
        {"currency": "RUB"}, {"user_id": None}, {"timestamp": "bad"}, {"transaction_id": None}, {"amount": 0.001}))
    valid, rejected = payments.split(df)
    assert valid.count() + rejected.count() == 11
    assert rows(valid, "transaction_id", "currency_code") == [("t0", "EUR"), ("t4", "USD"), ("t5", "EUR")]
    assert rows(rejected, "reject_reason") == sorted([(r,) for r in (
        "missing_amount", "amount_not_positive", "amount_not_positive", "currency_not_supported", "missing_user",
        "bad_timestamp", "missing_transaction", "amount_not_positive")], key=repr)


def test_latest_version_wins(spark, rows):
    df = bronze(spark, {"transaction_id": "x", "amount": 1.0, "ingested": "2024-01-10 11:00:00", "offset": 1},
                {"transaction_id": "x", "amount": 2.0, "ingested": "2024-01-10 12:00:00", "offset": 2},
                {"transaction_id": "x", "amount": 3.0, "ingested": "2024-01-10 12:00:00", "offset": 3},
                {"transaction_id": None, "offset": 4})
    assert rows(payments.latest(df), "transaction_id", "amount") == [("x", 3.0)]


def test_cross_border_is_three_valued(spark):
    df = payments.clean(bronze(spark, {}, {"shipping_country": " de "}, {"shipping_country": None}))
    got = {r[0]: r[1] for r in df.select("transaction_id", "is_cross_border").collect()}
    assert got == {"t0": False, "t1": True, "t2": None}


def test_month_window_edges(spark):
    day = "2024-01-{:02d}T00:00:{:02d}Z"
    df = payments.clean(bronze(
        spark, {"timestamp": day.format(1, 0), "amount": 10.0}, {"timestamp": day.format(1, 0), "amount": 20.0},
        {"timestamp": day.format(31, 0), "amount": 30.0}, {"timestamp": day.format(31, 1), "amount": 40.0},
        {"timestamp": day.format(1, 0), "amount": 5.0, "user_id": "v"}))
    got = {r["transaction_id"]: r for r in payments.trailing_month(df).collect()}
    assert [got[f"t{i}"]["user_txn_count_30d"] for i in range(5)] == [2, 2, 3, 2, 1]
    assert got["t2"]["user_avg_amount_30d"] == 20.0 and got["t2"]["user_amount_stddev_30d"] == 10.0
    assert got["t4"]["user_amount_stddev_30d"] is None and got["t3"]["amount_vs_avg_ratio"] == 1.1429


def many(spark):
    changes = []
    for i in range(60):
        changes.append({
            "user_id": "hot" if i % 3 == 0 else f"u{i % 5}", "amount": 1.0 + i * 7 % 50,
            "timestamp": f"2024-{1 + i % 4:02d}-{1 + i * 11 % 28:02d}T{i % 24:02d}:{i % 60:02d}:00Z",
            "billing_country": ["FR", "DE", "IT"][i % 3], "merchant_id": f"m{i % 4}"})
    return payments.split(payments.clean(bronze(spark, *changes)))[0].drop("reject_reason")


FEATURES = ["transaction_id", "user_txn_count_30d", "user_avg_amount_30d", "user_amount_stddev_30d",
            "amount_vs_avg_ratio", "user_distinct_countries_30d", "user_distinct_merchants_30d",
            "velocity_count_5min", "is_first_transaction"]


def test_heavy_user_gets_the_same_features(spark, rows):
    df = many(spark)
    assert rows(payments.enrich(df, hot=[]), *FEATURES) == rows(payments.enrich(df, hot=["hot"]), *FEATURES)


@pytest.mark.parametrize("arriving", ["event_date >= '2024-03-01'", "hash(transaction_id) % 3 = 0",
                                      "event_date < '2024-01-20'"])
def test_incremental_equals_full_rebuild(spark, rows, arriving):
    df = many(spark)
    full = {r["transaction_id"]: tuple(r) for r in payments.enrich(df).select(*FEATURES).collect()}
    old, new = df.filter(f"NOT ({arriving})"), df.filter(arriving)
    merged = {r["transaction_id"]: tuple(r) for r in payments.enrich(old).select(*FEATURES).collect()}
    for r in payments.refresh(old, new).select(*FEATURES).collect():
        merged[r["transaction_id"]] = tuple(r)
    assert merged == full


def test_corrections_equal_full_rebuild(spark):
    """Payments that move to another time or user, or become invalid, leave no trace in the windows they were in."""
    df = many(spark)
    moved = df.filter("transaction_id IN ('t0', 't1', 't7')").withColumn(
        "event_timestamp", F.expr("event_timestamp + INTERVAL 20 DAYS"))
    given = df.filter("transaction_id IN ('t3', 't8')").withColumn("user_id", F.lit("u4"))
    new = moved.unionByName(given)
    withdrawn = spark.createDataFrame([("t6",), ("t12",), ("unknown",)], "transaction_id string")
    rest = df.filter("transaction_id NOT IN ('t0', 't1', 't7', 't3', 't8', 't6', 't12')")
    full = {r["transaction_id"]: tuple(r) for r in payments.enrich(rest.unionByName(new)).select(*FEATURES).collect()}
    merged = {r["transaction_id"]: tuple(r) for r in payments.enrich(df).select(*FEATURES).collect()}
    for r in payments.refresh(df, new, withdrawn).select(*FEATURES).collect():
        merged[r["transaction_id"]] = tuple(r)
    for gone in ("t6", "t12"):
        del merged[gone]
    assert merged == full


def test_card_testing_over_any_border(spark):
    """Four users within 20 seconds around second 300 of the hour are a burst; slow or lonely payments are not."""
    def paid(user, at, **more):
        return {"user_id": user, "amount": 1.5, "ip_address": "45.33.32.9", "merchant_id": "M",
                "timestamp": f"2024-01-11T{at}Z", **more}

    df = payments.split(payments.clean(bronze(
        spark, paid("a", "10:04:50"), paid("b", "10:04:55"), paid("c", "10:05:05"), paid("d", "10:05:10"),
        paid("a", "12:00:00"), paid("b", "12:04:00"), paid("c", "12:08:00"),
        paid("e", "10:05:00", merchant_id="N"), paid("f", "10:05:00", merchant_id=None))))[0]
    assert sorted(r[0] for r in fraud.card_testing(df).collect()) == ["t0", "t1", "t2", "t3"]


def test_curated_contract(spark):
    out = payments.build(bronze(spark, {}, {"fraud_label_ground_truth": True}), "2024-02-01")
    assert out.columns == schemas.SILVER_PAYMENTS_COLUMNS + schemas.SILVER_PAYMENTS_EXTRA
    got = {r["transaction_id"]: (r["blocked"], r["status"], r["reject_reason"]) for r in out.collect()}
    assert got == {"t0": (False, "success", None), "t1": (True, "blocked", "fraud_detected")}
    assert "ip_address" not in out.columns and dict(out.dtypes)["amount_eur"] == "decimal(12,2)"


def test_fraud_rules(spark):
    burst = [{"user_id": "b", "merchant_id": f"m{i}", "timestamp": f"2024-01-10T10:00:{i * 10:02d}Z"} for i in range(5)]
    cards = [{"user_id": f"c{i}", "amount": 1.5, "ip_address": "45.33.32.9", "merchant_id": "M",
              "timestamp": f"2024-01-11T10:00:{i * 20:02d}Z"} for i in range(3)]
    df = payments.split(payments.clean(bronze(
        spark, {"is_adult_product": True, "user_age": 15}, {"is_adult_product": True, "user_age": 22,
                                                            "user_kyc_status": "none", "user_id": "w"},
        {"user_id": "g", "amount": 500.0, "shipping_country": "NG", "ip_country_inferred": "TOR"}, *burst, *cards)))[0]
    hits = {}
    for r in fraud.rules(payments.enrich(df)).collect():
        hits.setdefault(r["rule"], set()).add(r["transaction_id"])
    assert hits["adult_product_minor"] == {"t0"} and hits["adult_product_kyc_bypass"] == {"t1"}
    assert hits["geo_mismatch"] == {"t2"} and hits["velocity_attack"] == {"t6", "t7"}
    assert hits["card_testing"] == {"t8", "t9", "t10"} and "t2" in hits["new_account_high_amount"]
    scored = {r["transaction_id"]: r for r in fraud.rule_scores(fraud.rules(payments.enrich(df))).collect()}
    assert scored["t0"]["fraud_probability"] == 0.9 and scored["t2"]["fraud_probability"] == 0.75


def test_quality_suite_runs_in_one_pass(spark, plan):
    df = payments.build(bronze(spark, {}, {}), "2024-02-01").withColumn("pii_anonymized_at", F.current_timestamp())
    rules = [r for r in quality.payments_suite("2024-02-01") if not r.unique]
    out = quality.run_suite(df.select("*"), rules)
    assert {r["status"] for r in out.collect()} == {"pass"}
    stored = spark.createDataFrame(df.collect(), df.schema)
    assert plan(quality.run_suite(stored, rules)).count("Exchange") == 1
    failing = quality.run_suite(stored.withColumn("user_id", F.lit(None).cast("string")), rules)
    with pytest.raises(quality.QualityError, match="not_null_user_id"):
        quality.enforce(failing)


def test_rules_see_nulls_and_duplicates(spark):
    df = spark.createDataFrame([("a", 5), ("a", None), (None, 500), ("b", 7)], "k string, v int")
    got = {r["rule"]: (r["failed"], r["total"]) for r in quality.run_suite(df, [
        quality.not_null("k"), quality.unique("k"), quality.accepted_range("v", 0, 100),
        quality.expression_is_true("v_known", F.col("v") > 0), quality.accepted_values("k", ["a"]),
        quality.column_absent("v"), quality.row_count_between(5, 9)]).collect()}
    assert got == {"not_null_k": (1, 4), "unique_k": (2, 3), "accepted_range_v": (1, 4), "v_known": (1, 4),
                   "accepted_values_k": (1, 4), "column_absent_v": (1, 4), "row_count_between": (1, 4)}


def test_feature_store_day_grain(spark):
    df = payments.build(bronze(
        spark, {"timestamp": "2024-01-10T01:00:00Z"}, {"timestamp": "2024-01-10T23:00:00Z"}), "2024-02-01")
    people = spark.createDataFrame([("u", "k", "vip", "verified", "25-34")],
                                   "user_id string, customer_key string, customer_segment string, kyc_status string, "
                                   "age_group string")
    goods = spark.createDataFrame([("p", "pk", "CAT", "low")],
                                  "product_id string, product_key string, category_id string, risk_category string")
    facts = gold.fact_orders(df, people, goods, gold.dim_date(spark, "2024-01-01", "2024-02-01"))
    assert [r[0] for r in facts.select("order_date_key").collect()] == [20240110, 20240110]
    assert sorted(tuple(r) for r in gold.feature_store(facts).select("txn_count_1h", "txn_count_30d").collect()) == [
        (1, 2), (1, 2)]
    assert gold.referential_integrity(facts, people, goods).count() == 0
    assert gold.referential_integrity(facts, people.limit(0), goods).count() == 2
