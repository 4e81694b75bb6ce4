import pytest
from pyspark.sql import functions as F

from bazaarlake.operators import quality, tables
from bazaarlake.plans import bindings as B
from bazaarlake.plans import nightly
from bazaarlake.sources.readers import Registry

SF = "/root/testdata/sf0.001"


def dated(df, day):
    return df.withColumns({"year": F.lit(2024), "month": F.lit(2), "day": F.lit(day)})


def test_two_nights_equal_one_rebuild(spark, tmp_path, rows):
    """Half of the payments arrive on each night; the result equals one night with everything."""
    pay = B.payments(spark, SF).withColumn("currency", F.when(F.col("currency") == "RUB", "EUR").otherwise(F.col("currency")))
    first = F.abs(F.hash("transaction_id")) % 2 == 0
    split, whole = Registry(str(tmp_path / "split")), Registry(str(tmp_path / "whole"))
    parts = ["year", "month", "day"]
    tables.append(dated(pay.filter(first), 1).unionByName(dated(pay.filter(~first), 2)), split.path("bronze.payments"), parts)
    tables.append(dated(pay, 2), whole.path("bronze.payments"), parts)
    nightly.run_payments(spark, split, "2024-02-01", B.AS_OF)
    counts = nightly.run_payments(spark, split, "2024-02-02", B.AS_OF)
    assert counts["valid"] > 0 and counts["rejected"] > 0
    nightly.run_payments(spark, whole, "2024-02-02", B.AS_OF)
    one, two = split.read(spark, "silver.payments"), whole.read(spark, "silver.payments")
    columns = [c for c in one.columns if c != "reject_reason"]
    assert rows(one, *columns) == rows(two, *columns)
    nightly.run_payments(spark, split, "2024-02-02", B.AS_OF)
    assert rows(split.read(spark, "silver.payments"), *columns) == rows(two, *columns), "a rerun changes nothing"


def test_whole_night(spark, tmp_path):
    registry = Registry(str(tmp_path))
    parts = ["year", "month", "day"]
    # The suite refuses amounts above 99,999.
    paid = B.payments(spark, SF).withColumn("amount", F.when(F.col("amount") > 99_999, 99_999.0).otherwise(F.col("amount")))
    tables.append(dated(paid, 29), registry.path("bronze.payments"), parts)
    tables.append(dated(B.clickstream(spark, SF), 29), registry.path("bronze.clickstream"), parts)
    night = dict(run_date="2024-02-29", as_of=B.AS_OF, salt="s", catalogue=B.products(spark, SF),
                 merchants=B.merchants(spark, SF))
    tables.append(dated(B.crm(spark, SF), 28), registry.path("bronze.crm"), parts)
    with pytest.raises(nightly.NotReady, match="bronze.crm"):
        nightly.run(spark, registry, **night)
    tables.append(dated(B.crm(spark, SF), 29), registry.path("bronze.crm"), parts)
    counts = nightly.run(spark, registry, **night)
    facts = registry.read(spark, "gold.fact_orders")
    assert facts.count() == counts["valid"] == registry.read(spark, "gold.fraud_feature_store").count()
    assert registry.read(spark, "gold.kpi_daily").agg(F.sum("orders")).first()[0] == facts.filter(
        "status = 'success'").count()
    scored = registry.read(spark, "gold.fact_fraud_scores")
    assert scored.count() == counts["valid"] and scored.filter("rules_hit > 0").count() > 0
    assert scored.filter("fraud_decision = 'BLOCK' and fraud_probability < 0.8").isEmpty()
    assert registry.read(spark, "silver.clickstream").count() > 0
    assert "email" not in registry.read(spark, "silver.crm").columns


def test_rows_that_fail_the_suite_are_stored_and_not_published(spark, tmp_path):
    registry = Registry(str(tmp_path))
    paid = B.payments(spark, SF).withColumn("amount", F.when(F.col("payment_method") == "paypal", 5e5).otherwise(5.0))
    tables.append(dated(paid, 28), registry.path("bronze.payments"), ["year", "month", "day"])
    for _ in range(2):
        with pytest.raises(quality.QualityError, match="accepted_range_amount_eur"):
            nightly.run_payments(spark, registry, "2024-02-28", B.AS_OF, quality.payments_suite(B.AS_OF))
    assert not tables.exists(spark, registry.path("silver.payments"))
    results = spark.read.parquet(f"{registry.base}/quality/results").filter("rule = 'accepted_range_amount_eur'").collect()
    stored = spark.read.parquet(f"{registry.base}/quality/failures").filter("suite = 'payments'")
    assert len(results) == 1 and results[0]["failed"] > 0
    assert stored.filter("array_contains(broken_rules, 'accepted_range_amount_eur')").count() == results[0]["failed"]
    assert stored.filter("row LIKE '%500000%'").count() > 0


def test_documents_reach_the_customers_once(spark, tmp_path):
    registry = Registry(str(tmp_path))
    people = spark.createDataFrame([(f"USR-{k:06d}", "new", "none", 30) for k in range(8)],
                                   "user_id string, customer_segment string, id_verification_status string, age int")
    tables.upsert(spark, people, registry.path("silver.crm"), ["user_id"], "customer_segment")
    files = spark.range(8).select(F.format_string("USR-%06d/id.jpg", "id").alias("path"), F.timestamp_seconds("id").alias("modificationTime"))
    born = F.when(F.col("path") < "USR-000002", "01/02/2015").otherwise("01/02/1980")
    text = F.concat(F.lit("NOM : DUPONT 1 PRENOM : Jean "), born, F.lit(" N° 123456789012"))

    def recognise(mine):
        return mine.filter("path <> 'USR-000005/id.jpg'").select(
            F.col("path").alias("doc_id"), F.substring_index("path", "/", 1).alias("user_id"),
            F.posexplode(F.split(text, " ")).alias("seq", "word"), F.lit(95).alias("conf"))

    first = nightly.run_documents(spark, registry, files, recognise, "run-1", "2024-03-01 00:00:00", 6)
    assert first["processed"] == 5 and first["restricted"] == 2
    second = nightly.run_documents(spark, registry, files, recognise, "run-2", "2024-03-01 01:00:00", 6)
    assert second["processed"] == 2, "two new ones; the unreadable one is tried again"
    status = {r["user_id"][-1]: r["id_verification_status"] for r in registry.read(spark, "silver.crm").collect()}
    assert status == {**{k: "verified" for k in "23467"}, "0": "restricted", "1": "restricted", "5": "none"}
