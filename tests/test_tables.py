import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from bazaarlake import schemas
from bazaarlake.operators import crm, gold, kyc, logistics, ml, privacy, sessions, tables
from bazaarlake.sources import readers
from bazaarlake.sources.bronze import parse_json


def messages(spark, values):
    data = [(b"k", None if v is None else bytearray(v, "utf8"), "payments-raw", 0, i) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "key binary, value binary, topic string, partition int, offset bigint").withColumn(
        "timestamp", F.current_timestamp())


def test_parse_flags_what_it_cannot_read(spark):
    values = ['{"transaction_id":"a","amount":1.5,"other":1}', "garbage", '{"transaction_id":"a"', '{"amount":"x"}', "",
              None, '{"user_id":"u"}']
    out = parse_json(messages(spark, values), schemas.PAYMENTS, "payments-raw", "2024-01-02 00:00:00")
    got = {r["kafka_offset"]: r for r in out.collect()}
    assert [got[i]["_parse_error"] for i in range(7)] == [False, True, True, True, True, True, False]
    assert got[0]["amount"] == 1.5 and got[1]["_raw_json"] == "garbage" and got[6]["transaction_id"] is None
    assert (got[0]["year"], got[0]["month"], got[0]["day"]) == (2024, 1, 2)


def paths(path):
    return sorted(n for n in os.listdir(path) if "=" in n)


def test_upsert(spark, tmp_path, rows):
    path, ddl = str(tmp_path / "t"), "k string, v int, day string"
    tables.upsert(spark, spark.createDataFrame([("a", 1, "d1"), ("b", 2, "d2"), ("c", 3, "d3")], ddl), path, ["k"], "day")
    change = spark.createDataFrame([("a", 10, "d1"), ("b", 20, "d1"), ("n", 5, "d4")], ddl)
    want = [("a", 10, "d1"), ("b", 20, "d1"), ("c", 3, "d3"), ("n", 5, "d4")]
    untouched = {f: os.stat(f"{path}/day=d3/{f}").st_mtime_ns for f in os.listdir(f"{path}/day=d3")}
    for _ in range(2):
        tables.upsert(spark, change, path, ["k"], "day", sort=["k"])
        assert rows(spark.read.parquet(path), "k", "v", "day") == want
    assert paths(path) == ["day=d1", "day=d3", "day=d4"], "an emptied partition must disappear"
    assert untouched == {f: os.stat(f"{path}/day=d3/{f}").st_mtime_ns for f in os.listdir(f"{path}/day=d3")}
    with pytest.raises(tables.DuplicateKeys):
        tables.upsert(spark, spark.createDataFrame([("a", 1, "d1"), ("a", 2, "d1")], ddl), path, ["k"], "day")


def test_upsert_removes(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "c", "y")], "id int, v string, p string")
    tables.upsert(spark, old, path, ["id"], "p")
    new = spark.createDataFrame([(2, "B", "z")], old.schema)
    gone = spark.createDataFrame([(3,), (9,), (None,)], "id int")
    tables.upsert(spark, new, path, ["id"], "p", removed=gone)
    assert rows(spark.read.parquet(path), "id", "v", "p") == [(1, "a", "x"), (2, "B", "z")]
    tables.upsert(spark, new.limit(0), path, ["id"], "p", removed=new)
    assert rows(spark.read.parquet(path), "id", "v", "p") == [(1, "a", "x")]


def test_upsert_adds_columns(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    tables.upsert(spark, spark.createDataFrame([("a", "d1"), ("b", "d2")], "k string, day string"), path, ["k"], "day")
    tables.upsert(spark, spark.createDataFrame([("c", "d1", 7)], "k string, day string, extra int"), path, ["k"], "day")
    table = spark.read.option("mergeSchema", "true").parquet(path)
    assert rows(table, "k", "extra") == [("a", None), ("b", None), ("c", 7)]


def test_overwrite_touches_only_its_partitions(spark, tmp_path, rows):
    path, ddl = str(tmp_path / "t"), "v int, day string"
    tables.overwrite_partitions(spark.createDataFrame([(1, "a"), (2, "b")], ddl), path, "day")
    tables.overwrite_partitions(spark.createDataFrame([(3, "b")], ddl), path, "day")
    assert rows(spark.read.parquet(path)) == [(1, "a"), (3, "b")]


def test_write_split(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "bad"), (3, None)], "v int, reject_reason string")
    valid, kept, rejected = tables.write_split(df, str(tmp_path / "q"))
    assert (valid.count(), kept, rejected) == (2, 2, 1)
    assert spark.read.parquet(str(tmp_path / "q")).count() == 1
    day = str(tmp_path / "days")
    for _ in range(2):  # a rerun of a day replaces what it rejected
        tables.write_split(df, day, "2024-01-02")
    tables.write_split(df, day, "2024-01-03")
    assert spark.read.parquet(day).count() == 2
    tables.write_split(df.filter("v <> 2"), day, "2024-01-02")
    assert spark.read.parquet(day).count() == 1


def test_day_read_prunes_partitions(spark, tmp_path, plan):
    path = str(tmp_path / "b")
    tables.append(spark.createDataFrame([(1, 2024, 1, 2), (2, 2024, 1, 3)], "v int, year int, month int, day int"), path,
                  ["year", "month", "day"])
    table = spark.read.parquet(path)
    day = readers.of_day(table, "2024-01-03")
    assert [r["v"] for r in day.collect()] == [2]
    assert "PartitionFilters: [isnotnull(year" in plan(day)
    assert readers.is_ready(table, "2024-01-02") and not readers.is_ready(table, "2024-01-04")


def test_crm_csv_and_documents(spark, tmp_path):
    day = tmp_path / "crm" / "year=2024" / "month=01" / "day=02"
    day.mkdir(parents=True)
    names = [f.name for f in schemas.CRM.fields]
    values = {"user_id": "USR-000001", "postal_code": "01234", "age": "17", "is_minor": "true"}
    (day / "x.csv").write_text(",".join(names) + "\n" + ",".join(values.get(n, "") for n in names) + "\n", "utf8")
    row = readers.read_crm(spark, str(tmp_path / "crm"), "2024-01-02").first()
    assert (row["postal_code"], row["age"], row["day"]) == ("01234", 17, 2)
    docs = tmp_path / "docs" / "USR-000009"
    docs.mkdir(parents=True)
    for name, size in (("a.jpg", 10), ("b.png", 11 * 1024 * 1024), ("c.txt", 5)):
        (docs / name).write_bytes(b"0" * size)
    files = readers.document_files(spark, str(tmp_path / "docs"))
    assert {r["user_id"] for r in files.collect()} == {"USR-000009"} and files.count() == 2
    assert readers.accepted_uploads(files).count() == 1 and readers.pending_documents(files, 1).count() == 1
    assert readers.pending_documents(files, 50, files).count() == 0
    assert readers.expired_documents(files, "2100-01-01").count() == 2
    assert readers.expired_documents(files, "2000-01-01").count() == 0


def test_incremental_slices(spark):
    ddl = "v int, at timestamp"
    source = spark.createDataFrame([(1, None)], ddl).limit(0).unionByName(spark.range(1, 6).select(
        F.col("id").cast("int").alias("v"), F.timestamp_seconds("id").alias("at")))
    target = source.filter("v <= 3")
    assert {r["v"] for r in readers.newer_than_target(source, target, "at").collect()} == {4, 5}
    assert {r["v"] for r in readers.newer_rows(source, target, "at").collect()} == {4, 5}
    assert readers.newer_than_target(source, target.limit(0), "at").count() == 5
    assert readers.newer_rows(source, target.limit(0), "at").count() == 5
    assert readers.newer_than_target(source, target, "at", full_refresh=True).count() == 5
    assert readers.lookback(source, "at", "1970-01-05", 3).count() == 0


SALT = "s"


def test_pseudonymise_only_present_columns(spark):
    df = spark.createDataFrame([("u", " Jean@Email.COM ", "+33612345678", "75016", "Jean", "tel +33 6 12 34 56 78"),
                                ("v", "jean@email.com", None, None, None, None)],
                               "user_id string, email string, phone string, postal_code string, first_name string, "
                               "notes string")
    out = {r["user_id"]: r for r in privacy.pseudonymise(df, SALT, "2024-01-01").collect()}
    assert out["u"]["email_hashed"] == out["v"]["email_hashed"] and len(out["u"]["email_hashed"]) == 23
    assert out["u"]["postal_zone"] == "75010" and out["u"]["notes"] == "tel <TEL>" and out["v"]["phone_token"] is None
    assert set(out["u"].asDict()) & {"email", "phone", "postal_code", "first_name"} == set()
    bare = privacy.pseudonymise(df.select("user_id"), SALT, "2024-01-01")
    assert bare.columns == ["user_id", "pii_anonymized_at", "pii_anonymization_version"]


def test_mask_whole_text(spark, plan):
    text = ("x" * 50_000) + " a.b@c.fr FR7630006000011234567890189 4111 1111 1111 1111 10.20.30.40 1.2.3.4"
    df = spark.createDataFrame([(text,), ("plain",), (None,)], "t string").select(privacy.mask_text(F.col("t")).alias("m"))
    got = [r["m"] for r in df.collect()]
    assert got[0].endswith(" <EMAIL> FR76300060000112345**********".replace("FR76300060000112345", "FR763000600001123")
                           + " <CARD> <IP> <IP>") and got[1:] == ["plain", None]
    assert "Python" not in plan(df)


def test_erase_rekeys_dims_and_facts(spark, rows):
    people = spark.createDataFrame([("u", "k1", "h"), ("v", "k2", "g")], "user_id string, customer_key string, email_hashed string")
    facts = spark.createDataFrame([("u", "k1", 1), ("u", "k1", 2), ("v", "k2", 3)], "user_id string, customer_key string, n int")
    requests = spark.createDataFrame([("u",), ("u",), ("ghost",), (None,)], "user_id string")
    erased, receipts = privacy.erase({"people": people, "facts": facts}, requests, SALT, "2024-01-01")
    got = {r["n"]: r for r in erased["facts"].collect()}
    assert got[3]["user_id"] == "v" and got[1]["user_id"].startswith("ERASED_") and got[1]["customer_key"] != "k1"
    person = [r for r in erased["people"].collect() if r["user_id"] != "v"][0]
    assert person["customer_key"] == got[1]["customer_key"] and person["email_hashed"] == person["user_id"]
    assert rows(receipts, "people_rows", "facts_rows", "found") == [(0, 0, False), (1, 2, True)]


def test_leak_check(spark, rows):
    df = spark.createDataFrame([(1, "a@b.fr", "x"), (2, "n", None)], "id int, t string, u string")
    assert rows(privacy.leak_check(df, "id")) == [("t", 1, 1), ("u", 0, None)]


def click(spark, *events):
    base = dict(event_type="page_view", page="homepage", user_id="u", session_id="s", duration_seconds=5,
                device_type="desktop_chrome", user_agent="Chrome/1 Edg/1", referrer=None, product_id=None,
                category_id=None, scroll_depth_pct=10, product_price=None, quantity=None, is_adult_product=False)
    kinds = {"duration_seconds": "int", "scroll_depth_pct": "int", "product_price": "double", "quantity": "int",
             "is_adult_product": "boolean"}
    data = [(f"e{i}", *({**base, **{k: v for k, v in e.items() if k != "t"}}.values()), e["t"]) for i, e in enumerate(events)]
    ddl = "event_id string, " + ", ".join(f"{k} {kinds.get(k, 'string')}" for k in base) + ", timestamp string"
    return spark.createDataFrame(data, ddl).withColumn("ingested_at", F.timestamp_seconds(F.lit(0)))


def test_sessions(spark):
    day = "2024-01-{}T{}Z"
    df = click(
        spark, {"t": day.format("01", "23:59:00")}, {"t": day.format("02", "00:01:00"), "page": "checkout_start"},
        {"t": day.format("02", "00:00:30"), "event_type": "age_gate_shown", "duration_seconds": None, "user_id": "w"},
        {"t": day.format("02", "10:00:00"), "session_id": "one"},
        {"t": day.format("02", "10:00:00"), "session_id": "fast"}, {"t": day.format("02", "10:00:01"), "session_id": "fast"},
        {"t": day.format("02", "10:00:00"), "session_id": "bot", "duration_seconds": 1},
        {"t": day.format("02", "10:00:00"), "session_id": "bot", "duration_seconds": None})
    out = sessions.build(df, "2024-02-01")
    assert out.columns == schemas.SILVER_SESSIONS_COLUMNS + ["is_multi_user"]
    [row] = out.collect()
    assert (row["session_id"], row["user_id"], row["is_multi_user"], row["total_events"]) == ("s", "u", True, 3)
    assert row["session_date"] == date(2024, 1, 1) and row["session_duration_seconds"] == 120
    assert (row["entry_page"], row["exit_page"], row["has_conversion"], row["engagement_score"]) == (
        "homepage", "checkout_start", True, 1.0)
    assert row["browser"] == "chrome" and row["traffic_source"] == "direct"
    strict = sessions.build(df, "2024-02-01", strict_browser=True).first()
    assert strict["browser"] == "edge"
    touched = sessions.touched_sessions(df, "2024-01-05", 3)
    assert {r["session_id"] for r in touched.collect()} == {"s", "one", "fast", "bot"}
    assert touched.filter("session_id = 's'").count() == 3, "the part of the session before the lookback stays"


def test_rfm_of_unbought_customers(spark):
    people = spark.range(7).select(
        F.concat(F.lit("u"), "id").alias("user_id"), F.lit(30).alias("age"), F.lit("c").alias("city"),
        F.lit("z").alias("postal_zone"), F.lit("FR").alias("country"), F.lit("verified").alias("id_verification_status"),
        F.lit(False).alias("is_minor"), F.lit("vip").alias("customer_segment"), F.lit(None).cast("date").alias(
            "registration_date"), F.lit(None).cast("date").alias("gdpr_consent_date"), F.lit(True).alias("newsletter_optin"))
    paid = spark.range(5).select(
        F.concat(F.lit("u"), F.col("id")).alias("user_id"), F.lit("success").alias("status"),
        (F.col("id") + 1).cast("decimal(12,2)").alias("amount_eur"), F.date_add(F.lit("2024-01-01").cast("date"), F.col(
            "id").cast("int")).alias("event_date"), F.lit(False).alias("fraud_label"))
    visits = spark.createDataFrame([("u1", 10, True)], "user_id string, session_duration_seconds bigint, has_conversion boolean")
    small = gold.dim_customers(people, paid, visits, "2024-02-01")
    score = {r["user_id"]: r for r in small.collect()}
    assert score["u6"]["rfm_recency_score"] == 1 and score["u6"]["recency_days"] is None
    assert score["u4"]["rfm_recency_score"] == 5 and score["u6"]["frequency"] == 0
    compat = gold.dim_customers(people, paid, visits, "2024-02-01", compat=True)
    assert {r["user_id"]: r["rfm_recency_score"] for r in compat.collect()}["u6"] == 5


def test_calendar(spark):
    days = gold.dim_date(spark)
    assert days.count() == 2191
    row = {r["date_key"]: r for r in days.filter("date_key IN (20241129, 20240714, 20240101)").collect()}
    assert row[20241129]["is_black_friday"] and row[20240714]["is_bastille_day"] and row[20240101]["is_new_year"]
    assert row[20240714]["day_of_week"] == 1 and row[20240714]["year_quarter"] == "Q3 2024"


def test_kyc_decisions(spark):
    docs = spark.createDataFrame([
        (1, "u1", "NOM : DUPONT PRENOM : Jean 01/02/1990 N° 123456789012", 90.0), (2, "u2", "Nom : X 01.02.2015", 10.0),
        (3, "u3", "sans date", 90.0), (4, "u4", "32/13/2000", 90.0), (5, "u5", "01 02 1990", 60.0), (6, "u6", "01/02/1990", 59.9)],
        "doc_id int, user_id string, text string, confidence double")
    got = {r["doc_id"]: r for r in kyc.extract(docs, "2024-03-01").collect()}
    assert [got[i]["action_required"] for i in range(1, 7)] == [
        "none", "restrict_account", "manual_review", "manual_review", "none", "manual_review"]
    assert [got[i]["kyc_decision"] for i in range(1, 7)] == [
        "verified", "restricted", "failed", "failed", "verified", "manual_review"]
    assert got[1]["last_name"].startswith("DUPONT") and got[1]["card_number_hash"].startswith("SHA256_")
    assert got[4]["error_message"] == "invalid date: 32.13.2000" and got[1]["age"] == 34
    out = kyc.counters(kyc.extract(docs, "2024-03-01")).first()
    assert tuple(out) == (6, 4, 1, 3)


def test_words_to_text(spark):
    words = spark.createDataFrame([(1, "u", 1, "B", 50), (1, "u", 0, "A", 90), (1, "u", 2, "c", 40), (1, "u", 3, "", -1)],
                                  "doc_id int, user_id string, seq int, word string, conf int")
    assert tuple(kyc.assemble(words).first()) == (1, "u", "A B", 60.0)


def test_status_transitions(spark, rows):
    df = spark.createDataFrame([("e1", "o", 1, "order_placed"), ("e2", "o", 2, "shipped"), ("e3", "o", 3, "order_placed"),
                                ("e4", "o", 4, "delayed"), ("e5", "o", 5, "delivered")],
                               "event_id string, order_id string, event_timestamp int, status string")
    assert rows(logistics.transitions(df), "event_id", "is_legal") == [
        ("e1", True), ("e2", True), ("e3", False), ("e4", True), ("e5", True)]


def test_crm_keeps_latest(spark, rows):
    df = spark.createDataFrame([("u", "2024-01-01", "a@b.fr"), ("u", "2024-01-02", "c@d.fr"), (None, "2024-01-02", "x@y.fr")],
                               "user_id string, crm_extract_date string, email string")
    assert rows(crm.build(df, SALT, "2024-01-03"), "user_id", "crm_extract_date") == [("u", "2024-01-02")]


def test_model_gate(spark, rows):
    metrics = spark.createDataFrame([("m2", 0.90)], "model_path string, f1_score double")
    weak = spark.createDataFrame([("m3", 0.8999)], "model_path string, f1_score double")
    champion = spark.createDataFrame([("m1", 0.95)], "model_path string, f1_score double")
    assert ml.choose(champion, metrics).first()["model_path"] == "m2"
    assert ml.choose(champion, weak).first()["model_path"] == "m1"
    assert ml.choose(None, weak).count() == 0


def test_training_learns_and_scores_unknown_categories(spark):
    df = spark.range(400).select(
        F.concat(F.lit("t"), "id").alias("transaction_id"), (F.col("id") % 10 == 0).alias("is_fraud"),
        F.when(F.col("id") % 10 == 0, 9.0).otherwise(F.when(F.col("id") % 7 != 0, 1.0)).alias("amount_vs_avg_ratio"),
        F.lit(1.0).alias("txn_count_5min"), F.lit(1.0).alias("txn_count_1h"), F.lit(1.0).alias("txn_count_30d"),
        F.lit(1.0).alias("avg_amount_30d"), F.lit(1.0).alias("amount_stddev_30d"), F.lit(1.0).alias("geo_distance_km"),
        F.lit("verified").alias("kyc_status"))
    model, prepared = ml.train(df, max_iter=5, max_depth=2)
    assert 0 < prepared.filter("is_test AND label = 1").count() < 40
    scored = ml.score(model, df.withColumn("kyc_status", F.lit("never seen")), "2024-01-01", "m1")
    low, high = scored.agg(F.min("fraud_probability"), F.max("fraud_probability")).first()
    assert 0 <= low < 0.5 < high <= 1
    metrics = ml.evaluate(scored.withColumn("label", F.col("is_fraud").cast("double"))).first()
    assert metrics["f1_score"] == 1.0 and metrics["roc_auc"] == 1.0
