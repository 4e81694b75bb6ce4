"""Scoring from messages against a batch run over the newest valid versions; reruns, corrections, withdrawals, ledger."""

import json
import random

import pytest
from pyspark.sql import functions as F

from bazaarlake import schemas
from bazaarlake.operators import fraud
from bazaarlake.operators import payments as P
from bazaarlake.sources import streams
from bazaarlake.sources.bronze import parse_json
from bazaarlake.streaming import jobs, scoring

START = 1_709_000_000
COLUMNS = ["transaction_id", "user_id", "user_txn_count_30d", "user_avg_amount_30d", "amount_vs_avg_ratio",
           "velocity_count_5min", "is_first_transaction", "user_distinct_countries_30d", "user_distinct_merchants_30d",
           "rules_hit", "fraud_probability", "fraud_decision"]


def message(name, user, at, offset, **own):
    stamp = __import__("datetime").datetime.fromtimestamp(at, __import__("datetime").UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    row = {"transaction_id": name, "user_id": user, "amount": 20.0, "currency": "EUR", "billing_country": "FR",
           "shipping_country": "FR", "ip_country_inferred": "FR", "merchant_id": "M1", "timestamp": stamp, "user_age": 30,
           "ip_address": "78.1.1.1", "device_fingerprint": "d", "is_new_device": True, "is_adult_product": False} | own
    return (b"k", bytearray(json.dumps({k: v for k, v in row.items() if v is not None}).encode()), "payments-raw", 0, offset,
            START + offset)


def deliveries(seed):
    rng = random.Random(seed)
    day, offset, batches = 86_400, 0, []
    for batch in range(4):
        rows = []
        for _ in range(25):
            at = START + int(day * (batch * 12 + rng.uniform(-9, 9)))
            rows.append((f"t{rng.randint(0, 70)}", f"u{rng.randint(0, 4)}", at, offset, {
                "amount": rng.choice([5.0, 20.0, 250.0, -1.0, None]) if rng.random() < .4 else 20.0,
                "billing_country": rng.choice(["FR", "DE", "NG"]), "merchant_id": rng.choice(["M1", "M2"])}))
            offset += 1
        batches.append([message(*r[:4], **r[4]) for r in rows])
    batches[1].append((b"k", bytearray(b"{broken"), "payments-raw", 0, 900, START + 900))
    return batches


def send(spark, batch, path):
    ddl = "key binary, value binary, topic string, partition int, offset bigint, at bigint"
    spark.createDataFrame(batch, ddl).withColumn("timestamp", F.timestamp_seconds("at")).drop("at").coalesce(1).write.mode(
        "append").parquet(path)


def in_batch(spark, path):
    bronze = parse_json(spark.read.parquet(path), schemas.STREAMS["payments-raw"], "payments-raw", F.col("timestamp"))
    valid, _ = P.split(P.clean(P.latest(bronze)))
    return scoring.rule_scorer(fraud.add_burst(P.enrich(valid)))


def test_scores_equal_a_batch_run(spark, tmp_path, rows, monkeypatch):
    topic, base = str(tmp_path / "topic"), str(tmp_path / "tables")
    batches = deliveries(3)
    for batch in batches:
        send(spark, batch, topic)
    failures = [True]
    write = scoring.Store.write

    def failing(self, df, name, batch, partition=None):
        write(self, df, name, batch, partition)
        if batch == 2 and name == "scores" and failures:  # the batch ends before its progress is written, and runs again
            failures.pop()
            raise RuntimeError("lost")

    monkeypatch.setattr(scoring.Store, "write", failing)
    for attempt in range(2):
        query = scoring.start(streams.files(spark, topic, 1), base, str(tmp_path / "cp"), watermark_seconds=86_400)
        try:
            query.awaitTermination(600)
        except Exception as error:
            assert attempt == 0 and "lost" in str(error)
    want = in_batch(spark, topic)
    assert rows(scoring.scores(spark, base), *COLUMNS) == rows(want, *COLUMNS)
    done = {r["batch_id"]: r for r in scoring.progress(spark, base).collect()}
    assert [done[k]["rows_in"] for k in range(4)] == [25, 26, 25, 25] and done[1]["unreadable"] == 1
    assert sum(r["corrected"] for r in done.values()) > 0
    assert scoring.rejected(spark, base).filter("reject_reason = 'amount_not_positive'").count() > 0
    late = scoring.late(spark, base).select("batch_id", "event_timestamp").collect()
    assert late and all(r["event_timestamp"] < max(done[b]["newest"] for b in range(r["batch_id"])) for r in late)


def test_own_scorer(spark, tmp_path):
    topic, base = str(tmp_path / "topic"), str(tmp_path / "tables")
    send(spark, [message("a", "u", START, 1), message("b", "u", START + 60, 2)], topic)

    def by_count(rows):
        return rows.withColumn("fraud_probability", F.col("velocity_count_5min") / 10)

    scoring.start(streams.files(spark, topic), base, str(tmp_path / "cp"), scorer=by_count).awaitTermination(300)
    got = {r["transaction_id"]: r["fraud_probability"] for r in scoring.scores(spark, base).collect()}
    assert got == {"a": 0.1, "b": 0.2}


@pytest.mark.parametrize("gap", [1_799, 1_800, 1_801])
def test_open_sessions_join_the_closed_ones(spark, tmp_path, rows, gap):
    ddl, path = "k string, at int", str(tmp_path / "in")
    times = [0, gap, 2 * gap, 20_000, 20_000 + gap, 40_000, 40_000 + gap, 40_010]
    data = [(k, t) for k in ("a", "b") for t in times] + [("slow", 100 * j) for j in range(400)]
    events = spark.createDataFrame(data, ddl).withColumn("at", F.timestamp_seconds(F.col("at") + START))
    events.coalesce(1).write.parquet(path)
    stream = spark.readStream.schema(events.schema).parquet(path)
    query = jobs.start_append(jobs.session_stream(stream, "k", "at"), str(tmp_path / "out"), str(tmp_path / "cp"), partition=(),
                              name="sessions")
    query.awaitTermination(120)
    jobs.record(spark, query, str(tmp_path / "ledger"))
    jobs.record(spark, query, str(tmp_path / "ledger"))  # twice changes nothing
    seen = jobs.ledger(spark, str(tmp_path / "ledger"))
    assert seen.count() == seen.select("batch_id").distinct().count() and seen.agg(F.sum("rows_in")).first()[0] == len(data)
    want = jobs.session_stream(events, "k", "at")
    closed = spark.read.schema(want.schema).parquet(str(tmp_path / "out"))
    assert 0 < closed.count() < want.count()
    for hot in ([], "all"):
        assert rows(jobs.complete_sessions(closed, events, "k", "at", hot=hot), *want.columns) == rows(want)
    mark = jobs.last_watermark(spark, str(tmp_path / "ledger"), "sessions")
    assert mark is not None


def test_open_windows_join_the_closed_ones(spark, tmp_path, rows):
    ddl, path = "k string, at int", str(tmp_path / "in")
    events = spark.createDataFrame([("a", 37 * j) for j in range(200)], ddl).withColumn("at", F.timestamp_seconds(F.col("at") + START))
    events.coalesce(1).write.parquet(path)
    stream = spark.readStream.schema(events.schema).parquet(path)
    query = jobs.start_append(jobs.sliding_velocity(stream, "k", "at"), str(tmp_path / "out"), str(tmp_path / "cp"), partition=(),
                              name="windows")
    query.awaitTermination(120)
    jobs.record(spark, query, str(tmp_path / "ledger"))
    want = jobs.sliding_velocity(events, "k", "at")
    closed = spark.read.schema(want.schema).parquet(str(tmp_path / "out"))
    mark = jobs.last_watermark(spark, str(tmp_path / "ledger"), "windows")
    whole = jobs.complete_windows(closed, events, "at", "5 minutes", mark, lambda r: jobs.sliding_velocity(r, "k", "at"),
                                  F.col("window_end"))
    assert 0 < closed.count() < want.count() and rows(whole) == rows(want)
    nothing = jobs.complete_windows(closed.limit(0), events, "at", "5 minutes", None, lambda r: jobs.sliding_velocity(r, "k", "at"),
                                    F.col("window_end"))
    assert rows(nothing) == rows(want)


def test_names_of_the_caller_never_clash(spark, rows):
    from bazaarlake.functions.timeline import trailing

    names = ["_at", "_sign", "_move", "_row", "_of", "_moved_n", "_sum_n", "_held_n"]
    df = spark.createDataFrame([("u", t, *range(8)) for t in (0, 5, 20)], "k string, t int, " + ", ".join(f"{n} int" for n in names))
    out = trailing(df, "k", "t", 10, {"n": F.lit(1)}, hot=[])
    assert rows(out, "t", *names, F.col("n").cast("int")) == sorted([(0, *range(8), 1), (5, *range(8), 2), (20, *range(8), 1)], key=repr)


def test_payments_without_session(spark, rows):
    paid = spark.createDataFrame([("p1", "a", 100), ("p2", "a", 5_000), ("p3", "b", 50), ("p4", None, 50)],
                                 "transaction_id string, user_id string, t int").withColumn("event_timestamp", F.timestamp_seconds("t"))
    visits = spark.createDataFrame([("a", 90), ("a", 90), ("b", 51)], "user_id string, t int").withColumn(
        "session_start", F.timestamp_seconds("t"))
    assert rows(fraud.without_session(paid, visits, 3_600), "transaction_id") == [("p2",), ("p3",), ("p4",)]
