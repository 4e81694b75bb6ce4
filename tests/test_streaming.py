import threading

from pyspark.sql import functions as F

from bazaarlake.operators import ml
from bazaarlake.streaming import jobs


def write(spark, path, data, ddl):
    """One file per call, so that each becomes its own micro-batch."""
    timed = spark.createDataFrame(data, ddl).withColumn("at", F.timestamp_seconds(F.col("at") + 1_700_000_000))
    timed.coalesce(1).write.mode(
        "append").parquet(path)


def stream(spark, path, ddl):
    schema = spark.createDataFrame([], ddl).withColumn("at", F.timestamp_seconds("at")).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def drain(spark, df, tmp_path, name="out"):
    out = str(tmp_path / name)
    query = jobs.start_append(df, out, str(tmp_path / f"{name}-cp"), partition=())
    query.awaitTermination(120)
    assert query.exception() is None
    return spark.read.schema(df.schema).parquet(out)


DDL = "id string, k string, at int"


def test_exact_velocity_across_batches_and_restart(spark, tmp_path, rows):
    path = str(tmp_path / "in")
    times = [0, 100, 100, 301, 400, 401, 1500]
    for i, t in enumerate(times[:4]):
        write(spark, path, [(f"e{i}", "a", t), (f"x{i}", "b", t)], DDL)
    df = jobs.exact_velocity(stream(spark, path, DDL), "k", "at", "id", bucket_seconds=400)
    drain(spark, df, tmp_path)
    for i, t in enumerate(times[4:], 4):
        write(spark, path, [(f"e{i}", "a", t)], DDL)
    got = rows(drain(spark, df, tmp_path).filter("k = 'a'"), "id", "velocity")
    late_free = [sum(1 for j, u in enumerate(times) if j <= i and t - 300 <= u <= t) for i, t in enumerate(times)]
    assert got == [(f"e{i}", v) for i, v in enumerate(late_free)]


def test_repeat_delivery_is_dropped(spark, tmp_path, rows):
    path = str(tmp_path / "in")
    write(spark, path, [("a", "k", 0), ("b", "k", 10)], DDL)
    write(spark, path, [("a", "k", 0), ("c", "k", 20)], DDL)
    out = drain(spark, jobs.deduplicated(stream(spark, path, DDL), "id", "at"), tmp_path)
    assert rows(out, "id") == [("a",), ("b",), ("c",)]


def test_late_rows_go_to_the_side_table(spark, tmp_path, rows):
    path, base = str(tmp_path / "in"), tmp_path / "tables"
    write(spark, path, [("a", "k", 10_000)], DDL)
    write(spark, path, [("b", "k", 9_000), ("late", "k", 100), ("c", "k", 10_500)], DDL)
    good, side = str(base / "good"), str(base / "late")

    def newest():
        try:
            return spark.read.parquet(good).agg(F.max("at")).first()[0]
        except Exception:
            return None

    write_batch = jobs.route_late("at", 3_600, lambda d, i: d.write.mode("append").parquet(good),
                                  lambda d, i: d.write.mode("append").parquet(side), newest)
    query = stream(spark, path, DDL).writeStream.foreachBatch(write_batch).option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert rows(spark.read.parquet(good), "id") == [("a",), ("b",), ("c",)]
    assert rows(spark.read.parquet(side), "id") == [("late",)]


def test_bronze_stream_equals_batch_and_restarts(spark, tmp_path, rows):
    path = str(tmp_path / "topic")

    def send(offset, text):
        spark.createDataFrame([(b"k", bytearray(text, "utf8"), "payments-raw", 0, offset)],
                              "key binary, value binary, topic string, partition int, offset bigint").withColumn(
            "timestamp", F.current_timestamp()).coalesce(1).write.mode("append").parquet(path)

    from bazaarlake.sources import streams
    send(1, '{"transaction_id":"a","amount":2.0}')
    send(2, "broken")
    log = jobs.ProgressLog()
    spark.streams.addListener(log)
    for _ in range(2):
        [query] = jobs.start_bronze({"payments-raw": streams.files(spark, path, 1)}, str(tmp_path / "lake"),
                                    str(tmp_path / "cp"), once=True)
        query.awaitTermination(120)
        send(3, '{"transaction_id":"b"}')
        table = jobs.progress_table(spark, [query])
    out = spark.read.parquet(str(tmp_path / "lake" / "bronze" / "payments"))
    assert rows(out, "kafka_offset", "_parse_error") == [(1, False), (2, True), (3, False)]
    assert {"year", "month", "day"} <= set(out.columns) and table.first()["query"] == "payments-raw"
    spark.streams.removeListener(log)
    assert threading.active_count() > 0


def test_country_mismatch_joins_within_the_week(spark, tmp_path, rows):
    paid, sent = str(tmp_path / "p"), str(tmp_path / "s")
    write(spark, paid, [("o1", "FR", 0), ("o2", "FR", 0), ("o3", "FR", 0)], "order_id string, billing_country_iso string, at int")
    write(spark, sent, [("o1", "NG", 50), ("o2", "FR", 50), ("o3", "NG", 10 * 86_400)], "order_id string, delivery_country string, at int")
    p = stream(spark, paid, "order_id string, billing_country_iso string, at int").withColumnRenamed("at", "event_timestamp")
    s = stream(spark, sent, "order_id string, delivery_country string, at int").withColumnRenamed(
        "at", "event_timestamp").withColumn("event_id", F.lit("e"))
    assert rows(drain(spark, jobs.matched_deliveries(p, s), tmp_path), "order_id") == [("o1",)]


def test_stream_scoring_equals_batch(spark, tmp_path, rows):
    train = spark.range(200).select(
        F.concat(F.lit("t"), "id").alias("transaction_id"), (F.col("id") % 5 == 0).alias("is_fraud"),
        F.when(F.col("id") % 5 == 0, 5.0).otherwise(1.0).alias("amount_vs_avg_ratio"), *[
            F.lit(1.0).alias(c) for c in ("txn_count_5min", "txn_count_1h", "txn_count_30d", "avg_amount_30d",
                                          "amount_stddev_30d", "geo_distance_km")])
    model, _ = ml.train(train, max_iter=3, max_depth=2)
    path = str(tmp_path / "f")
    train.drop("is_fraud").write.parquet(path)
    features = spark.readStream.schema(train.drop("is_fraud").schema).parquet(path)
    scored = jobs.score(model, features, "m1")
    out = drain(spark, scored, tmp_path)
    batch = ml.score(model, train.drop("is_fraud"), "2024-01-01", "m1")
    assert rows(out, "transaction_id", "fraud_decision") == rows(batch, "transaction_id", "fraud_decision")
    assert {"year", "month", "day", "scored_at", "model_version"} <= set(out.columns)
