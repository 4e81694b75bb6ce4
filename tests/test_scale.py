"""What steps move and store: columns that nobody reads stay behind, and rows that lie together are not moved again."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaarlake import constants as C
from bazaarlake.functions import skew, timeline
from bazaarlake.operators import fraud, ml, payments, training
from bazaarlake.plans import bindings as B
from bazaarlake.plans import catalogue
from bazaarlake.session import checkpointed
from bazaarlake.streaming import jobs


def timed(spark, n=300, users=7, seed=3):
    random.seed(seed)
    made = [(i, random.choice([None, *range(users)]), random.choice([None, *range(90)]), random.randrange(9),
             random.choice("abc") if i % 5 else None, f"wide-{i}") for i in range(n)]
    return spark.createDataFrame(made, "id int, u int, t long, v long, c string, wide string")


def test_windows_carry_only_what_is_read(spark):
    df = timed(spark).withColumn("bulk", F.upper("wide"))
    out = timeline.trailing(df, "u", "t", 10, {"s": F.col("v")}, {"d": "c"}, hot=[]).select("id", "s", "d")
    text = out._jdf.queryExecution().optimizedPlan().toString()
    assert "upper" not in text


def test_windows_inside_lying_rows_need_no_shuffle(spark, rows, plan):
    df = timed(spark).filter("u is not null").withColumn("actor", F.concat_ws("|", "u", "c"))
    apart = timeline.trailing(df, "actor", "t", 10, {"s": F.col("v")}, {"d": "c"}, hot=[])
    together = timeline.trailing(df.repartition("u"), "actor", "t", 10, {"s": F.col("v")}, {"d": "c"}, hot=[], lies="u")
    assert plan(together).count("Exchange") == 1
    assert rows(together, *apart.columns) == rows(apart, *apart.columns)


@pytest.mark.parametrize("chunk", [3, 40])
def test_swept_rows_are_read_once_and_equal_the_plain_route(spark, rows, chunk):
    df = timed(spark).withColumn("bulk", F.upper("wide"))
    values, distinct = {"s": F.nullif(F.col("v"), F.lit(4)), "n": F.lit(1)}, {"d": "c", "e": "v"}
    plain = timeline.trailing(df, "u", "t", 10, values, distinct, hot=[])
    swept = timeline.trailing(df, "u", "t", 10, values, distinct, chunk=chunk, hot="all")
    assert rows(swept, *plain.columns) == rows(plain, *plain.columns)
    assert "upper" not in swept._jdf.queryExecution().optimizedPlan().toString()


def test_neighbours_need_no_join(spark, rows, plan):
    df = timed(spark).filter("u is not null and t is not null").select("u", "t").distinct()
    got = timeline.neighbours(df, ["u"], "t", 5)
    assert "Join" not in plan(got)
    want = []
    for u in {r[0] for r in rows(df)}:
        line = sorted(t for v, t in rows(df) if v == u)
        want += [(u, t, line[k - 1] if k else None, line[k + 1] if k + 1 < len(line) else None) for k, t in enumerate(line)]
    assert rows(got, "u", "t", "_prev", "_next") == sorted(want, key=repr)


def test_keys_of_one_slot_are_counted_apart(spark, tmp_path, rows):
    random.seed(5)
    made = [(k, random.choice([None, "a", "b", "c", "d"]), 1_700_000_000 + random.randrange(200_000) // 7) for k in range(400)]
    events = spark.createDataFrame(made, "id long, u string, s long").select("id", "u", F.timestamp_seconds("s").alias("ts"))
    events.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    counted = jobs.exact_velocity(stream, "u", "ts", "id", 300, bucket_seconds=3_600, slots=2)
    jobs.start_append(counted, str(tmp_path / "out"), str(tmp_path / "state"), partition=()).awaitTermination()
    want = [(i, u, sum(1 for _, v, r in made if v == u and s - 300 <= r <= s)) for i, u, s in made]
    assert rows(spark.read.parquet(str(tmp_path / "out")), "id", "u", "velocity") == sorted(want, key=repr)


def test_scores_are_computed_once_for_a_curve(spark):
    scored = spark.createDataFrame([(0.5, 1.0), (0.2, 0.0), (0.5, 0.0)], "p double, label double").withColumn(
        "fraud_probability", F.abs("p"))
    text = training.precision_recall(scored)._jdf.queryExecution().optimizedPlan().toString()
    assert "abs(" not in text


def test_rules_take_bursts_that_are_there(spark, plan):
    made = [(f"t{k}", f"u{k % 3}", "m", 9.0, "FR", "FR", "FR", "1.1.1.1", "d", None, k, False, False, 30, "verified", False,
             False, 1.0, 1, 1, False, 5, 3) for k in range(6)]
    names = [*fraud.JUDGED, "burst_count", "burst_merchants"]
    df = spark.createDataFrame([dict(zip(names, r)) for r in made], ", ".join(
        f"{n} {k}" for n, k in zip(names, ["string"] * 3 + ["double"] + ["string"] * 5 + ["date", "long", "boolean", "boolean", "int",
                                                                         "string", "boolean", "boolean", "double", "long", "long", "boolean", "long", "long"])))
    df = df.withColumn("event_timestamp", F.timestamp_seconds("event_timestamp"))
    hits = fraud.rules(df.filter("amount_eur > 8"), hot=[])
    assert {r["rule"] for r in hits.collect()} == {"velocity_attack"}


def test_a_chain_takes_texts_one_by_one():
    toxicity = pytest.importorskip("bazaarlake.llm.toxicity")
    texts = [{"bad", "word", "one"} if k % 2 else {"good", "word", "two"} for k in range(40)] + [set()]
    labels = np.array([[k % 2 == 1] for k in range(40)] + [[False]])
    chain = toxicity.Chain((t for t in texts), labels)
    assert (chain.predict(["bad one", "good two"])[:, -1] >= chain.threshold).tolist() == [True, False]


def test_windows_double_no_row(spark, rows, plan):
    df = timed(spark).filter("u is not null")
    got = timeline.trailing(df, "u", "t", 10, {"s": F.col("v"), "n": F.lit(1)}, {"d": "c"}, hot=[])
    assert "Generate" not in plan(got)
    swept = timeline.trailing(df, "u", "t", 10, {"s": F.col("v"), "n": F.lit(1)}, {"d": "c"}, hot="all", chunk=7)
    assert rows(got, *swept.columns) == rows(swept)


def test_the_payments_table_moves_its_payload_as_one(spark, rows, plan):
    made = spark.range(60).select(
        F.concat(F.lit("t"), F.col("id") % 50).alias("transaction_id"), F.concat(F.lit("u"), F.col("id") % 3).alias("user_id"),
        (F.col("id") - 2).cast("double").alias("amount"), F.lit("EUR").alias("currency"), F.lit("paypal").alias("payment_method"),
        F.lit("p").alias("product_id"), F.lit("FR").alias("billing_country"), F.lit("be").alias("shipping_country"),
        F.lit("FR").alias("ip_country_inferred"), F.lit(True).alias("is_new_merchant"), F.lit("verified").alias("user_kyc_status"),
        F.lit(17).alias("user_age"), F.concat(F.lit("2024-01-"), 10 + F.col("id") % 15, F.lit("T10:00:00Z")).alias("timestamp"),
        F.concat(F.lit("m"), F.col("id") % 4).alias("merchant_id"), (F.col("id") % 9 == 0).alias("fraud_label_ground_truth"),
        F.lit("none").alias("fraud_scenario_label"), F.lit("o").alias("order_id"), F.lit("unread").alias("device"),
        F.timestamp_seconds("id").alias("ingested_at"))
    got = payments.build(made, "2024-03-01", hot=[])
    text = plan(got)
    assert text.count("Exchange hashpartitioning") == 2 and "_rest" in text and "Generate" not in text and "unread" not in text
    apart = payments.curated(payments.enrich(payments.split(payments.clean(payments.latest(made)))[0], hot=[]), "2024-03-01")
    assert rows(got) == rows(apart, *got.columns) and got.count() > 40


def test_heavy_users_are_found_without_the_messages(spark, tmp_path, plan):
    sf = str(tmp_path)
    spark.range(40).select(F.col("id").alias("o_orderkey"), (F.col("id") % 4).alias("o_custkey")).write.parquet(f"{sf}/orders.parquet")
    spark.range(200).select(F.when(F.col("id") < 120, 4).otherwise(F.col("id") % 50).alias("l_orderkey")).write.parquet(
        f"{sf}/lineitem.parquet")
    found = skew.hot_keys(B.payment_users(spark, sf), "user_id", 100, rows="rows")
    assert [r["user_id"] for r in found.collect()] == ["USR-000000"]
    assert skew.hot_keys(B.payment_users(spark, sf), "user_id", 200, rows="rows") == []


def test_trees_read_rows_that_are_stored_coded(spark, monkeypatch):
    made = [(f"t{i}", i % 3 == 0, float(i % 3), "a" if i % 2 else "b", None if i % 7 == 0 else float(i)) for i in range(300)]
    df = spark.createDataFrame(made, "transaction_id string, is_fraud boolean, amount_eur double, "
                                     f"{C.CATEGORICAL_FEATURES[0]} string, geo_distance_km double").withColumns(
        {c: F.hash(F.lit(c), "transaction_id") % 10 + 0.5 for c in C.NUMERIC_FEATURES if c not in ("amount_eur", "geo_distance_km")})
    stored = []
    monkeypatch.setattr(ml, "checkpointed", lambda d: (stored.append(d.columns), checkpointed(d))[1])
    model, rows = ml.train(df, max_iter=3, max_depth=2)
    assert stored == [["features", ml.LABEL, "weight", "is_test"]]
    whole = ml.build_pipeline(max_iter=3, max_depth=2).fit(rows)
    picked = [sorted((r["transaction_id"], round(r["fraud_probability"], 9)) for r in ml.score(m, df, "2024-03-01", "x").collect())
              for m in (model, whole)]
    assert picked[0] == picked[1]


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_stored_step_lets_go_of_its_shuffles(spark):
    before = shuffle_files(spark)
    moved = spark.range(5_000).groupBy((F.col("id") % 900).alias("k")).count()
    kept = checkpointed(moved)
    for _ in range(50):  # files go in the background
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert kept.count() == moved.count() == 900, "both can still be read"
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_messages_are_delivered_in_many_files(spark, tmp_path):
    base = str(tmp_path)
    spark.range(90).repartition(3).withColumn("part", F.col("id") % 2).write.partitionBy("part").parquet(f"{base}/staged")
    for part in range(2):
        B.deliver(spark, base, part)
        got = spark.read.parquet(f"{base}/topic")
        assert {r["id"] for r in got.collect()} == {i for i in range(90) if i % 2 <= part}
        assert len(got.inputFiles()) == 3 * (part + 1)


def marketplace(spark, sf):
    """A few order lines with all that they refer to."""
    made = {
        "lineitem": spark.range(400).select(
            (F.col("id") % 90).alias("l_orderkey"), (F.col("id") % 30).alias("l_partkey"), (F.col("id") % 20).alias("l_suppkey"),
            (F.col("id") % 7 + 1).cast("int").alias("l_linenumber"), (F.col("id") % 50 + 1.0).alias("l_quantity"),
            (F.col("id") * 7.5 + 1).alias("l_extendedprice"), (F.col("id") % 11 / 100).alias("l_discount"),
            (F.col("id") % 9 / 100).alias("l_tax"), F.when(F.col("id") % 3 == 0, "R").otherwise("A").alias("l_returnflag"),
            F.when(F.col("id") % 2 == 0, "O").otherwise("F").alias("l_linestatus")),
        "orders": spark.range(90).select(F.col("id").alias("o_orderkey"), (F.col("id") % 6).alias("o_custkey"),
                                         F.expr("timestamp'1995-01-01' + make_interval(0, 0, 0, int(id % 50))").alias("o_orderdate")),
        "customer": spark.range(6).select(
            F.col("id").alias("c_custkey"), F.format_string("n%d", "id").alias("c_name"), (F.col("id") % 25).cast("int").alias("c_nationkey"),
            F.lit(1.5).alias("c_acctbal"), F.lit("BUILDING").alias("c_mktsegment")),
        "supplier": spark.range(20).select(F.col("id").alias("s_suppkey"), (F.col("id") % 25).cast("int").alias("s_nationkey")),
        "part": spark.range(30).select(F.col("id").alias("p_partkey"), F.lit("name").alias("p_name"), F.lit("PROMO").alias("p_type"),
                                       (F.col("id") * 9.0).alias("p_retailprice")),
    }
    for name, rows in made.items():
        rows.write.parquet(f"{sf}/{name}.parquet")


def test_moves_by_transaction_and_by_user_do_not_lie_there_together(spark, tmp_path, rows, monkeypatch):
    sf, names, real = str(tmp_path), [], catalogue.stored
    marketplace(spark, sf)
    monkeypatch.setattr(catalogue, "stored", lambda s, d, name: (names.append((name, d.columns)), real(s, d, name))[1])
    facts = catalogue.facts(spark, sf)
    assert not names and facts.count() > 100
    got = catalogue.QUERIES["fact_orders"](spark, sf)
    assert rows(catalogue.comparable(facts), *got.columns) == rows(got)
    before = shuffle_files(spark)
    enriched, _ = catalogue.enriched_payments(spark, sf)
    plain = payments.enrich(catalogue.valid(spark, sf), hot=[])
    assert [n for n, _ in names] == ["valid", "valid", "enriched"] and "amount" not in names[1][1]
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert rows(enriched, *fraud.JUDGED) == rows(plain, *fraud.JUDGED)


def test_a_sweep_stores_its_steps(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(timeline, "checkpointed", lambda d: (stored.append(d.columns), checkpointed(d))[1])
    timeline.trailing(timed(spark).filter("u is not null"), "u", "t", 10, {"n": F.lit(1)}, {"d": "c"}, hot="all", chunk=7).count()
    assert stored == [["u", "_at", "d"], ["u", "t", "d", "n"]]


def test_the_model_is_trained_with_all_its_trees(spark, tmp_path, monkeypatch):
    sf, asked, real = str(tmp_path), [], ml.build_pipeline
    marketplace(spark, sf)
    monkeypatch.setattr(ml, "build_pipeline", lambda **options: (
        asked.append(real(**options).getStages()[-1]), real(max_iter=2, max_depth=2))[1])
    scored = catalogue.QUERIES["ml_train_score"](spark, sf)
    assert [(trees.getMaxIter(), trees.getMaxDepth()) for trees in asked] == [(500, 6)]
    assert scored.count() == catalogue.labelled(spark, sf).count()
