import random
import statistics

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from bazaarlake import constants as C
from bazaarlake.functions.ranking import running_totals
from bazaarlake.operators import ml, snapshots, training
from bazaarlake.sources import claims


def test_running_totals_against_a_loop(spark):
    dice = random.Random(3)
    data = [(dice.choice("aaaaab"), i, dice.choice([1, 2, None])) for i in range(300)]
    df = spark.createDataFrame(data, "g string, at int, n int").repartition(7)
    got = {(r["g"], r["at"]): r["before_n"] for r in running_totals(df, ["g"], [F.col("at")], ["n"]).collect()}
    for g, at, _ in data:
        assert got[g, at] == sum(n or 0 for h, b, n in data if h == g and b < at)
    assert running_totals(df.limit(0), ["g"], [F.col("at")], ["n"]).count() == 0


def test_medians_are_exact(spark):
    dice = random.Random(1)
    values = [(dice.choice([None, 1.0, 2.5, float("nan"), 7.0]), float(i % 13)) for i in range(101)]
    df = spark.createDataFrame(values, "a double, b double").withColumn("c", F.lit(None).cast("double"))
    got = {r["name"]: (r["rows"], r["median"]) for r in training.medians(df, ["a", "b", "c"]).collect()}
    a = [v for v, _ in values if v is not None and v == v]
    assert got == {"a": (len(a), statistics.median(a)), "b": (101, statistics.median([v for _, v in values]))}
    assert training.medians(df.limit(0), ["a", "b"]).count() == 0


def test_codes_keep_the_commonest_values(spark):
    df = spark.createDataFrame([(v,) for v in "bbbaaacdd"] + [(None,)], "v string")
    assert {r["value"]: r["code"] for r in training.codes(df, ["v"], 3).collect()} == {"a": 1, "b": 2, "d": 3}
    assert {r["value"]: r["code"] for r in training.codes(df, ["v"], 2).collect()} == {"a": 1, "b": 2}


def test_no_category_is_left_without_a_code(spark):
    df = spark.range(2_500).select(F.format_string("v%05d", "id").alias(C.CATEGORICAL_FEATURES[0]), *(
        F.lit(None).cast("string").alias(c) if i else F.lit("it's \\ odd").alias(c)
        for i, c in enumerate(C.CATEGORICAL_FEATURES[1:])), *(F.lit(1.0).alias(c) for c in C.NUMERIC_FEATURES),
        *(F.lit(0.0).alias(c) for c in C.BINARY_FEATURES))
    name = C.CATEGORICAL_FEATURES[0]
    got = {r["value"]: r["code"] for r in training.codes(df, [name]).collect()}
    assert got == {f"v{i:05d}": i + 1 for i in range(2_500)}
    out = PipelineModel(stages=training.encoder(df)).transform(df.union(df.limit(1).withColumn(name, F.lit("new"))))
    seen = {r[name]: (r[f"{name}_code"], r["features"][8], r["features"][9]) for r in out.collect()}
    assert seen == {**{v: (float(k), 1.0, 0.0) for v, k in got.items()}, "new": (0.0, 1.0, 0.0)}
    few = PipelineModel(stages=training.encoder(df.union(df.filter(F.col(name) > "v02489")), 10)).transform(df)
    assert few.filter(F.col(f"{name}_code") > 0).count() == 10


def brute_metrics(pairs):
    positives = sum(y for _, y in pairs)
    average = 0.0
    for t in {s for s, _ in pairs}:
        above = [y for s, y in pairs if s >= t]
        average += sum(y for s, y in pairs if s == t) / positives * sum(above) / len(above)
    won = sum((a > b) + (a == b) / 2 for a, y in pairs if y for b, z in pairs if not z)
    return average, won / positives / (len(pairs) - positives)


def test_ranking_metrics_against_brute_force(spark):
    dice = random.Random(2)
    data = [(g, round(dice.random(), 1 + g), float(dice.random() < 0.3)) for g in (0, 1) for _ in range(120)]
    df = spark.createDataFrame(data, "g int, fraud_probability double, label double")
    curve = training.precision_recall(df, by=["g"])
    got = {r["g"]: r for r in training.ranking_metrics(curve, ["g"]).collect()}
    for g in (0, 1):
        average, area = brute_metrics([(s, y) for h, s, y in data if h == g])
        assert abs(got[g]["average_precision"] - average) < 1e-5 and abs(got[g]["roc_auc"] - area) < 1e-5
    nothing = training.ranking_metrics(training.precision_recall(df.filter("label = 0"))).first()
    assert nothing["average_precision"] is None and nothing["roc_auc"] is None
    empty = training.ranking_metrics(training.precision_recall(df.limit(0))).first()
    assert empty["average_precision"] is None


@pytest.fixture(scope="module")
def features(spark):
    noise = F.pmod(F.xxhash64("id"), F.lit(100)) / 100.0
    return spark.range(1_500).select(
        F.concat(F.lit("t"), "id").alias("transaction_id"), (F.col("id") % 10 == 0).alias("is_fraud"),
        F.when(F.col("id") % 7 != 0, F.when(F.col("id") % 10 == 0, noise + 0.4).otherwise(noise)).alias("amount_vs_avg_ratio"),
        noise.alias("geo_distance_km"), F.lit("it's \\ odd").alias("kyc_status"), F.col("id").cast("string").alias("category_id"))


def test_training_keeps_the_best_stage(spark, features, tmp_path):
    done = training.train(features, max_iter=7, max_depth=3, every=3, most_codes=40)
    stages = {r["trees"]: r["average_precision"] for r in done.stages.collect()}
    assert set(stages) == {3, 6, 7}
    best = min(t for t, p in stages.items() if p == max(stages.values()))
    assert done.model.stages[-1].getNumTrees == best
    rows = training.three_parts(ml.prepare(features))
    check = ml.score(done.model, rows.filter("part = 'validation'"), "2024-01-01", "m")
    again = training.ranking_metrics(training.precision_recall(check)).first()["average_precision"]
    assert abs(again - stages[best]) < 1e-6, "the saved trees are those that were judged"
    metrics = done.metrics.first()
    tested = rows.filter("part = 'test'").count()
    assert metrics["tp"] + metrics["fp"] + metrics["fn"] + metrics["tn"] == tested and metrics["average_precision"] > 0.1

    folder = str(tmp_path)
    assert training.serving(spark, folder) is None
    weak = training.Trained(done.model, done.stages, done.metrics.withColumn("f1_score", F.lit(0.1)))
    good = training.Trained(done.model, done.stages, done.metrics.withColumn("f1_score", F.lit(0.95)))
    assert training.publish(spark, weak, folder, "v1", "2024-01-01") is None
    path = training.publish(spark, good, folder, "v2", "2024-01-02")
    assert path.endswith("/models/v2")
    assert training.publish(spark, weak, folder, "v3", "2024-01-03") == path, "a weak model leaves the serving one"
    assert training.publish(spark, weak, folder, "v3", "2024-01-03") == path
    assert snapshots.read(spark, f"{folder}/metrics").count() == 3
    loaded = PipelineModel.load(path)
    pick = ["transaction_id", "fraud_probability"]
    one = ml.score(loaded, features.withColumn("kyc_status", F.lit("new")), "2024-01-01", "m").select(pick)
    two = ml.score(done.model, features.withColumn("kyc_status", F.lit("other")), "2024-01-01", "m").select(pick)
    assert one.exceptAll(two).isEmpty() and one.count() == 1_500


def files_of(spark, n):
    return spark.range(n).select(F.concat(F.lit("u/"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("path"),
                                 F.timestamp_seconds(F.col("id")).alias("modificationTime"))


def paths(df):
    return {int(r["path"][2:]) for r in df.collect()}


def test_runs_never_share_a_document(spark, tmp_path):
    files, folder = files_of(spark, 130).unionByName(files_of(spark, 5)), str(tmp_path / "ledger")
    assert claims.ledger(spark, folder).count() == 0
    one = claims.claim(spark, files, folder, "a", "2024-01-01 00:00:00")
    assert paths(one) == set(range(50))
    assert paths(claims.claim(spark, files, folder, "a", "2024-01-01 00:10:00")) == set(range(50)), "a restarted run"
    claims.finish(spark, one.filter("path < 'u/0030'"), folder, "a", "2024-01-01 01:00:00")
    claims.finish(spark, one.filter("path = 'u/0031'"), folder, "a", "2024-01-01 01:00:00", "failed")
    assert paths(claims.claim(spark, files, folder, "b", "2024-01-01 02:00:00", 3)) == {50, 51, 52}, "31 failed and queues again at the end"
    late = claims.claim(spark, files, folder, "c", "2024-01-02 02:00:00", 200)
    assert paths(late) == set(range(30, 130))
    claims.finish(spark, one, folder, "a", "2024-01-02 03:00:00")
    assert claims.ledger(spark, folder).filter("run = 'a' AND state = 'done'").count() == 30, "lost claims stay with c"
    claims.finish(spark, late, folder, "c", "2024-01-02 04:00:00")
    assert claims.claim(spark, files, folder, "d", "2024-03-01 00:00:00").isEmpty()
    assert claims.ledger(spark, folder).groupBy("path").count().filter("count > 1").isEmpty()


def test_the_loser_of_a_race_chooses_again(spark, tmp_path, monkeypatch):
    files, folder = files_of(spark, 20), str(tmp_path / "ledger")
    real, calls = claims.pending_documents, []

    def slow(*args):
        calls.append(1)
        if len(calls) == 1:
            claims.claim(spark, files, folder, "fast", "2024-01-01 00:00:00", 8)
        return real(*args)

    monkeypatch.setattr(claims, "pending_documents", slow)
    assert paths(claims.claim(spark, files, folder, "slow", "2024-01-01 00:00:00", 8)) == set(range(8, 16))
    assert claims.ledger(spark, folder).count() == 16


def test_expected_version(spark, tmp_path):
    path, rows = str(tmp_path / "t"), spark.createDataFrame([(1, "a")], "k int, p string")
    snapshots.upsert(spark, rows, path, ["k"], "p", expected=0)
    with pytest.raises(snapshots.Conflict):
        snapshots.upsert(spark, rows, path, ["k"], "p", expected=0)
    assert snapshots.upsert(spark, rows, path, ["k"], "p", expected=1) == 2
