"""The training job: exact medians and a code for every category, boosted trees, a stop on precision-recall over all rows,
metrics of rows that neither trained nor stopped the model, and the pointer to the serving model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake import constants as C
from bazaarlake.functions import scalars as S
from bazaarlake.functions.ranking import running_totals
from bazaarlake.operators import ml, snapshots
from bazaarlake.session import checkpointed


def three_parts(df: DataFrame, id_column: str = "transaction_id", validation_percent: int = 15, test_percent: int = 15,
                seed: int = 42) -> DataFrame:
    """Add `part`: train, validation or test by an md5 bucket of (seed, class, id), the same share of every class."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.col(ml.LABEL).cast("int"), F.col(id_column)))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100
    return df.withColumn("part", F.when(bucket < test_percent, "test").when(
        bucket < test_percent + validation_percent, "validation").otherwise("train"))


def medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """(name, rows, median): the exact median of each column, NULL and NaN left out; no row for a column without values.

    Values are counted before they are sorted, so a value that fills a column is one row. The median of an even number
    of rows is the mean of the two in the middle.
    """
    long = df.select(F.inline(F.array(*(
        F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns))))
    counted = checkpointed(long.filter(F.col("value").isNotNull() & ~F.isnan("value")).groupBy("name", "value").agg(
        F.count(F.lit(1)).alias("n")))  # read by two steps: `df` is computed once
    placed = running_totals(counted, ["name"], [F.col("value")], ["n"])
    total = counted.groupBy("name").agg(F.sum("n").alias("rows"))
    lower, upper = F.floor((F.col("rows") - 1) / 2), F.floor(F.col("rows") / 2)
    first, end = F.col("before_n"), F.col("before_n") + F.col("n")
    middle = placed.join(total, "name").filter((first <= upper) & (end > lower))
    return middle.groupBy("name").agg(F.any_value("rows").alias("rows"), (
        (F.min("value") + F.max("value")) / 2).alias("median"))


def codes(df: DataFrame, columns: list[str], most: int | None = None) -> DataFrame:
    """(name, value, code): every value of each column in alphabetic order from 1; NULL has no code.

    A caller may ask for the `most` commonest values only, ties to the smaller one; the others then have no row.
    """
    long = df.select(F.inline(F.array(*(
        F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns))))
    kept = long.filter(F.col("value").isNotNull()).groupBy("name", "value").agg(
        F.count(F.lit(1)).alias("n"), F.lit(1).alias("one"))
    if most is not None:
        kept = running_totals(kept, ["name"], [F.col("n").desc(), F.col("value")], ["one"]).filter(F.col("before_one") < most)
    coded = running_totals(kept.select("name", "value", "one"), ["name"], [F.col("value")], ["one"])
    return coded.select("name", "value", (F.col("before_one") + 1).cast("int").alias("code"))


def encoder(rows: DataFrame, most: int | None = None) -> list:
    """Stages that fill gaps with the medians of `rows` and code its categories; all are saved with the model.

    Every category of `rows` has its code, looked up by hash; values that `rows` does not hold, or that `most` leaves
    out, have 0. Codes are plain numbers to the trees, so no number of bins has to hold every category. The model holds
    one text per category, as does the driver that saves it. A column without any value is filled with 0.
    """
    middle = {r["name"]: r["median"] for r in medians(rows, C.NUMERIC_FEATURES).collect()}  # one row per column
    known = checkpointed(codes(rows, C.CATEGORICAL_FEATURES, most))
    count = dict(known.groupBy("name").count().collect())
    places = [f"{c}_place" for c in C.CATEGORICAL_FEATURES]  # from 0; what has no code comes after the last
    looked = StringIndexer(inputCols=C.CATEGORICAL_FEATURES, outputCols=places, stringOrderType="alphabetAsc", handleInvalid="keep").fit(
        known.select(*(F.when(F.col("name") == c, F.col("value")).alias(c) for c in C.CATEGORICAL_FEATURES)))
    filled = [f"coalesce(`{c}`, {middle.get(c, 0.0)!r}D) AS `{c}_filled`" for c in C.NUMERIC_FEATURES]
    # An expression carries no list of categories along, so the trees see a number.
    coded = [f"if(`{c}_place` < {count.get(c, 0)}D, `{c}_place` + 1D, 0D) AS `{c}_code`" for c in C.CATEGORICAL_FEATURES]
    inputs = [f"{c}_filled" for c in C.NUMERIC_FEATURES] + [f"{c}_code" for c in C.CATEGORICAL_FEATURES]
    return [looked, SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(places)}), {', '.join(filled + coded)} FROM __THIS__"),
            VectorAssembler(inputCols=inputs + C.BINARY_FEATURES, outputCol="features")]


def precision_recall(scored: DataFrame, score: str = "fraud_probability", by: list[str] | None = None) -> DataFrame:
    """One row per distinct score: flagged rows and hits at or above it, precision and recall.

    Rows without score or label take no part. Equal scores are one threshold. A group without a positive has no recall.
    """
    groups = by or ["_all"]
    rows = (scored if by else scored.withColumn("_all", F.lit(0))).filter(
        F.col(score).isNotNull() & F.col(ml.LABEL).isNotNull())
    counted = checkpointed(rows.groupBy(*groups, F.col(score).alias("threshold")).agg(
        F.count_if(F.col(ml.LABEL) == 1).alias("n_hits"), F.count(F.lit(1)).alias("n_rows")))  # read by two steps
    placed = running_totals(counted, groups, [F.col("threshold").desc()], ["n_hits", "n_rows"])
    total = counted.groupBy(*groups).agg(F.sum("n_hits").alias("positives"), F.sum("n_rows").alias("total"))
    hits, flagged = F.col("before_n_hits") + F.col("n_hits"), F.col("before_n_rows") + F.col("n_rows")
    return placed.join(total, groups).select(
        *(by or []), "threshold", flagged.cast("bigint").alias("flagged"), hits.cast("bigint").alias("hits"), "positives", "total",
        F.col("n_hits").alias("new_hits"), F.col("n_rows").alias("new_rows"),
        (hits.cast("double") / flagged).alias("precision"),
        (hits.cast("double") / F.nullif(F.col("positives"), F.lit(0))).alias("recall"))


def ranking_metrics(curve: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(average_precision, roc_auc) of a `precision_recall` curve, exact with ties; NULL where a class is missing."""
    step = F.col("new_hits").cast("double") * F.col("precision") / F.nullif(F.col("positives"), F.lit(0))
    negatives = F.col("total") - F.col("positives")
    # Pairs (positive, negative) in the right order: positives above each threshold's negatives, half of those beside them.
    pairs = (F.col("new_rows") - F.col("new_hits")) * (F.col("hits") * 2 - F.col("new_hits"))
    return curve.groupBy(*(by or [])).agg(
        S.round_to(F.sum(step), 6).alias("average_precision"),
        S.round_to(F.sum(pairs).cast("double") / 2 / F.nullif(F.max(F.col("positives") * negatives), F.lit(0)), 6).alias("roc_auc"))


def _trees(model: GBTClassificationModel, first: int, last: int) -> GBTClassificationModel:
    """The trees from `first` up to `last` (exclusive) as a model of their own."""
    context = SparkSession.active().sparkContext
    jvm, java = context._jvm, context._gateway
    trees, weights = model._java_obj.trees(), model._java_obj.treeWeights()
    some = java.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, last - first)
    weighed = java.new_array(java.jvm.double, last - first)
    for i in range(first, last):
        some[i - first], weighed[i - first] = trees[i], weights[i]
    made = jvm.org.apache.spark.ml.classification.GBTClassificationModel(model.uid, some, weighed, model.numFeatures, 2)
    return GBTClassificationModel(made).setFeaturesCol("features")


def staged_scores(model: GBTClassificationModel, rows: DataFrame, every: int) -> DataFrame:
    """(trees, label, margin): every row once per stage, a stage being the first `every`, 2 * `every`, ... trees.

    The margin of an ensemble is a sum over its trees, so each block of trees is evaluated once and the stages add up.
    """
    count, out, margin, cells = model.getNumTrees, rows.select(ml.LABEL, "features"), F.lit(0.0), []
    for first in range(0, count, every):
        last = min(first + every, count)
        block = _trees(model, first, last).setRawPredictionCol(f"_raw{first}").setPredictionCol("").setProbabilityCol("")
        out = block.transform(out)
        margin = margin + vector_to_array(f"_raw{first}").getItem(1)
        cells.append(F.struct(F.lit(last).alias("trees"), margin.alias("margin")))
    return out.select(ml.LABEL, F.inline(F.array(*cells)))


@dataclass
class Trained:
    model: PipelineModel
    stages: DataFrame  # (trees, average_precision, roc_auc) on the validation part
    metrics: DataFrame  # one row on the test part


def train(features: DataFrame, max_iter: int = 500, max_depth: int = 6, step: float = 0.05, every: int = 10,
          seed: int = 42, most_codes: int | None = None, max_bins: int = 64) -> Trained:
    """Fit on the train part, keep the number of trees with the best average precision on the validation part (the
    fewest trees of equals), and measure on the test part. Rows without a label take no part.

    `max_bins` is how finely the trees cut a number, not how many categories there may be. Besides the medians and
    codes only one row per stage reaches the driver.
    """
    rows = checkpointed(ml.with_weights(three_parts(ml.prepare(features.filter(F.col("is_fraud").isNotNull())))))
    learn, check, test = (rows.filter(F.col("part") == p) for p in ("train", "validation", "test"))
    stages = encoder(learn, most_codes)
    ready = PipelineModel(stages=stages)
    trees = GBTClassifier(
        featuresCol="features", labelCol=ml.LABEL, weightCol="weight", maxIter=max_iter, maxDepth=max_depth, stepSize=step,
        subsamplingRate=0.8, featureSubsetStrategy="0.8", minInstancesPerNode=3, maxBins=max_bins, seed=seed,
        cacheNodeIds=False).fit(ready.transform(learn))
    curve = precision_recall(staged_scores(trees, ready.transform(check), every), "margin", ["trees"])
    judged = checkpointed(ranking_metrics(curve, ["trees"]))
    best = judged.orderBy(F.col("average_precision").desc_nulls_last(), "trees").first()
    model = PipelineModel(stages=[*stages, _trees(trees, 0, best["trees"] if best else trees.getNumTrees)])
    return Trained(model, judged, measure(ml.score(model, test, None, "test")))


def measure(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row: confusion counts, precision, recall, F1, average precision and the area under the ROC curve."""
    ranked = ranking_metrics(precision_recall(scored)).first()
    return ml.confusion(scored, threshold).withColumns({n: F.lit(ranked[n]).cast("double") for n in ranked.asDict()})


def publish(spark: SparkSession, trained: Trained, folder: str, version: str, at) -> str | None:
    """Store the model, its metrics and, if it passes the gate, the serving pointer; returns the serving model's path.

    `metrics` has one row per version, so a training that runs again replaces its own. `serving` has one row; it changes
    after the model is whole, in one swap. Readers ask it through `serving`.
    """
    path = f"{folder}/models/{version}"
    trained.model.write().overwrite().save(path)
    row = ml.gate(trained.metrics).select(
        F.lit(version).alias("version"), F.lit(path).alias("model_path"), S.as_timestamp(at).alias("trained_at"),
        S.as_timestamp(at).cast("date").alias("trained_on"), "*")
    row = checkpointed(row)
    snapshots.upsert(spark, row, f"{folder}/metrics", ["version"], "trained_on")
    known = snapshots.manifest(spark, f"{folder}/serving")
    champion = snapshots.read(spark, f"{folder}/serving") if known else None
    chosen = checkpointed(ml.choose(champion, row).withColumn("slot", F.lit("fraud")))
    if not chosen.isEmpty():
        snapshots.publish(spark, chosen, f"{folder}/serving", "slot", expected=known.version if known else 0)
    return serving(spark, folder)


def serving(spark: SparkSession, folder: str) -> str | None:
    """The path of the model that scores; None before the first one passed the gate."""
    if snapshots.manifest(spark, f"{folder}/serving") is None:
        return None
    return snapshots.read(spark, f"{folder}/serving").first()["model_path"]
