"""Lapse classifier: training, comparison, versions, scoring and explanation.

Every fit runs as Spark jobs; only parameters and metrics reach the driver.
"""

from __future__ import annotations

import itertools
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import (IDF, BucketedRandomProjectionLSH, HashingTF, OneHotEncoder,
                                StringIndexer, VectorAssembler)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from beaconry.operators.ordering import global_row_number
from beaconry.operators.trees import staged_scores
from beaconry.session import values
from beaconry.sources.tables import append_rows

# The nine numeric features.
FEATURES = ["wealth_signal_score", "tenure_days", "frequency_lifetime", "frequency_last_12m",
            "monetary_total", "avg_gift_amount", "recency_days", "engagement_count", "engagement_last_6m"]


def baseline_stages(categorical: list[str], numeric: list[str], label: str) -> Pipeline:
    """Logistic regression with one-hot categories; unseen ones get their own slot."""
    return Pipeline(stages=[
        StringIndexer(inputCols=categorical, outputCols=[f"{c}_ix" for c in categorical], handleInvalid="keep"),
        OneHotEncoder(inputCols=[f"{c}_ix" for c in categorical], outputCols=[f"{c}_oh" for c in categorical]),
        VectorAssembler(inputCols=[f"{c}_oh" for c in categorical] + numeric, outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol=label, maxIter=100, standardization=True)])


def boosted_stages(label: str, features: list[str] = FEATURES, n_trees: int = 20, max_depth: int = 4,
                   learning_rate: float = 0.1) -> Pipeline:
    return Pipeline(stages=[
        VectorAssembler(inputCols=features, outputCol="features"),
        GBTClassifier(featuresCol="features", labelCol=label, maxIter=n_trees, maxDepth=max_depth,
                      stepSize=learning_rate, seed=42)])


def score(model: Model, rows: DataFrame, key: str, keep: list[str] = ()) -> DataFrame:
    """Probability of the positive class and the predicted class."""
    out = model.transform(rows)
    return out.select(key, *keep, vector_to_array("probability")[1].alias("pred_lapse"),
                      F.col("prediction").cast("int").alias("predicted"))


def evaluate(model: Model, valid: DataFrame, label: str) -> dict[str, float]:
    """AUC on the probability, F1 on the class."""
    scored = model.transform(valid)
    auc = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction")
    f1 = MulticlassClassificationEvaluator(labelCol=label, metricName="fMeasureByLabel", metricLabel=1.0)
    return {"val_auc": float(auc.evaluate(scored)), "val_f1": float(f1.evaluate(scored))}


def candidate_runs(train: DataFrame, valid: DataFrame, label: str,
                   candidates: list[dict[str, float]]) -> tuple[PipelineModel, dict[str, float], DataFrame]:
    """The fitted model of the best run, its metrics, and one row per run.

    Runs differ in their parameters only; ``is_best`` marks the top validation AUC.
    """
    rows, fitted = [], {}
    for i, params in enumerate(candidates, 1):
        model = boosted_stages(label, **params).fit(train)
        got = evaluate(model, valid, label)
        fitted[f"candidate_{i}"] = model, got
        rows.append((f"candidate_{i}", int(params["n_trees"]), int(params["max_depth"]),
                     float(params["learning_rate"]), got["val_auc"], got["val_f1"]))
    best = max(rows, key=lambda r: (r[4], r[0]))[0]
    return *fitted[best], values(train.sparkSession, [(*r, r[0] == best) for r in rows],
                  "run_name, n_trees, max_depth, learning_rate, val_auc, val_f1, is_best")


def stage_quality(scored: DataFrame, label: str, keys: list[str]) -> DataFrame:
    """F1 of the positive class per ``keys`` at a probability above one half."""
    hit = (F.col("p") > 0.5).cast("int")
    actual = F.col(label).cast("int")
    return (scored.groupBy(*keys).agg(F.sum(hit * actual).alias("tp"), F.sum(hit + actual).alias("both"))
            .select(*keys, F.when(F.col("both") > 0, 2 * F.col("tp") / F.col("both")).otherwise(0.0).alias("f1")))


def grid_search(train: DataFrame, label: str, grid: dict[str, list], folds: int = 3, parallelism: int = 4,
                key: str = "c_custkey", features: list[str] = FEATURES) -> tuple[Model, DataFrame]:
    """Cross-validated grid on F1: the best model refitted on all rows, and one row per point.

    Boosting adds trees one by one, so one fit with the largest ``n_trees`` holds the
    models of all smaller numbers: each fold fits once per other setting and is
    scored after every number of trees. Folds are a hash of ``key``.
    """
    settings = [dict(zip(("max_depth", "learning_rate"), s)) for s in itertools.product(grid["max_depth"], grid["learning_rate"])]
    stages = sorted(grid["n_trees"])
    marked = train.withColumn("_fold", F.pmod(F.xxhash64(F.col(key), F.lit("fold")), F.lit(folds)))

    def fit(job: tuple[int, dict]) -> list[tuple]:
        fold, setting = job
        model = boosted_stages(label, features, n_trees=stages[-1], **setting).fit(marked.filter(F.col("_fold") != fold))
        scored = staged_scores(model, marked.filter(F.col("_fold") == fold), [label], features, stages)
        return [(r["n_trees"], *setting.values(), r["f1"]) for r in stage_quality(scored, label, ["n_trees"]).collect()]

    jobs = [(fold, setting) for setting in settings for fold in range(folds)]
    with ThreadPoolExecutor(parallelism) as pool:
        got = [row for rows in pool.map(inheritable_thread_target(train.sparkSession)(fit), jobs) for row in rows]
    points: dict[tuple, list[float]] = {}
    for *point, f1 in got:
        points.setdefault(tuple(point), []).append(f1)
    mean = {p: sum(v) / folds for p, v in sorted(points.items())}
    best = max(mean, key=mean.get)
    rows = [(*p, f1, p == best) for p, f1 in mean.items()]
    refitted = boosted_stages(label, features, **dict(zip(("n_trees", "max_depth", "learning_rate"), best))).fit(train)
    return refitted, values(train.sparkSession, rows, "n_trees, max_depth, learning_rate, f1, is_best")


def feature_importance(model: PipelineModel, spark: SparkSession, features: list[str] = FEATURES) -> DataFrame:
    weights = model.stages[-1].featureImportances
    return values(spark, [(n, float(weights[i])) for i, n in enumerate(features)], "feature, importance")


def save_version(model: PipelineModel, spark: SparkSession, root: str, name: str, version: str,
                 metrics: dict[str, float], at: datetime, default: bool = True) -> DataFrame:
    """Write the model under name/version and append its metrics to the runs table."""
    model.write().save(f"{root}/{name}/{version}")
    row = values(spark, [(name, version, metrics["val_auc"], metrics["val_f1"], default, at.isoformat())],
                 "name, version, val_auc, val_f1, is_default, registered_at")
    return append_rows(row.withColumn("registered_at", F.col("registered_at").cast("timestamp_ntz")),
                       f"{root}/{name}/runs")


def load_default(spark: SparkSession, root: str, name: str) -> PipelineModel:
    """The version registered last as default."""
    runs = spark.read.parquet(f"{root}/{name}/runs").filter("is_default")
    version = runs.agg(F.max_by("version", F.struct("registered_at", "version"))).first()[0]
    return PipelineModel.load(f"{root}/{name}/{version}")


def sampled_attribution(model: PipelineModel, rows: DataFrame, background: DataFrame, key: str,
                        features: list[str], draws: int = 16) -> DataFrame:
    """Shapley values by sampled feature orders, for any model.

    Each draw switches the features of a background row to those of the
    explained row, one by one in a hashed order; the change of the prediction at
    each switch is credited to that feature. The values of a row add up to its
    prediction minus the mean prediction of the background rows drawn for it.
    Draws come from all of ``background``, numbered in a hashed order; more draws
    bring the values closer to those relative to its mean.
    """
    d = len(features)
    numbered = global_row_number(
        background.select(key, F.array(*[F.col(f).cast("double") for f in features]).alias("_bg")),
        [F.xxhash64(key), F.col(key)], "_place")
    base = numbered.select((F.col("_place") - 1).alias("_pick"), "_bg")
    size = background.agg(F.count("*")).scalar()
    drawn = (rows.select(key, F.array(*[F.col(f).cast("double") for f in features]).alias("_x"))
             .select("*", F.explode(F.sequence(F.lit(0), F.lit(draws - 1))).alias("_draw"))
             .withColumn("_n", size)
             .withColumn("_pick", F.pmod(F.xxhash64(key, "_draw"), F.col("_n")))
             .join(base, "_pick"))
    places = F.array(*[F.struct(F.xxhash64(F.col(key), F.col("_draw"), F.lit(i)).alias("h"), F.lit(i).alias("i"))
                       for i in range(d)])
    ordered = drawn.withColumn("_order", F.transform(F.array_sort(places), lambda p: p["i"]))
    steps = ordered.select("*", F.explode(F.sequence(F.lit(0), F.lit(d))).alias("_step"))
    mixed = steps.select(
        key, "_draw", "_step", F.when(F.col("_step") > 0, F.get("_order", F.col("_step") - 1)).alias("_i"),
        *[F.when(F.array_position("_order", i) <= F.col("_step"), F.get("_x", F.lit(i)))
          .otherwise(F.get("_bg", F.lit(i))).alias(f) for i, f in enumerate(features)])
    p = model.transform(mixed).select(key, "_draw", "_step", "_i", vector_to_array("probability")[1].alias("_p"))
    change = F.col("_p") - F.lag("_p").over(W.partitionBy(key, "_draw").orderBy("_step"))
    names = F.array(*[F.lit(f) for f in features])
    return (p.withColumn("_delta", change).filter(F.col("_step") > 0)
            .groupBy(key, F.get(names, F.col("_i")).alias("feature"))
            .agg((F.sum("_delta") / draws).alias("phi")))


def hashed_counts(rows: DataFrame, words: str, out: str, dims: int = 1 << 18) -> DataFrame:
    """Sparse vector of how often each hashed word occurs, in place of the words."""
    return HashingTF(inputCol=words, outputCol=out, numFeatures=dims).transform(rows).drop(words)


def hashed_embedding(rows: DataFrame, words: str, out: str, dims: int) -> DataFrame:
    """tf-idf vector of hashed words as array<float>; words share a slot when ``dims``
    is small, so the width is the caller's choice."""
    counted = HashingTF(inputCol=words, outputCol="_tf", numFeatures=dims).transform(rows)
    weighted = IDF(inputCol="_tf", outputCol="_v").fit(counted).transform(counted)
    return weighted.withColumn(out, vector_to_array("_v", "float32")).drop("_tf", "_v")


def text_classifier(counts: str, label: str) -> Pipeline:
    """Logistic regression on tf-idf of ``hashed_counts``. A fit reads its rows three times
    (frequencies, spread, blocks kept for the iterations), so store the counts first."""
    return Pipeline(stages=[
        IDF(inputCol=counts, outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol=label, maxIter=100, regParam=0.01)])


def fit_on_cores(stages: Pipeline, train: DataFrame) -> PipelineModel:
    """Fit on all rows in at most one partition per core.

    Every iteration sends one dense gradient per partition, as wide as the vectors. With the
    partitions of the stored files their number would grow with the input.
    """
    return stages.fit(train.coalesce(train.sparkSession.sparkContext.defaultParallelism))


def nearest_hashed(vectors: DataFrame, key: str, vector: str, query: list[float], k: int,
                   bucket: float = 1.0, tables: int = 4) -> DataFrame:
    """Approximate nearest neighbours by random projection buckets."""
    dense = vectors.select(key, array_to_vector(F.col(vector).cast("array<double>")).alias("_v"))
    lsh = BucketedRandomProjectionLSH(inputCol="_v", outputCol="_h", bucketLength=bucket, numHashTables=tables, seed=42)
    found = lsh.fit(dense).approxNearestNeighbors(dense, Vectors.dense(query), k, distCol="distance")
    return found.select(key, "distance")
