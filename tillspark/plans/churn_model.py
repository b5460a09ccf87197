"""Churn features, random forest, evaluation and scores."""

from __future__ import annotations

import datetime as dt
import logging
import math

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillspark import fixed_values as V
from tillspark.functions.dates import months_crossed
from tillspark.functions.rules import churn_category, segment_score
from tillspark.operators.ranking import numbered, quantiles, top_rows
from tillspark.plans import forest

log = logging.getLogger(__name__)

MODEL_FEATURES = [*V.BASE_FEATURES, *V.LOG_FEATURES]
#: Training sets of more rows than the first are merged into parts of up to as many rows as the second.
MERGED_FROM, ROWS_PER_PART = 50_000, 1 << 17


def load_features(customers: DataFrame, activity: DataFrame, as_of: dt.date) -> DataFrame:
    """Activity of active customers with tenure, segment score and churn label."""
    active = customers.filter("IsActive").select("CustomerKey", "CustomerID", "JoinDate", "Segment")
    joined = active.join(activity.drop("DateKey"), "CustomerKey")
    churned = F.coalesce(F.col("DaysSinceLastPurchase") >= V.CHURNED_AFTER_DAYS, F.lit(False))
    return joined.select(
        "CustomerID",
        "TotalOrders",
        "TotalSpend",
        "AvgOrderValue",
        "DaysSinceLastPurchase",
        "UniqueCategories",
        "SupportTickets",
        months_crossed(F.col("JoinDate"), F.lit(as_of)).alias("TenureMonths"),
        segment_score(F.col("Segment")).alias("SegmentScore"),
        churned.cast("int").alias("ChurnLabel"),
    )


def prepare_features(features: DataFrame) -> DataFrame:
    """Fill gaps with 0, cap outliers at the 99th percentile of this frame, add logs."""
    others = [c for c in features.columns if c not in V.BASE_FEATURES]
    numbers = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in V.BASE_FEATURES]
    filled = features.select(*others, *numbers)
    caps = quantiles(filled, V.CAPPED_FEATURES, V.CAP_QUANTILE)
    capped = filled.select(
        *[c for c in filled.columns if c not in caps], *[F.least(F.col(c), cap).alias(c) for c, cap in caps.items()]
    )
    logs = [F.log1p(source).alias(name) for name, source in V.LOG_FEATURES.items()]
    return capped.select("*", *logs)


def split_by_label(df: DataFrame, test_share: float = V.TEST_SHARE, seed: int = V.SEED) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; every label has exactly its share (rounded) in the test rows."""
    ranked = numbered(df, ["CustomerID"], by=["ChurnLabel"], name="__rank", seed=seed)
    sizes = df.groupBy("ChurnLabel").agg(F.round(F.count(F.lit(1)) * test_share).alias("__tests"))
    # Two labels, so two rows: joining by shuffle would gather all customers in two tasks.
    tagged = ranked.join(F.broadcast(sizes), "ChurnLabel").withColumn("__test", F.col("__rank") <= F.col("__tests"))
    rows = tagged.drop("__rank", "__tests")
    return rows.filter(~F.col("__test")).drop("__test"), rows.filter("__test").drop("__test")


def with_class_weights(train: DataFrame) -> DataFrame:
    """Weights that give both labels the same total."""
    counts = {r["ChurnLabel"]: r["count"] for r in train.groupBy("ChurnLabel").count().collect()}
    total = sum(counts.values())
    weight = F.lit(1.0)
    for label, n in counts.items():
        weight = F.when(F.col("ChurnLabel") == label, F.lit(total / (2.0 * n))).otherwise(weight)
    return train.withColumn("ClassWeight", weight)


def in_training_parts(rows: DataFrame) -> DataFrame:
    """A large training set in as many parts as there are cores, or more where it needs them.

    At every level each part sends statistics of all nodes that are split, so
    parts beyond the cores cost as much as more rows would, whatever their size.
    Small sets have few nodes; they keep their parts, on which the drawing of
    rows for the trees depends.
    """
    n = rows.count()
    if n <= MERGED_FROM:
        return rows
    return rows.coalesce(max(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(n / ROWS_PER_PART)))


def train(rows: DataFrame, exclude: list[str] | None = None, trees: int = V.TREES) -> PipelineModel:
    """Fit scaler and forest on prepared rows.

    The label is a threshold on ``DaysSinceLastPurchase``, which is a feature
    too; pass it in ``exclude`` to see what the other features are worth.

    Training passes over the rows many times: they are kept, in parts whose size
    the adaptive planner evens out; a lost part is computed again.
    """
    columns = [c for c in MODEL_FEATURES if c not in (exclude or [])]
    kept = rows.select("CustomerID", *columns, "ChurnLabel").hint("rebalance")
    kept = kept.persist(StorageLevel.MEMORY_AND_DISK)
    stages = [
        VectorAssembler(inputCols=columns, outputCol="RawFeatures"),
        StandardScaler(inputCol="RawFeatures", outputCol="Features", withMean=True, withStd=True),
        RandomForestClassifier(
            featuresCol="Features",
            labelCol="ChurnLabel",
            weightCol="ClassWeight",
            numTrees=trees,
            maxDepth=V.TREE_DEPTH,
            minInstancesPerNode=V.MIN_LEAF,
            featureSubsetStrategy="sqrt",
            seed=V.SEED,
            maxMemoryInMB=1024,
        ),
    ]
    try:
        # A copy leaves the training summary behind, which would drag the session into every task.
        return Pipeline(stages=stages).fit(in_training_parts(with_class_weights(kept))).copy()
    finally:
        kept.unpersist()


def rank_sum_auc(scored: DataFrame, score: Column, label: Column) -> DataFrame:
    """``AUC``: the share of pairs of a churned and another customer whose scores are in order, equal ones counting half.

    Scores have four places, so counts per score are at most 10,001 rows, over
    which the running total goes; customers are aggregated once and never
    sorted.  NULL where there are no such pairs.
    """
    per_score = scored.groupBy(F.round(score * 10000).cast("int").alias("__score")).agg(
        F.count(F.when(label == 1, 1)).alias("__churned"), F.count(F.when(label == 0, 1)).alias("__others")
    )
    lower = Window.orderBy("__score").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("__others").over(lower), F.lit(0))
    ranked = per_score.withColumn("__pairs", F.col("__churned") * (below + F.col("__others") / 2))
    return ranked.agg(F.try_divide(F.sum("__pairs"), F.sum("__churned").cast("double") * F.sum("__others")).alias("AUC"))


def evaluate(model: PipelineModel, test: DataFrame) -> DataFrame:
    """ROC AUC of the scores as they are stored and, per class, precision, recall, F1 and support."""
    churn = F.coalesce(F.get(vector_to_array(F.col("probability")), F.lit(1)), F.lit(0.0))
    return evaluation(model.transform(test).select("ChurnLabel", F.col("prediction").cast("int").alias("Predicted"), F.round(churn, 4).alias("Score")))


def evaluation(predicted: DataFrame) -> DataFrame:
    """The report for rows of ``ChurnLabel``, ``Predicted`` class and ``Score``."""
    auc = rank_sum_auc(predicted, F.col("Score"), F.col("ChurnLabel")).scalar()
    is_class, said_class = F.col("ChurnLabel") == F.col("Class"), F.col("Predicted") == F.col("Class")

    def rows_where(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("count")).otherwise(0))

    counts = predicted.groupBy("ChurnLabel", "Predicted").count()
    per_class = (
        counts.select(
            F.explode(F.array_distinct(F.array("ChurnLabel", "Predicted"))).alias("Class"),
            "ChurnLabel",
            "Predicted",
            "count",
        )
        .groupBy("Class")
        .agg(
            rows_where(is_class & said_class).alias("__hits"),
            rows_where(said_class).alias("__predicted"),
            rows_where(is_class).alias("Support"),
        )
    )

    def share(part: str, whole: str) -> Column:
        return F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0))

    precision, recall = share("__hits", "__predicted"), share("__hits", "Support")
    return per_class.select(
        "Class",
        precision.alias("Precision"),
        recall.alias("Recall"),
        F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0)).alias("F1"),
        "Support",
        auc.alias("AUC"),
    )


def feature_importance(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """Features of a fitted model, most important first."""
    names = model.stages[0].getInputCols()
    values = model.stages[-1].featureImportances.toArray().tolist()
    rows = spark.createDataFrame(list(zip(names, values)), "Feature string, Importance double")
    return rows.orderBy(F.desc("Importance"), F.asc("Feature"))


def score(model: PipelineModel, prepared: DataFrame, as_of: dt.date) -> DataFrame:
    """Churn probability of every row, to four places; 0 when the model never saw a churned customer."""
    churn = F.coalesce(F.get(vector_to_array(F.col("probability")), F.lit(1)), F.lit(0.0))
    return model.transform(prepared).select(
        "CustomerID",
        F.round(churn, 4).cast("decimal(5,4)").alias("ChurnProbability"),
        F.lit(as_of).alias("ScoredDate"),
    )


def score_profile(scores: DataFrame) -> DataFrame:
    """Count, mean, spread, quartiles and range of the churn probability.

    Probabilities have four places, so the exact percentiles merge at most
    10,001 distinct values.
    """
    p = F.col("ChurnProbability").cast("double")
    return scores.agg(
        F.count(p).alias("count"),
        F.avg(p).alias("mean"),
        F.stddev_samp(p).alias("std"),
        F.min(p).alias("min"),
        F.percentile(p, F.lit(0.25)).alias("p25"),
        F.percentile(p, F.lit(0.5)).alias("p50"),
        F.percentile(p, F.lit(0.75)).alias("p75"),
        F.max(p).alias("max"),
    )


def score_preview(scores: DataFrame, n: int = V.PREVIEW_ROWS) -> DataFrame:
    """First scores by customer, with their category."""
    return top_rows(scores, [F.asc("CustomerID")], n).select(
        "CustomerID",
        "ChurnProbability",
        churn_category(F.col("ChurnProbability")).alias("ChurnRiskCategory"),
        "ScoredDate",
    )


def is_saved(spark: SparkSession, path: str) -> bool:
    """Whether a whole model lies under ``path``."""
    try:
        spark.read.text(f"{path}/saved")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def train_or_load(prepared: DataFrame, path: str, exclude: list[str] | None = None) -> PipelineModel:
    """The model saved under ``path``; trained on the training rows and saved when there is none."""
    spark = prepared.sparkSession
    if not is_saved(spark, path):
        log.info("training a new model for %s", path)
        model = train(split_by_label(prepared)[0], exclude)
        model.write().overwrite().save(f"{path}/model")
        forest.save_tables(spark, model, path)
        # Written last: a save that broke off is not taken for a model.
        spark.range(1).selectExpr("'saved' AS value").write.mode("overwrite").text(f"{path}/saved")
        return model
    return PipelineModel.load(f"{path}/model")
