"""Churn features, training and scoring."""

import datetime as dt
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.golden_rows import AS_OF
from tillspark import schemas as S
from tillspark.plans import churn_model


@pytest.fixture(scope="module")
def population(spark):
    """Customers whose activity depends on how long they have been away."""
    rng = random.Random(11)
    segments = ["Premium", "Regular", "At-Risk"]
    people, facts = [], []
    for i in range(1, 401):
        away = rng.choice([None, *range(0, 300)])
        orders = 0 if away is None else rng.randint(1, 20)
        spend = None if away is None else Decimal(rng.randint(100, 10**6)) / 100
        people.append((i, f"C{i:04d}", "F", "L", None, segments[i % 3], "R", "S", "T", None,
                       dt.date(2020, 1 + i % 12, 15), i % 40 != 0, None, None, None))
        facts.append((i, 20260303, orders, spend, None if spend is None else (spend / orders).quantize(Decimal("0.01")),
                      away, min(orders, 5), rng.randint(0, 3)))
    return (
        spark.createDataFrame(people, S.DIM_CUSTOMER),
        spark.createDataFrame(facts, S.FACT_CUSTOMER_ACTIVITY),
    )


@pytest.fixture(scope="module")
def features(population):
    return churn_model.load_features(*population, AS_OF)


@pytest.fixture(scope="module")
def prepared(features):
    return churn_model.prepare_features(features).cache()


def test_features(features):
    rows = features.collect()
    assert len(rows) == 390
    for r in rows:
        assert r.ChurnLabel == int(r.DaysSinceLastPurchase is not None and r.DaysSinceLastPurchase >= 90)
    first = next(r for r in rows if r.CustomerID == "C0001")
    assert (first.TenureMonths, first.SegmentScore) == ((2026 - 2020) * 12 + 3 - 2, 2)


def test_prepared_features_match_numpy(features):
    raw = features.collect()
    rows = {r.CustomerID: r for r in churn_model.prepare_features(features).collect()}
    for column in ("TotalSpend", "AvgOrderValue", "DaysSinceLastPurchase"):
        values = {r.CustomerID: float(r[column] or 0) for r in raw}
        cap = np.quantile(list(values.values()), 0.99)
        for customer, value in values.items():
            assert rows[customer][column] == pytest.approx(min(value, cap))
    for r in rows.values():
        assert r.LogTotalSpend == pytest.approx(np.log1p(r.TotalSpend))


def test_split_keeps_the_share_of_each_label(prepared):
    train, test = churn_model.split_by_label(prepared)
    for label in (0, 1):
        n = prepared.filter(F.col("ChurnLabel") == label).count()
        assert test.filter(F.col("ChurnLabel") == label).count() == round(n * 0.2)
    assert train.join(test, "CustomerID").count() == 0
    assert train.count() + test.count() == prepared.count()


def test_class_weights_balance(prepared):
    weighted = churn_model.with_class_weights(prepared).groupBy("ChurnLabel").agg(F.sum("ClassWeight").alias("w"))
    weights = [r.w for r in weighted.collect()]
    assert weights[0] == pytest.approx(weights[1]) == pytest.approx(195)


def test_train_score_and_reload(spark, prepared, tmp_path):
    path = str(tmp_path / "model")
    model = churn_model.train_or_load(prepared, path)
    again = churn_model.train_or_load(prepared, path)
    scores = churn_model.score(again, prepared, AS_OF)
    assert sorted(scores.collect()) == sorted(churn_model.score(model, prepared, AS_OF).collect())
    assert scores.count() == 390
    assert scores.filter("ChurnProbability NOT BETWEEN 0 AND 1").count() == 0

    report = {r.Class: r for r in churn_model.evaluate(model, churn_model.split_by_label(prepared)[1]).collect()}
    assert report[1].AUC > 0.95
    assert all(0 <= r[m] <= 1 for r in report.values() for m in ("Precision", "Recall", "F1"))
    importance = churn_model.feature_importance(model, spark).collect()
    assert importance[0].Feature == "DaysSinceLastPurchase"
    assert sum(r.Importance for r in importance) == pytest.approx(1.0)

    preview = churn_model.score_preview(scores).collect()
    assert [r.CustomerID for r in preview] == sorted(r.CustomerID for r in scores.collect())[:20]
    assert {r.ChurnRiskCategory for r in preview} <= {"Low", "Medium", "High"}


def test_features_can_be_left_out(prepared):
    model = churn_model.train(prepared, exclude=["DaysSinceLastPurchase"], trees=5)
    assert "DaysSinceLastPurchase" not in model.stages[0].getInputCols()


def test_report_counts(spark):
    rows = [(0, 0.0), (0, 1.0), (1, 1.0), (1, 1.0), (1, 0.0)]

    class Fixed:
        @staticmethod
        def transform(df):
            return df

    df = spark.createDataFrame(rows, "ChurnLabel int, prediction double")
    from pyspark.ml.functions import array_to_vector

    df = df.withColumn("probability", array_to_vector(F.array(1 - F.col("prediction"), F.col("prediction"))))
    report = {r.Class: r for r in churn_model.evaluate(Fixed, df).collect()}
    assert (report[1].Precision, report[1].Recall, report[1].Support) == (pytest.approx(2 / 3), pytest.approx(2 / 3), 3)
    assert (report[0].Precision, report[0].Recall, report[0].F1, report[0].Support) == (0.5, 0.5, 0.5, 2)


def test_score_profile(spark):
    values = [Decimal(i) / 100 for i in range(0, 101)]
    scores = spark.createDataFrame([(str(v), v, AS_OF) for v in values], S.CHURN_SCORES)
    row = churn_model.score_profile(scores).first()
    assert (row["count"], row["min"], row["p25"], row["p50"], row["max"]) == (101, 0.0, 0.25, 0.5, 1.0)
    assert row["std"] == pytest.approx(np.std([float(v) for v in values], ddof=1))
