"""The forest as tables: the same scores as the model, in two engines."""

from __future__ import annotations

import duckdb
import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tests.golden_rows import AS_OF
from tests.test_churn_model import features, population, prepared  # noqa: F401
from tillspark.fixed_values import TREE_DEPTH
from tillspark.plans import churn_model, forest


@pytest.fixture(scope="module")
def trained(spark, prepared, tmp_path_factory):  # noqa: F811
    path = str(tmp_path_factory.mktemp("forest") / "model")
    return churn_model.train_or_load(prepared, path), path


SCORE_SQL = """
    WITH RECURSIVE v AS (
        SELECT CustomerID, list((value - Shift) * Scale ORDER BY Feature) AS x
        FROM (UNPIVOT customers ON COLUMNS(* EXCLUDE CustomerID) INTO NAME Name VALUE value) JOIN inputs USING (Name) GROUP BY CustomerID),
    w AS (
        SELECT CustomerID, x, Tree, 0 AS Node FROM v, (SELECT DISTINCT Tree FROM nodes)
        UNION ALL
        SELECT CustomerID, x, w.Tree, CASE WHEN x[Feature + 1] <= Threshold THEN LeftNode ELSE RightNode END
        FROM w JOIN nodes n ON w.Tree = n.Tree AND w.Node = n.Node WHERE Feature IS NOT NULL)
    SELECT CustomerID, round(avg(ChurnShare), 4) FROM w JOIN nodes n ON w.Tree = n.Tree AND w.Node = n.Node WHERE Feature IS NULL GROUP BY 1
"""


def test_tables_score_as_the_model_does(spark, prepared, trained):  # noqa: F811
    model, path = trained
    nodes, inputs = forest.load_tables(spark, path)
    got = {r["CustomerID"]: r["Probability"] for r in forest.probabilities(prepared, nodes, inputs, TREE_DEPTH).collect()}
    by_model = model.transform(prepared).select("CustomerID", vector_to_array("probability")[1].alias("p")).collect()
    assert len(got) == len(by_model) == 390
    for r in by_model:
        assert got[r["CustomerID"]] == pytest.approx(r["p"], abs=1e-12)
    scores = forest.score(prepared, nodes, inputs, TREE_DEPTH, AS_OF)
    assert sorted(scores.collect()) == sorted(churn_model.score(model, prepared, AS_OF).collect())


def test_scoring_starts_no_python_and_shuffles_sums_only(spark, prepared, trained):  # noqa: F811
    nodes, inputs = forest.load_tables(spark, trained[1])
    table = spark.createDataFrame(prepared.limit(5).collect(), prepared.schema)
    plan = forest.probabilities(table, nodes, inputs, TREE_DEPTH)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "SortMergeJoin" not in plan
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index("functions=[sum") < plan.index("Exchange hashpartitioning") < plan.index("functions=[partial_sum") < plan.index("BroadcastHashJoin")


def test_a_second_engine_scores_from_the_tables(spark, prepared, trained):  # noqa: F811
    nodes, inputs = (t.toPandas() for t in forest.load_tables(spark, trained[1]))
    customers = prepared.select("CustomerID", *inputs["Name"]).limit(40).toPandas()
    db = duckdb.connect()
    for name, frame in (("nodes", nodes), ("inputs", inputs), ("customers", customers)):
        db.register(name, frame)
    db.execute("CREATE TABLE n2 AS SELECT Tree, Node, CASE WHEN isnan(Feature) THEN NULL ELSE CAST(Feature AS INTEGER) END AS Feature, Threshold, CAST(LeftNode AS INTEGER) AS LeftNode, CAST(RightNode AS INTEGER) AS RightNode, ChurnShare FROM nodes")
    second = dict(db.execute(SCORE_SQL.replace("nodes n", "n2 n").replace("FROM nodes", "FROM n2")).fetchall())
    model_scores = {r["CustomerID"]: float(r["ChurnProbability"]) for r in churn_model.score(trained[0], prepared, AS_OF).collect()}
    assert len(second) == 40
    assert all(second[c] == pytest.approx(model_scores[c], abs=1.01e-4) for c in second)


def test_tables_of_other_depths_and_features(spark, prepared, tmp_path):  # noqa: F811
    model = churn_model.train(prepared, exclude=["DaysSinceLastPurchase"], trees=7)
    model.write().save(f"{tmp_path}/model")
    forest.save_tables(spark, model, str(tmp_path))
    nodes, inputs = forest.load_tables(spark, str(tmp_path))
    assert inputs.count() == len(churn_model.MODEL_FEATURES) - 1
    assert sorted(forest.score(prepared, nodes, inputs, 30, AS_OF).collect()) == sorted(churn_model.score(model, prepared, AS_OF).collect())


@pytest.mark.parametrize("seed", range(4))
def test_rank_sum_auc_is_the_area_under_the_curve(spark, seed):
    rng = np.random.default_rng(seed)
    scores, labels = np.round(rng.random(500) ** 2, 2 + seed % 3), rng.integers(0, 2, 500)
    rows = spark.createDataFrame([(float(s), int(x)) for s, x in zip(scores, labels, strict=True)], "s double, y int")
    auc = churn_model.rank_sum_auc(rows, F.col("s"), F.col("y")).first()["AUC"]
    scored = rows.withColumn("probability", array_to_vector(F.array(1 - F.col("s"), F.col("s"))))
    evaluator = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="probability", metricName="areaUnderROC", numBins=0)
    assert auc == pytest.approx(evaluator.evaluate(scored), abs=1e-9)


def test_rank_sum_auc_needs_both_classes(spark):
    rows = spark.createDataFrame([(0.5, 1), (0.7, 1)], "s double, y int")
    assert churn_model.rank_sum_auc(rows, F.col("s"), F.col("y")).first()["AUC"] is None
    assert churn_model.rank_sum_auc(rows.limit(0), F.col("s"), F.col("y")).first()["AUC"] is None
