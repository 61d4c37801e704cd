"""The forest as expressions against the ML transformer and a plain walk."""

import random

import pytest
from pyspark.sql import functions as F

from growlytics.config import CHURN_FEATURES, Params
from growlytics.operators import churn, forest

P = Params()


@pytest.fixture(scope="module")
def fitted(spark, tmp_path_factory):
    rng = random.Random(7)
    rows = []
    for i in range(700):
        y = int(rng.random() < 0.4)
        rows.append((i, rng.choice(["Pro", "Enterprise", "O'Hara \\ Co"]), rng.choice(["Google", "Meta", "Organic"]), rng.randint(1, 50), rng.randint(0, 90) + 40 * y,
                     rng.choice(["Desktop", "Mobile", "Tablet"]), rng.randint(0, 9), rng.randint(0, 20), rng.randint(0, 60), round(rng.random() * 900, 2), y))
    df = spark.createDataFrame(rows, "user_id long, plan string, channel string, session_count long, recency long, device_type string, "
                                     "search_count long, pv_count long, total_events long, total_revenue double, churned int")
    model = churn.fit(df, P)
    path = str(tmp_path_factory.mktemp("model") / "m")
    churn.save(model, path)
    return df, model, path


def test_scores_equal_the_transformer_on_every_row(spark, fitted):
    df, model, path = fitted
    odd = df.limit(40).select(
        F.col("user_id") + 10_000, F.when(F.col("user_id") % 2 == 0, "Gold").otherwise(F.col("plan")).alias("plan"), "channel", "session_count",
        F.when(F.col("user_id") % 5 != 0, F.col("recency")).alias("recency"), F.lit("Watch").alias("device_type"), "search_count", "pv_count", "total_events",
        F.when(F.col("user_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("total_revenue")).alias("total_revenue"), "churned").toDF(*df.columns)
    rows = df.unionByName(odd)
    got = {r.user_id: (r.churn_probability, r.prediction) for r in forest.scored(rows, forest.nodes(spark, path).collect(), forest.codes(spark, model).collect()).collect()}
    want = {r.user_id: (r.churn_probability, r.prediction) for r in churn.transformed(churn.load(path), rows).collect()}
    assert len(got) == len(want) == 740
    for k, (p, y) in want.items():
        assert got[k][0] == pytest.approx(p, abs=1e-12) and got[k][1] == y


def test_scores_equal_a_plain_walk(spark, fitted):
    df, model, path = fitted
    nodes = {}
    for r in forest.nodes(spark, path).collect():
        nodes.setdefault(r.tree, {})[r.node] = r
    codes = {(r.feature, r.label): r.code for r in forest.codes(spark, model).collect()}
    got = {r.user_id: r.churn_probability for r in forest.scored(df, forest.nodes(spark, path).collect(), forest.codes(spark, model).collect()).collect()}
    assert len(nodes) == P.churn_trees and max(len(t) for t in nodes.values()) < 2 ** (P.churn_depth + 1)
    for row in df.collect():
        x = [codes[c, row[c]] if c in churn.CATEGORICAL else float(row[c]) for c in CHURN_FEATURES]
        votes = 0.0
        for tree in nodes.values():
            n = tree[0]
            while n.left is not None:
                n = tree[n.left if x[n.feature] <= n.threshold else n.right]
            votes += n.p1
        assert got[row.user_id] == pytest.approx(votes / len(nodes), abs=1e-12)


def test_no_python_and_no_vectors_in_the_plan(spark, fitted):
    df, model, path = fitted
    plan = forest.scored(df, forest.nodes(spark, path).collect(), forest.codes(spark, model).collect())._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "UDF" not in plan


def test_importances_equal_the_model(spark, fitted):
    _, model, path = fitted
    want = dict(zip(CHURN_FEATURES, model.stages[-1].featureImportances.toArray()))
    got = {r.feature: r.importance for r in forest.importances(forest.nodes(spark, path)).collect()}
    assert set(got) == set(want) and all(got[f] == pytest.approx(want[f], abs=1e-12) for f in want)


def test_codes_equal_the_fitted_encoders(spark, fitted):
    df, model, _ = fitted
    want = {(r.feature, r.label, r.code) for r in forest.codes(spark, model).collect()}
    assert {tuple(r) for c in churn.CATEGORICAL for r in forest.encoding(df, c).collect()} == want


def test_exact_split_per_class(spark, fitted):
    df, _, _ = fitted
    train, test = churn.split(df, P, tight=True)
    total = {r.churned: r["count"] for r in df.groupBy("churned").count().collect()}
    assert {r.churned: r["count"] for r in test.groupBy("churned").count().collect()} == {k: int(n * 0.2 + 0.5) for k, n in total.items()}
    assert train.count() + test.count() == 700 and not train.join(test, "user_id").count()
