"""Rules at the edges: tests without a control or a variant, unscorable rows,
changed input under the same path, intake of equal payloads."""

import math

import pytest
from pyspark.sql import functions as F

from growlytics.config import CHURN_FEATURES, Params
from growlytics.operators import churn, experiments as X
from growlytics.sources import warehouse
from growlytics.streaming import intake

P = Params.binding()


@pytest.fixture(scope="module")
def arm_rows(spark):
    return X.scenarios_from_counts(spark, [
        ("noctrl", "A", 30, 100), ("noctrl", "B", 60, 100),
        ("only", "Control", 20, 100),
        ("full", "Control", 20, 100), ("full", "A", 30, 100), ("full", "B", 45, 100),
    ])


def test_chi_square_without_control(arm_rows):
    got = {r["scenario"]: r for r in X.chi_square_global(arm_rows, P, ["scenario"]).collect()}
    for k in ("noctrl", "only"):
        assert (got[k]["chi2"], got[k]["p_value"], got[k]["significant"]) == (0.0, 1.0, False)
    assert got["full"]["significant"] and got["full"]["dof"] == 2


def test_report_keeps_every_test(arm_rows):
    got = {r["scenario"]: r for r in X.experiment_report(arm_rows, P, ["scenario"], with_variants=True).collect()}
    assert set(got) == {"noctrl", "only", "full"}
    only = got["only"]
    assert (only["control_size"], only["variant_size"], only["control_rate"]) == (100, 0, 0.2)
    assert (only["z_score"], only["p_value"], only["chi2"], only["chi2_p_value"], only["global_chi2_p_value"]) == (0.0, 1.0, 0.0, 1.0, 1.0)
    assert only["variants"] == [] and got["noctrl"]["variants"] == []
    assert [v["variant"] for v in got["full"]["variants"]] == ["A", "B"]


def _features(spark, n):
    df = spark.range(n).select(
        F.col("id").alias("user_id"), F.lit("Pro").alias("plan"), F.lit("Google").alias("channel"), F.lit("Mobile").alias("device_type"),
        (F.col("id") % 2).cast("int").alias("churned"))
    return df.withColumns({c: (F.col("user_id") % 7 + 40 * F.col("churned")).cast("double") for c in CHURN_FEATURES if c not in churn.CATEGORICAL})


def test_row_minimum_counts_the_whole_table(spark):
    assert churn.enough_rows(_features(spark, P.min_training_rows), P)
    assert not churn.enough_rows(_features(spark, P.min_training_rows - 1), P)


def test_unscorable_row_gets_one_half(spark):
    feats = _features(spark, 60)
    model = churn.fit(feats, P)
    gap = feats.withColumns({"recency": F.when(F.col("user_id") != 3, F.col("recency")),
                             "total_revenue": F.when(F.col("user_id") == 5, F.lit(math.nan)).otherwise(F.col("total_revenue"))})
    got = {r["user_id"]: r for r in churn.score(model, gap).collect()}
    assert len(got) == 60 and got[3]["recency"] is None
    assert got[3]["churn_probability"] == got[5]["churn_probability"] == 0.5
    assert got[7]["churn_probability"] > 0.5 > got[8]["churn_probability"]


def test_input_state_follows_the_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    before = warehouse.input_state(spark, path)
    assert before == warehouse.input_state(spark, path)
    spark.range(6).write.mode("overwrite").parquet(path)
    assert before != warehouse.input_state(spark, path)


def test_changed_input_changes_the_answer(spark, tmp_path):
    import __spark_entry__ as entry

    src, names = "/root/testdata/sf0.001", ("customer", "nation", "region", "events")
    at = str(tmp_path)
    for n in names:
        spark.read.parquet(f"{src}/{n}.parquet").write.parquet(f"{at}/{n}.parquet")
    orders = spark.read.parquet(f"{src}/orders.parquet")
    query = entry.queries()["e1_total_users"]
    seen = []
    for part in (orders, orders.where("o_custkey % 2 = 0")):
        part.write.mode("overwrite").parquet(f"{at}/orders.parquet")
        seen.append((query(spark, at).first()[0], part.select("o_custkey").distinct().count()))
    assert seen[0][0] == seen[0][1] and seen[1][0] == seen[1][1] and seen[0] != seen[1]


def test_equal_payloads_without_id_stay_apart(spark, tmp_path):
    landing, sink, ckpt = (str(tmp_path / x) for x in ("landing", "sink", "ckpt"))
    rows = spark.createDataFrame([(None, "7", "page_view", None)] * 5 + [("e1", "7", "click", None)] * 2,
                                 "event_id string, user_id string, event_type string, event_time string")
    rows.coalesce(1).write.json(landing)
    for _ in range(2):  # the second run is a restart without new files
        intake.run_available(spark, landing, sink, ckpt)
        got = spark.read.parquet(sink)
        assert got.where("event_type = 'page_view'").select("event_id").distinct().count() == 5
        assert got.count() == 6
