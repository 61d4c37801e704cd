"""Experiment statistics: the reference's unit cases plus golden numbers."""

import math
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from growlytics.config import Params
from growlytics.functions.stats import chi2_sf, erfc, norm_cdf, norm_ppf, norm_two_sided_p
from growlytics.operators import experiments as X

P = Params()


def _arms(spark, rows):
    return X.scenarios_from_counts(spark, rows)


def _rows(df, key="variant"):
    return {r[key]: r.asDict() for r in df.collect()}


@pytest.fixture(scope="module")
def arms(spark):
    return _arms(spark, [
        ("lift", "Control", 80, 1000), ("lift", "Variant", 120, 1000),
        ("none", "Control", 50, 1000), ("none", "Variant", 50, 1000),
        ("empty", "Control", 0, 0), ("empty", "Variant", 0, 0),
        ("multi", "Control", 80, 1000), ("multi", "A", 120, 1000), ("multi", "B", 85, 1000),
        ("vzero", "Control", 10, 100), ("vzero", "Variant", 0, 0),
        ("czero", "Control", 0, 100), ("czero", "Variant", 5, 100),
        ("allconv", "Control", 100, 100), ("allconv", "Variant", 50, 50),
        ("bad", "Control", 10, 100), ("bad", "Variant", 60, 50),
        ("noctrl", "Variant", 5, 10),
    ])


def test_ztest_clear_lift(spark, arms):
    r = _rows(X.ztest(arms.where("scenario = 'lift'"), P, ["scenario"]))["Variant"]
    assert r["control_rate"] == pytest.approx(0.08)
    assert r["variant_rate"] == pytest.approx(0.12)
    assert r["lift_pct"] == pytest.approx(50.0)
    assert r["z_score"] == pytest.approx(2.9814239699997187, rel=1e-12)
    assert r["p_value"] == pytest.approx(0.0028691127920766257, abs=1e-14)
    assert r["ci_lower"] == pytest.approx(0.01376234156789138, rel=1e-12)
    assert r["ci_upper"] == pytest.approx(0.0662376584321086, rel=1e-12)
    assert r["significant"] and r["ci_lower"] > 0


def test_ztest_no_difference(spark, arms):
    r = _rows(X.ztest(arms.where("scenario = 'none'"), P, ["scenario"]))["Variant"]
    assert r["lift_pct"] == 0 and r["z_score"] == 0 and r["p_value"] == pytest.approx(1.0)
    assert not r["significant"]


def test_ztest_edges(spark, arms):
    z = {r["scenario"]: r.asDict() for r in X.ztest(arms, P, ["scenario"]).collect() if r["variant"] != "B"}
    assert z["empty"]["control_rate"] == 0 and z["empty"]["variant_rate"] == 0 and not z["empty"]["significant"]
    assert z["empty"]["p_value"] == 1.0
    # variant size 0 keeps the control rate
    assert z["vzero"]["control_rate"] == pytest.approx(0.1) and z["vzero"]["p_value"] == 1.0
    # control rate 0: lift reported as 0
    assert z["czero"]["lift_pct"] == 0.0 and z["czero"]["control_rate"] == 0.0
    # pooled rate 1: z = 0, p = 1
    assert z["allconv"]["z_score"] == 0.0 and z["allconv"]["p_value"] == 1.0
    # conversions > size: flagged, statistics NULL
    assert z["bad"]["valid"] is False and z["bad"]["p_value"] is None
    # no control row at all: treated as control size 0
    assert z["noctrl"]["control_size"] == 0 and z["noctrl"]["p_value"] == 1.0


def test_abn_bonferroni(spark, arms):
    r = _rows(X.abn_test(arms.where("scenario = 'multi'"), P, ["scenario"]))
    a, b = r["A"], r["B"]
    assert a["z_critical"] == pytest.approx(2.2414027276049464, rel=1e-13)
    assert a["lift_pct"] == pytest.approx(50.0) and a["significant"]
    assert a["p_value"] == pytest.approx(0.005738225584153251, abs=1e-14)
    assert a["ci_lower"] == pytest.approx(0.009995326951175932, rel=1e-12)
    assert a["ci_upper"] == pytest.approx(0.07000467304882406, rel=1e-12)
    assert b["rate"] == pytest.approx(0.085) and not b["significant"]
    assert b["z_score"] == pytest.approx(0.40637314098841065, rel=1e-12)
    assert b["p_value"] == 1.0
    assert b["ci_lower"] == pytest.approx(-0.02257699714625927, rel=1e-12)


def test_abn_empty_control_has_no_rows(spark, arms):
    assert X.abn_test(arms.where("scenario = 'empty'"), P, ["scenario"]).count() == 0


def test_chi_square(spark, arms):
    g = _rows(X.chi_square_global(arms, P, ["scenario"]), "scenario")
    assert g["lift"]["chi2"] == pytest.approx(8.45, rel=1e-12)  # Yates at 2 x 2
    assert g["lift"]["p_value"] == pytest.approx(0.003650434404441877, abs=1e-14)
    assert g["multi"]["chi2"] == pytest.approx(11.049723756906076, rel=1e-12)  # no Yates at 3 x 2
    assert g["multi"]["p_value"] == pytest.approx(0.003986419264500115, abs=1e-14)
    for s in ("empty", "vzero", "allconv", "bad"):
        assert (g[s]["chi2"], g[s]["p_value"], g[s]["significant"]) == (0.0, 1.0, False), s


def test_erfc_matches_commons_math(spark):
    xs = [i / 4 for i in range(-12, 33)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    rows = df.select(
        "x", erfc(F.col("x")).alias("ours"),
        F.expr("reflect('org.apache.commons.math3.special.Erf', 'erfc', x)").cast("double").alias("ref"),
    ).collect()
    for r in rows:
        assert r["ours"] == pytest.approx(r["ref"], rel=1e-11, abs=1e-15), r["x"]


def test_ppf_and_cdf(spark):
    ps = [1e-10, 1e-5, 0.001, 0.02, 0.025, 0.3, 0.5, 0.7, 0.975, 0.9875, 0.99999]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    rows = df.select("p", norm_ppf(F.col("p")).alias("x"), norm_cdf(norm_ppf(F.col("p"))).alias("back")).collect()
    for r in rows:
        assert r["x"] == pytest.approx(NormalDist().inv_cdf(r["p"]), rel=1e-12, abs=1e-12)
        assert r["back"] == pytest.approx(r["p"], rel=1e-10)
    z = spark.range(1).select(norm_two_sided_p(F.lit(1.96)).alias("p")).first()["p"]
    assert z == pytest.approx(2 * (1 - NormalDist().cdf(1.96)), abs=1e-15)


def test_chi2_sf_closed_forms(spark):
    cases = [(x, k) for x in (0.5, 2.0, 8.45, 30.0) for k in (1, 2, 3, 4, 5, 8, 9)]
    df = spark.createDataFrame(cases, "x double, k int")
    for r in df.select("x", "k", chi2_sf(F.col("x"), F.col("k")).alias("p")).collect():
        x, k = r["x"], r["k"]
        if k % 2 == 0:
            expect = math.exp(-x / 2) * sum((x / 2) ** j / math.factorial(j) for j in range(k // 2))
        else:
            expect = math.erfc(math.sqrt(x / 2)) + math.exp(-x / 2) * sum(
                (x / 2) ** (j - 0.5) / math.gamma(j + 0.5) for j in range(1, (k - 1) // 2 + 1)
            )
        assert r["p"] == pytest.approx(expect, rel=1e-12, abs=1e-16), (x, k)
