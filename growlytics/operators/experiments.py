"""Experiment statistics I1-I6.

I1 aggregates assignments into arms; everything after that works on the arm
table (one row per experiment x variant, a few rows per experiment), so the
statistics are Column expressions over small aggregated rows.  The control
arm of each experiment is joined to its variants; the chi-square test sums
cells over a window partitioned by the test key.

Every operator takes ``keys`` (default ``["experiment_id"]``): the columns
identifying one test, so a table of scenarios (I6) or per-segment arms run
through the same code.

Edge rules (per test, as the reference computes them):
- control size 0: all statistics 0, p = 1, not significant (A/B/n: no rows);
- variant size 0: zeros, p = 1 (the single form keeps the control rate);
  it still counts towards the Bonferroni n;
- lift 0 when the control rate is 0; pooled rate 0 or 1: z = 0, p = 1;
- chi-square: a zero size, a negative cell or a zero expected cell gives
  (0, 1, not significant); Yates' correction only for 2 x 2 tables;
- conversions outside [0, size]: statistics NULL and ``valid`` false.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from growlytics.config import Params
from growlytics.session import checkpointed
from growlytics.functions.stats import chi2_sf_sql, norm_ppf_sql, norm_two_sided_p_sql


_UNNAMED = "\U0010FFFF"


def arms(dim_variants: DataFrame, stg_subscriptions: DataFrame, p: Params,
         by: list[str] | None = None) -> DataFrame:
    """Group size and conversions per (experiment, variant[, by]).

    A user converts if any of their subscriptions is paid; subscriptions are
    reduced to one row per user before the left join.  Users without a
    variant name are an arm of their own (NULL)."""
    conv = stg_subscriptions.groupBy("user_id").agg(
        F.max(F.when(F.col("plan").isin(*p.paid_plans), 1).otherwise(0)).alias("converted")
    )
    by = by or []
    return (
        dim_variants.select("experiment_id", "variant", "user_id", *by)
        .join(conv, "user_id", "left")
        .groupBy("experiment_id", "variant", *by)
        .agg(
            F.count("user_id").alias("group_size"),
            F.sum(F.coalesce("converted", F.lit(0))).cast("bigint").alias("conversions"),
        )
        .where(~F.coalesce(F.col("variant").isin(*p.excluded_variants), F.lit(False)))
    )


def _pairs(arm_table: DataFrame, keys: list[str], p: Params) -> DataFrame:
    """Each non-control arm next to its control (control size 0 if missing).

    The control's counts reach the variant rows through a window over the
    test key (a few rows per test) rather than a self-join, so the arm table
    is read once."""
    w = Window.partitionBy(*keys)
    is_ctrl = F.col("variant").eqNullSafe(F.lit(p.control_variant))
    t = arm_table.select(
        *keys,
        "variant",
        "conversions",
        "group_size",
        F.max(F.when(is_ctrl, F.col("conversions"))).over(w).alias("_cc"),
        F.max(F.when(is_ctrl, F.col("group_size"))).over(w).alias("_cn"),
        F.count(F.when(~is_ctrl, F.lit(1))).over(w).alias("n_variants"),
    )
    return t.where(~is_ctrl).select(
        *keys,
        "variant",
        F.coalesce("_cc", F.lit(0)).cast("double").alias("cc"),
        F.coalesce("_cn", F.lit(0)).cast("double").alias("cn"),
        F.col("conversions").cast("double").alias("vc"),
        F.col("group_size").cast("double").alias("vn"),
        "n_variants",
    )


def _z_columns(t: DataFrame, keys: list[str], z_crit: str, n: str) -> DataFrame:
    """Rates, pooled z, nominal two-sided p and the CI half-width, staged
    as SQL expressions (each step refers to the previous step's columns,
    so no sub-expression is copied).  Divisions are guarded: ANSI mode
    raises on division by zero."""
    ks = [f"`{k}`" for k in keys]
    t = t.selectExpr(
        *ks, "variant", "cc", "cn", "vc", "vn", "n_variants",
        "cc >= 0 AND cc <= cn AND vc >= 0 AND vc <= vn AS ok",
        "CASE WHEN cn > 0 THEN cc / cn END AS pc",
        "CASE WHEN vn > 0 THEN vc / vn END AS pv",
        "CASE WHEN cn + vn > 0 THEN (cc + vc) / (cn + vn) END AS pool",
        f"{z_crit} AS z_critical",
        f"{n} AS n_comp",
    )
    flat = "(cn = 0 OR vn = 0 OR pool = 0 OR pool = 1)"
    t = t.selectExpr(
        "*",
        f"CASE WHEN {flat} THEN 0D ELSE (pv - pc) / sqrt(pool * (1 - pool) * (1 / cn + 1 / vn)) END AS zs",
        "CASE WHEN cn > 0 AND vn > 0 THEN sqrt(pc * (1 - pc) / cn + pv * (1 - pv) / vn) END AS se",
        "CASE WHEN cn > 0 AND vn > 0 THEN CASE WHEN pc > 0 THEN (pv - pc) / pc * 100 ELSE 0D END END AS lift",
    )
    return t.selectExpr(
        "*", f"least(1D, CASE WHEN {flat} THEN 1D ELSE {norm_two_sided_p_sql('zs')} END * n_comp) AS pval"
    )


def ztest(arm_table: DataFrame, p: Params, keys: list[str] | None = None) -> DataFrame:
    """Two-proportion z-test of every variant against the control with the
    fixed critical z of the single comparison (1.96, no correction)."""
    keys = keys or ["experiment_id"]
    t = _z_columns(_pairs(arm_table, keys, p), keys, f"{float(p.single_z)!r}D", "1")

    def pick(v: str, ctrl0: str, var0: str) -> str:
        return f"CASE WHEN cn = 0 THEN {ctrl0} WHEN vn = 0 THEN {var0} WHEN ok THEN {v} END"

    return t.selectExpr(
        *[f"`{k}`" for k in keys],
        "variant",
        "CAST(cn AS BIGINT) AS control_size",
        "CAST(cc AS BIGINT) AS control_conversions",
        "CAST(vn AS BIGINT) AS variant_size",
        "CAST(vc AS BIGINT) AS variant_conversions",
        pick("pc", "0D", "pc") + " AS control_rate",
        pick("pv", "0D", "0D") + " AS variant_rate",
        pick("lift", "0D", "0D") + " AS lift_pct",
        pick("zs", "0D", "0D") + " AS z_score",
        pick("pval", "1D", "1D") + " AS p_value",
        pick("(pv - pc) - z_critical * se", "0D", "0D") + " AS ci_lower",
        pick("(pv - pc) + z_critical * se", "0D", "0D") + " AS ci_upper",
        pick(f"pval < {p.alpha!r}D", "false", "false") + " AS significant",
        "cn = 0 OR vn = 0 OR ok AS valid",
    )


def abn_test(arm_table: DataFrame, p: Params, keys: list[str] | None = None) -> DataFrame:
    """Every variant against the control with Bonferroni correction:
    p x n capped at 1, CI at z = ppf(1 - alpha / (2 n)); n = number of
    variants of the test (at least 1).  No rows when the control is empty."""
    keys = keys or ["experiment_id"]
    t = _pairs(arm_table, keys, p).where(F.col("cn") > 0)
    n = "greatest(n_variants, 1)"
    t = _z_columns(t, keys, norm_ppf_sql(f"1D - {p.alpha!r}D / (2D * {n})"), n)

    def pick(v: str, var0: str) -> str:
        return f"CASE WHEN vn = 0 THEN {var0} WHEN ok THEN {v} END"

    return t.selectExpr(
        *[f"`{k}`" for k in keys],
        "variant",
        "CAST(n_variants AS BIGINT) AS n_comparisons",
        "pc AS control_rate",
        pick("pv", "0D") + " AS rate",
        pick("lift", "0D") + " AS lift_pct",
        pick("zs", "0D") + " AS z_score",
        pick("pval", "1D") + " AS p_value",
        pick("(pv - pc) - z_critical * se", "0D") + " AS ci_lower",
        pick("(pv - pc) + z_critical * se", "0D") + " AS ci_upper",
        pick(f"pval < {p.alpha!r}D", "false") + " AS significant",
        "z_critical",
        "vn = 0 OR ok AS valid",
    )


def chi_square(cells: DataFrame, keys: list[str], alpha: float = 0.05, control: Column | None = None) -> DataFrame:
    """I4: chi-square test of independence on a k x 2 table per test key.

    ``cells`` has one row per table row: ``keys``, ``conversions``,
    ``group_size``.  Expected counts come from window sums over the key;
    Yates' continuity correction (|diff| capped at 0.5) only when df = 1.
    ``control`` tells which rows are the control arm: a test without one has
    a control of size 0, so (0, 1, not significant)."""
    w = Window.partitionBy(*keys)
    conv = F.col("conversions").cast("double")
    fail = (F.col("group_size") - F.col("conversions")).cast("double")
    is_ctrl = F.lit(True) if control is None else F.coalesce(control, F.lit(False))
    t = cells.select(*keys, conv.alias("o1"), fail.alias("o0"), F.col("group_size").cast("double").alias("n"), is_ctrl.alias("is_ctrl"))
    t = (
        t.withColumn("k", F.count(F.lit(1)).over(w))
        .withColumn("c1", F.sum("o1").over(w))
        .withColumn("c0", F.sum("o0").over(w))
        .withColumn("tot", F.sum("n").over(w))
    )
    e1 = F.try_divide(F.col("n") * F.col("c1"), F.col("tot"))
    e0 = F.try_divide(F.col("n") * F.col("c0"), F.col("tot"))
    yates = F.col("k") == 2

    def term(o: Column, e: Column) -> Column:
        d = e - o
        adj = F.when(yates, o + F.signum(d) * F.least(F.lit(0.5), F.abs(d))).otherwise(o)
        return F.try_divide((adj - e) * (adj - e), e)

    per = t.groupBy(*keys).agg(
        F.first("k").alias("k"),
        F.sum(term(F.col("o1"), e1) + term(F.col("o0"), e0)).alias("stat"),
        F.min(F.least(e1, e0)).alias("min_expected"),
        F.min("n").alias("min_size"),
        F.min(F.least(F.col("o1"), F.col("o0"))).alias("min_cell"),
        F.max("is_ctrl").alias("has_ctrl"),
    )
    bad = (
        ~F.col("has_ctrl")
        | (F.col("k") == 1)
        | (F.col("min_size") <= 0)
        | (F.col("min_cell") < 0)
        | F.coalesce(F.col("min_expected") <= 0, F.lit(True))
    )
    dof = F.col("k") - F.when(F.col("has_ctrl"), 1).otherwise(0)  # a missing control is a row of zeros
    chi2 = F.when(bad, 0.0).otherwise(F.col("stat"))
    staged = per.select(*keys, chi2.alias("chi2"), dof.cast("bigint").alias("dof"), bad.alias("bad"))
    return staged.selectExpr(
        *[f"`{k}`" for k in keys], "chi2", f"CASE WHEN bad THEN 1D ELSE {chi2_sf_sql('chi2', 'dof')} END AS p_value", "dof"
    ).selectExpr("*", f"p_value < {alpha!r}D AS significant").select(*keys, "chi2", "p_value", "significant", "dof")


def chi_square_global(arm_table: DataFrame, p: Params, keys: list[str] | None = None) -> DataFrame:
    """I4 over control + all variants of each test."""
    keys = keys or ["experiment_id"]
    return chi_square(arm_table.select(*keys, "variant", "conversions", "group_size"), keys, p.alpha,
                      control=F.col("variant").eqNullSafe(F.lit(p.control_variant)))


def chi_square_pairwise(arm_table: DataFrame, p: Params, keys: list[str] | None = None) -> DataFrame:
    """I4 on the 2 x 2 table control vs each variant (keys + variant): each
    variant row becomes its two table rows (variant, control)."""
    keys = keys or ["experiment_id"]
    pairs = _pairs(arm_table, keys, p)
    cells = pairs.select(
        *keys,
        "variant",
        F.explode(
            F.array(
                F.struct(F.col("vc").alias("conversions"), F.col("vn").alias("group_size")),
                F.struct(F.col("cc").alias("conversions"), F.col("cn").alias("group_size")),
            )
        ).alias("c"),
    ).select(*keys, "variant", "c.conversions", "c.group_size")
    return chi_square(cells, [*keys, "variant"], p.alpha)


def experiment_report(arm_table: DataFrame, p: Params, keys: list[str] | None = None,
                      with_variants: bool = False) -> DataFrame:
    """Per test, the first variant (lowest name) z-test and 2 x 2
    chi-square, plus the global chi-square over all arms.  A test with a
    control only is reported against an empty arm named 'Variant'.
    ``with_variants`` adds the A/B/n set: an array of I3's rows by variant
    (empty where I3 has none), a few per test.

    The parts read the same arm table, so it is checkpointed once
    (eagerly, into the shared checkpoint folder): the assignments x
    subscriptions aggregation runs one time, and the lineage is cut."""
    keys = keys or ["experiment_id"]
    arm_table = checkpointed(arm_table.select(*keys, "variant", "conversions", "group_size"))
    # an arm without a name takes part under the last name there can be
    named = arm_table.fillna({"variant": _UNNAMED})
    alone = named.groupBy(*keys).agg(F.max(F.col("variant") != p.control_variant).alias("other")).where(~F.col("other"))
    none = F.lit(0).cast("bigint")
    filled = named.unionByName(
        alone.select(*keys, F.lit("Variant").alias("variant"), none.alias("conversions"), none.alias("group_size")))
    z = ztest(filled, p, keys)
    first = z.groupBy(*keys).agg(F.min("variant").alias("variant"))
    z1 = z.join(first, [*keys, "variant"])
    pair = chi_square_pairwise(filled, p, keys).select(
        *keys, "variant",
        F.col("chi2").alias("chi2"), F.col("p_value").alias("chi2_p_value"), F.col("significant").alias("chi2_significant"),
    )
    glob = chi_square_global(arm_table, p, keys).select(
        *keys,
        F.col("chi2").alias("global_chi2"),
        F.col("p_value").alias("global_chi2_p_value"),
        F.col("significant").alias("global_chi2_significant"),
    )
    out = z1.join(pair, [*keys, "variant"], "left").join(glob, keys, "left").withColumn(
        "variant", F.nullif(F.col("variant"), F.lit(_UNNAMED))).withColumnRenamed("variant", "first_variant")
    if not with_variants:
        return out
    abn = abn_test(arm_table, p, keys)
    row = F.struct(*[c for c in abn.columns if c not in keys])
    sets = abn.groupBy(*keys).agg(F.sort_array(F.collect_list(row)).alias("variants"))
    return out.join(sets, keys, "left").withColumn("variants", F.coalesce("variants", F.array().cast(sets.schema["variants"].dataType)))


def scenarios_from_counts(spark, rows: list[tuple]) -> DataFrame:
    """Arm table from literal counts: rows of (scenario, variant, conversions,
    size) (used by unit tests and what-if calls with supplied counts)."""
    return spark.createDataFrame(rows, "scenario string, variant string, conversions bigint, group_size bigint")
