"""The churn forest as data: a node table, and Column expressions made of it.

A fitted pipeline (string encoders, assembler, random forest) becomes a table
of nodes: (tree, node, feature, threshold, left, right, p0, p1, gain, weight).
From it follow, in plain DataFrame expressions,

* scores: every tree is one nested CASE over the feature columns, encoders
  included, so that scoring needs no ML transformer, no vector column and no
  Python, and Spark compiles it with the rest of the query;
* importances: gains weighted by rows, per tree, then over trees.

The table is bounded by the model's parameters: trees x (2^(depth+1) - 1)
nodes, 12,700 at 100 trees of depth 6; that is what comes to the driver to
build the expressions.  It can be written, read back and checked like any
other table."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from growlytics.config import CHURN_FEATURES
from growlytics.session import shared_path

NODES = ("tree int, node int, feature int, threshold double, `left` int, `right` int, p0 double, p1 double, gain double, weight double")
CODES = "feature string, label string, code double"


def nodes(spark: SparkSession, path: str) -> DataFrame:
    """The node table of the forest of a saved pipeline."""
    stages = sorted(r["path"] for r in _folders(spark, f"{path}/stages"))
    saved = spark.read.parquet(f"{stages[-1]}/data")
    n = F.col("nodeData") if "nodeData" in saved.columns else F.struct("*")
    stats = n["impurityStats"]
    total = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    inner = n["leftChild"] >= 0
    return saved.select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), F.when(inner, n["split"]["featureIndex"]).alias("feature"),
        F.when(inner, F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        F.when(inner, n["leftChild"]).alias("left"), F.when(inner, n["rightChild"]).alias("right"),
        (stats[0] / total).alias("p0"), (stats[1] / total).alias("p1"), F.when(inner, n["gain"]).alias("gain"), total.alias("weight"))


def _folders(spark: SparkSession, path: str) -> list[dict]:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [{"path": s.getPath().toString()} for s in fs.listStatus(p) if s.isDirectory()]


_COMPILED: dict[str, tuple[list, list]] = {}


def compiled(spark: SparkSession, model: PipelineModel, path: str | None = None) -> tuple[list, list]:
    """The rows of a pipeline's node table and code table, made once per
    pipeline; ``path``: where it is saved, if it is."""
    key = f"{spark.sparkContext.applicationId}/{model.uid}/{path}"
    if key not in _COMPILED:
        if path is None:
            path = shared_path(spark, "models", "compiled")
            model.write().save(path)
        _COMPILED[key] = nodes(spark, path).collect(), codes(spark, model).collect()
    return _COMPILED[key]


def codes(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """K2 as a table: the code of each label, 0, 1, ... in alphabetical order;
    a label that is not listed has code 0."""
    rows = [(s.getInputCol(), label, float(i)) for s in model.stages if hasattr(s, "labelsArray") for i, label in enumerate(s.labelsArray[0])]
    return spark.createDataFrame(rows, CODES)


def encoding(feats: DataFrame, column: str) -> DataFrame:
    """K2 without a fitted model: (label, code) of one column of a feature
    table, alphabetically from 0.  One row per distinct label; the window has
    no more rows than that."""
    labels = feats.where(F.col(column).isNotNull()).select(F.col(column).alias("label")).distinct()
    order = F.row_number().over(Window.partitionBy(F.lit(column)).orderBy("label"))
    return labels.select(F.lit(column).alias("feature"), "label", (order - 1).cast("double").alias("code"))


def _literal(x: float) -> str:
    return f"{x!r}D"


def _coded(name: str, table: list[tuple[str, float]]) -> str:
    """The code of a categorical column; 0 for labels that are not listed."""
    cases = " ".join("WHEN '{}' THEN {}".format(label.replace("\\", "\\\\").replace("'", "\\'"), _literal(code)) for label, code in table)
    return f"CASE `{name}` {cases} ELSE 0D END" if table else "0D"


def _tree_sql(rows: dict[int, tuple], inputs: list[str], value: str, at: int = 0) -> str:
    r = rows[at]
    if r["left"] is None:
        return _literal(r[value])
    return (f"CASE WHEN {inputs[r['feature']]} <= {_literal(r['threshold'])} THEN {_tree_sql(rows, inputs, value, r['left'])} "
            f"ELSE {_tree_sql(rows, inputs, value, r['right'])} END")


def scored(feats: DataFrame, node_rows: list, code_rows: list) -> DataFrame:
    """K6: ``feats`` with churn_probability and prediction.  Each tree is a
    column of its own, so that no generated method holds the whole forest;
    a row with a missing number gets 0.5 and prediction 1."""
    table = {c: [(r["label"], r["code"]) for r in code_rows if r["feature"] == c] for c in CHURN_FEATURES}
    numeric = [c for c in CHURN_FEATURES if not table[c]]
    inputs = [f"_x{i}" for i in range(len(CHURN_FEATURES))]
    whole: Column = F.lit(True)
    for c in numeric:
        x = F.col(c).cast("double")
        whole = whole & x.isNotNull() & ~F.isnan(x)
    rows = feats.select("*", whole.alias("_whole"), *[
        F.expr(_coded(c, table[c]) if table[c] else f"CAST(`{c}` AS DOUBLE)").alias(x) for c, x in zip(CHURN_FEATURES, inputs)])
    trees: dict[int, dict[int, dict]] = {}
    for r in node_rows:
        trees.setdefault(r["tree"], {})[r["node"]] = r.asDict()
    names = []
    for t in sorted(trees):
        names.append(f"_t{t}")
    rows = rows.select("*", *[F.expr(_tree_sql(trees[t], inputs, "p1")).alias(n) for t, n in zip(sorted(trees), names)])
    votes = F.expr(" + ".join(names)) / F.lit(float(len(names)))
    return rows.select(*feats.columns, F.when(F.col("_whole"), votes).otherwise(0.5).alias("churn_probability"),
                       F.when(F.col("_whole"), (votes > 0.5).cast("double")).otherwise(1.0).alias("prediction"))


def importances(node_table: DataFrame) -> DataFrame:
    """K8 from the nodes: per tree, gain times rows per feature, as a share of
    the tree; then the features' shares over all trees, largest first."""
    per = node_table.where(F.col("left").isNotNull()).groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("weight")).alias("g"))
    tree = Window.partitionBy("tree")
    share = F.try_divide(F.col("g"), F.sum("g").over(tree))
    per = per.select("feature", F.coalesce(share, F.lit(0.0)).alias("s")).groupBy("feature").agg(F.sum("s").alias("s"))
    names = node_table.sparkSession.createDataFrame(list(enumerate(CHURN_FEATURES)), "feature int, name string")
    every = names.join(per, "feature", "left").select(F.col("name").alias("feature"), F.coalesce("s", F.lit(0.0)).alias("s"))
    total = F.sum("s").over(Window.partitionBy(F.lit(1)))  # one row a feature
    return every.select("feature", F.coalesce(F.try_divide(F.col("s"), total), F.lit(0.0)).alias("importance")).orderBy(F.desc("importance"), "feature")
