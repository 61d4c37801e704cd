"""Churn model K1-K8 with Spark ML.

K1 builds one feature row per paid subscription from the user-day mart merged
per user; the mart, the users and the subscriptions are bucketed by user, so
neither the merge nor the joins need an exchange.

The model is a ``pyspark.ml`` pipeline: alphabetical ``StringIndexer`` for
the three categorical columns (unseen labels -> code 0, as the reference
falls back to its first class), ``VectorAssembler`` and a
``RandomForestClassifier`` (100 trees, depth 6, seed 42).  Training is
distributed by Spark ML; nothing is collected except model metadata.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from growlytics.config import CHURN_FEATURES, DEFAULT_IMPORTANCES, Params
from growlytics.functions.dates import lit_ts, whole_days_between
from growlytics.operators import forest
from growlytics.operators import user_days as days
from growlytics.operators.experiment_log import last_of_sample

CATEGORICAL = ("plan", "channel", "device_type")


def features(wh, p: Params, leak_free: bool = False) -> DataFrame:
    """K1: paid subscriptions x users, with session, event and payment
    aggregates; defaults 0 / 365 / 'Desktop' / 0.0; label = cancelled.

    As coded by the reference, activity up to the as-of date is used, so a
    short life (the label) also shows as fewer sessions and payments.  With
    ``leak_free=True`` each user's activity is cut at their own cutoff (the
    cancellation date, or as-of when active) and recency is measured from
    that cutoff.  A cutoff is a day, so whole days of the user-day mart fall
    on one side of it.  All four tables are bucketed by user: there is no
    exchange of fact or mart rows."""
    subs = wh.stg_subscriptions.where(F.col("plan").isin(*p.paid_plans)).select("user_id", "plan", "status")
    users = wh.dim_users.select("user_id", "channel")
    rows = wh.user_days.select("user_id", "day", *days.COLUMNS)
    until = lit_ts(p.as_of)
    if leak_free:
        paid = wh.stg_subscriptions.where(F.col("plan").isin(*p.paid_plans))
        cutoffs = paid.groupBy("user_id").agg(F.max(F.coalesce(F.col("end_date"), F.lit(p.as_of).cast("date"))).alias("cutoff"))
        rows = rows.join(cutoffs, "user_id").where("day < cutoff").drop("cutoff")
        users = users.join(cutoffs, "user_id", "left")
        until = F.col("cutoff").cast("timestamp")
    # by device first, by a hash: what the maximum of strings sorts is no longer a row per day
    per = days.per_user(days.merged(rows, "user_id", "device_type")).withColumnRenamed("device_type", "device")
    recency = whole_days_between(until, F.col("last_start"))
    return (
        subs.join(users, "user_id")
        .join(per, "user_id", "left")
        .select(
            "user_id",
            "plan",
            "channel",
            F.coalesce("sessions", F.lit(0).cast("bigint")).alias("session_count"),
            F.coalesce(recency, F.lit(p.missing_recency).cast("bigint")).alias("recency"),
            F.coalesce("device", F.lit(p.default_device)).alias("device_type"),
            F.coalesce("searches", F.lit(0).cast("bigint")).alias("search_count"),
            F.coalesce("page_views", F.lit(0).cast("bigint")).alias("pv_count"),
            F.coalesce("event_ids", F.lit(0).cast("bigint")).alias("total_events"),
            F.coalesce(F.col("amount").cast("double"), F.lit(0.0)).alias("total_revenue"),
            (F.col("status") == "cancelled").cast("int").alias("churned"),
        )
    )


def split(feats: DataFrame, p: Params, label: str = "churned", tight: bool = False,
          counted: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """K3: deterministic ~80/20 split by a seeded hash of the user id.

    The hash is independent of the label, so each class is split in the
    same proportion (stratified in expectation) without a shuffle or a
    per-class window.  ``tight=True`` makes the proportion exact: each class
    gives ``test_fraction`` of its rows, rounded, the first by md5 of the user
    (:func:`growlytics.operators.experiment_log.exact_sample`: a filter).  The
    rows are counted in several passes, over ``counted`` if given: the same
    rows, cheaper to read."""
    h = F.xxhash64(F.col("user_id"), F.lit(p.seed))
    if not tight:
        cut = int(round(p.test_fraction * 10_000))
        bucket = F.pmod(h, F.lit(10_000))
        return feats.where(bucket >= cut), feats.where(bucket < cut)
    held = F.lit(False)
    counted = feats if counted is None else counted
    for x, n in counted.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect():  # one row a class
        mine = F.col(label).eqNullSafe(F.lit(x))
        last = last_of_sample(counted.where(mine), int(n * p.test_fraction + 0.5), "user_id", p.seed)
        if last is not None:
            held = held | (mine & last)
    return feats.where(~held), feats.where(held)


def _indexers() -> list[StringIndexer]:
    return [
        StringIndexer(inputCol=c, outputCol=f"{c}_raw_idx", stringOrderType="alphabetAsc", handleInvalid="keep")
        for c in CATEGORICAL
    ]


def enough_rows(feats: DataFrame, p: Params) -> bool:
    """K4's row minimum holds for the whole feature table, not for the
    training part of it."""
    return feats.limit(p.min_training_rows).count() >= p.min_training_rows


def fit(train: DataFrame, p: Params, label: str = "churned", whole: DataFrame | None = None) -> PipelineModel | None:
    """K2 + K4: fit encoders and the forest; None under the row minimum,
    which holds for ``whole``, the feature table that ``train`` is a part of
    (``train`` itself if not given).

    The training rows are persisted (memory, spilling to disk) for the
    duration of the fit: the indexers, the split search and the tree
    levels each pass over them, and without it every pass would recompute
    the feature joins.  A lost executor's blocks are recomputed from
    lineage."""
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _fit(train, p, label) if enough_rows(train if whole is None else whole, p) else None
    finally:
        train.unpersist()


def _fit(train: DataFrame, p: Params, label: str) -> PipelineModel | None:
    if train.isEmpty():
        return None
    enc = Pipeline(stages=_indexers()).fit(train)
    # unseen labels get index n_labels from 'keep'; map them to code 0
    n = {c: len(m.labelsArray[0]) for c, m in zip(CATEGORICAL, enc.stages)}
    remap = ", ".join(
        f"CASE WHEN {c}_raw_idx >= {n[c]} THEN 0.0 ELSE {c}_raw_idx END AS {c}_idx" for c in CATEGORICAL
    )
    sql = SQLTransformer(statement=f"SELECT *, {remap} FROM __THIS__")
    cols = [f"{c}_idx" if c in CATEGORICAL else c for c in CHURN_FEATURES]
    asm = VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="skip")
    rf = RandomForestClassifier(
        labelCol=label, featuresCol="features", numTrees=p.churn_trees, maxDepth=p.churn_depth, seed=p.seed
    )
    prepared = asm.transform(sql.transform(enc.transform(train)))
    rf_model = rf.fit(prepared)
    return PipelineModel(stages=[*enc.stages, sql, asm, rf_model])


def score(model: PipelineModel | None, feats: DataFrame) -> DataFrame:
    """K6: churn probability per feature row (rule score when no model).  A
    row with a missing feature cannot be scored and gets 0.5, prediction 1.
    The forest runs as expressions over the feature columns
    (:mod:`growlytics.operators.forest`)."""
    if model is None:
        return feats.withColumn("churn_probability", rule_score(feats)).withColumn(
            "prediction", (F.col("churn_probability") >= 0.5).cast("double")
        )
    return forest.scored(feats, *forest.compiled(feats.sparkSession, model))


def transformed(model: PipelineModel, feats: DataFrame) -> DataFrame:
    """K6 by the ML pipeline itself: what :func:`score` must equal."""
    numeric = [c for c in CHURN_FEATURES if c not in CATEGORICAL]
    whole = F.lit(True)
    for c in numeric:
        x = F.col(c).cast("double")
        whole = whole & x.isNotNull() & ~F.isnan(x)
    # an unscorable row goes through the forest with zeros, then gets 0.5
    filled = feats.select("*", whole.alias("_whole"), *[F.col(c).alias(f"_given_{c}") for c in numeric])
    filled = filled.withColumns({c: F.when(F.col("_whole"), F.col(c)).otherwise(F.lit(0).cast(feats.schema[c].dataType)) for c in numeric})
    out = model.transform(filled)
    return out.select(
        *[F.col(f"_given_{c}").alias(c) if c in numeric else F.col(c) for c in feats.columns],
        F.when(F.col("_whole"), vector_to_array("probability")[1]).otherwise(0.5).alias("churn_probability"),
        F.when(F.col("_whole"), F.col("prediction")).otherwise(1.0).alias("prediction"),
    )


def rule_score(feats: DataFrame | None = None, recency=None, device=None):
    """K7: 0.15, +0.55 if recency > 90 else +0.25 if > 30, +0.15 on Mobile,
    clamped to [0.05, 0.95]."""
    r = F.col("recency") if recency is None else recency
    d = F.col("device_type") if device is None else device
    base = (
        F.lit(0.15)
        + F.when(r > 90, 0.55).when(r > 30, 0.25).otherwise(0.0)
        + F.when(d == "Mobile", 0.15).otherwise(0.0)
    )
    return F.least(F.lit(0.95), F.greatest(F.lit(0.05), base))


def evaluate(pred: DataFrame, label: str = "churned", prediction: str = "prediction") -> DataFrame:
    """K5: accuracy and per-class precision, recall, F1 and support from the
    confusion counts (one small aggregate)."""
    conf = pred.groupBy(F.col(label).cast("int").alias("y"), F.col(prediction).cast("int").alias("yhat")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # the totals stand beside the few cells, so the predictions are made once
    all_cells = Window.partitionBy(F.lit(1))
    right = F.when(F.col("y") == F.col("yhat"), F.col("n")).otherwise(0)
    conf = conf.select("*", F.sum("n").over(all_cells).alias("total"), F.sum(right).over(all_cells).alias("correct"))
    # each confusion cell credits its true class (tp or fn) and, when wrong,
    # its predicted class (fp): an explode + aggregate, no join
    hit = F.col("y") == F.col("yhat")
    n = F.col("n")
    credits = F.array(
        F.struct(F.col("y").alias("cls"), F.when(hit, n).otherwise(0).alias("tp"),
                 F.lit(0).cast("bigint").alias("fp"), F.when(hit, 0).otherwise(n).alias("fn")),
        F.struct(F.col("yhat").alias("cls"), F.lit(0).cast("bigint").alias("tp"),
                 F.when(hit, 0).otherwise(n).alias("fp"), F.lit(0).cast("bigint").alias("fn")),
    )
    per = conf.select(F.explode(credits).alias("c"), "total", "correct").groupBy("c.cls").agg(
        F.sum("c.tp").alias("tp"), F.sum("c.fp").alias("fp"), F.sum("c.fn").alias("fn"), F.max("total").alias("total"), F.max("correct").alias("correct")
    )
    precision = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0))
    recall = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), F.lit(0.0))
    out = per.select(
        F.col("cls").cast("bigint").alias("class"),
        precision.alias("precision"),
        recall.alias("recall"),
        (F.col("tp") + F.col("fn")).cast("bigint").alias("support"),
        F.try_divide(F.col("correct"), F.col("total")).alias("accuracy"),
    )
    f1 = F.coalesce(
        F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)
    )
    return out.withColumn("f1", f1)


def importances(spark: SparkSession, model: PipelineModel | None) -> DataFrame:
    """K8: feature importances, largest first (the fixed table without a model)."""
    if model is None:
        values = list(DEFAULT_IMPORTANCES)
    else:
        values = [float(v) for v in model.stages[-1].featureImportances.toArray()]
    df = spark.createDataFrame(list(zip(CHURN_FEATURES, values)), "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature")


def save(model: PipelineModel, path: str) -> None:
    """Persist the fitted pipeline (encoders included)."""
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
