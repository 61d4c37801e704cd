"""Profiling, cleaning and data-quality tests: B1-B11.

Every profile is one aggregation pass, or none: the load's own writes collect
it (:func:`observed`).  Duplicates are counted by 128-bit fingerprints, exact
by a comparison of the rows whose fingerprint repeats.  Keys of all datasets
are tested in one shuffle of key counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from growlytics.config import ACCEPTED_PLANS, ACCEPTED_STATUS


def null_profile(df: DataFrame, dataset: str) -> DataFrame:
    """B1 + B2: rows and, per column, null count and rate (count / rows,
    NULL for an empty input), in long form."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("_rows")] + [
        F.count_if(F.col(f"`{c}`").isNull()).alias(f"_n{i}") for i, c in enumerate(cols)
    ]
    one = df.agg(*aggs)
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_n{i}").alias("null_count")) for i, c in enumerate(cols)])
    return one.select(F.col("_rows").alias("row_count"), F.explode(entries).alias("e")).select(
        F.lit(dataset).alias("dataset"),
        "e.column",
        "row_count",
        "e.null_count",
        F.try_divide(F.col("e.null_count"), F.col("row_count")).alias("null_rate"),
    )


def fingerprint(df: DataFrame) -> tuple[Column, Column]:
    """128 bits of a row's content, nulls included: which columns are null is
    hashed with the values, as a null adds nothing to a hash by itself."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    empty = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in cols]) if cols else F.lit("")
    return F.xxhash64(*cols, empty), F.xxhash64(F.lit(0x5EED), empty, *reversed(cols))


def row_groups(df: DataFrame, valid: Column | None = None, prints=fingerprint) -> DataFrame:
    """One row of counts: rows, distinct whole rows (NULLs equal each other)
    and, of those, the valid ones.

    What is shuffled for all rows is their fingerprint.  A fingerprint that
    occurs once is one distinct row; whole rows are fetched only where a
    fingerprint repeats, and compared there, so that two rows that share one by
    chance stay two.  Copies are combined in the map tasks in both steps."""
    ok = F.lit(True) if valid is None else F.coalesce(valid, F.lit(False))
    h1, h2 = prints(df)
    rows = df.select("*", h1.alias("_h1"), h2.alias("_h2"))
    groups = rows.groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n"), F.count_if(ok).alias("_v"))
    single = groups.where("_n = 1").agg(F.count(F.lit(1)).alias("n"), F.count(F.lit(1)).alias("d"), F.sum("_v").alias("v"))
    again = rows.join(groups.where("_n > 1").select("_h1", "_h2"), ["_h1", "_h2"], "left_semi")
    whole = again.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_c"))
    many = whole.agg(F.sum("_c").alias("n"), F.count(F.lit(1)).alias("d"), F.count_if(ok).alias("v"))
    return single.unionByName(many).agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("n", "d", "v")])


def duplicate_stats(df: DataFrame, dataset: str, prints=fingerprint) -> DataFrame:
    """Rows, distinct whole rows (NULLs equal each other) and duplicates."""
    return row_groups(df, prints=prints).select(
        F.lit(dataset).alias("dataset"),
        F.col("n").alias("initial_rows"),
        F.col("d").alias("distinct_rows"),
        (F.col("n") - F.col("d")).alias("duplicate_rows"),
    )


def validity_rule(dataset: str) -> Column | None:
    """The row-level validation of a dataset (None = no rule)."""
    if dataset == "payments":
        return F.col("amount") > 0  # NULL amounts fail as well
    return None


def clean(df: DataFrame, dataset: str) -> DataFrame:
    """B3 dedupe, then B4 filter, B5 default fill, B6 open end dates."""
    out = df.dropDuplicates()
    rule = validity_rule(dataset)
    if rule is not None:
        out = out.where(rule)
    if dataset == "users":
        out = out.fillna({"plan_type": "Free", "country": "Unknown"})
    if dataset == "subscriptions" and isinstance(df.schema["end_date"].dataType, StringType):
        out = out.fillna({"end_date": ""})
    return out


def quality_report(df: DataFrame, dataset: str, prints=fingerprint) -> DataFrame:
    """Initial, final, duplicates removed and validation failures
    (= initial - final - duplicates), by fingerprints."""
    return row_groups(df, validity_rule(dataset), prints).select(
        F.lit(dataset).alias("dataset"),
        F.col("n").alias("initial_row_count"),
        F.col("v").alias("final_row_count"),
        (F.col("n") - F.col("d")).alias("duplicate_rows_removed"),
        (F.col("d") - F.col("v")).alias("validation_failures_removed"),
    )


def full_report(df: DataFrame, dataset: str) -> DataFrame:
    """B7 with the B2 null counts and rates attached as maps (A5 payload);
    the maps hold one entry per column of the dataset."""
    prof = null_profile(df, dataset).groupBy("dataset").agg(
        F.map_from_entries(F.collect_list(F.struct("column", "null_count"))).alias("null_counts"),
        F.map_from_entries(F.collect_list(F.struct("column", "null_rate"))).alias("null_rates"),
    )
    return quality_report(df, dataset).join(prof, "dataset")


def unique_test(df: DataFrame, cols: list[str]) -> DataFrame:
    """Non-null key values occurring more than once, with their count."""
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.where(cond).groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def not_null_failures(df: DataFrame, dataset: str, cols: list[str]) -> DataFrame:
    """Per column, rows where it is NULL (one pass for all columns)."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("failures")) for c in cols])
    return one.select(F.explode(entries).alias("e")).select(
        F.lit(dataset).alias("dataset"), F.lit("not_null").alias("test"), "e.column", "e.failures"
    )


def relationship_orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose (non-null) key has no parent row.

    The orphan keys are found first, from distinct child keys; whole rows are
    fetched only for those, and not at all if there are none."""
    orphans = orphan_key_counts(child, key, parent, parent_key).select("key")
    return child.join(orphans, F.col(key) == F.col("key"), "left_semi")


def orphan_key_counts(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """B10 as a report: orphan child keys with their row counts.

    Child keys are counted per key first (partial aggregation), so the anti
    join sees one row per distinct key: a key holding a third of all child
    rows costs one row, not a third of the table in one join task."""
    keys = child.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    pk = parent.select(F.col(parent_key).alias("_pk")).where(F.col("_pk").isNotNull())
    return keys.join(pk, F.col("key") == F.col("_pk"), "left_anti")


def accepted_values_failures(df: DataFrame, column: str, values: list) -> DataFrame:
    """Values outside the accepted set (NULL is checked by not_null),
    grouped with their row counts."""
    return (
        df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values))
        .groupBy(F.col(column).cast("string").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


#: The declared tests: unique keys, required columns, keys that must have a
#: user, and columns with an accepted set of values.
UNIQUE = {"users": "user_id", "sessions": "session_id", "events": "event_id", "subscriptions": "subscription_id", "payments": "payment_id"}
REQUIRED = {"users": ("user_id",), "sessions": ("session_id", "user_id"), "events": ("event_id",),
            "subscriptions": ("subscription_id", "status", "plan"), "payments": ("payment_id",), "experiments": ("user_id",)}
OF_USERS = ("sessions", "experiments")
ACCEPTED = {"subscriptions": {"status": ACCEPTED_STATUS, "plan": ACCEPTED_PLANS}}

PROFILE = "dataset string, column string, row_count bigint, null_count bigint, bad_count bigint"


def observed(df: DataFrame, dataset: str) -> tuple[DataFrame, Observation]:
    """``df`` and the metrics (B1, B2, B9, B11) that whatever action runs on it
    collects on the way: rows, nulls per column, values outside an accepted
    set.  A plain write of it is a result stage, whose tasks count once even
    when they are run again."""
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(df.columns):
        col = F.col(f"`{c}`")
        metrics.append(F.count_if(col.isNull()).alias(f"null{i}"))
        values = ACCEPTED.get(dataset, {}).get(c)
        if values:
            metrics.append(F.count_if(col.isNotNull() & ~col.isin(*values)).alias(f"bad{i}"))
    return df.observe(seen, *metrics), seen


def observed_profile(columns: list[str], dataset: str, seen: Observation) -> list[tuple]:
    """The metrics as rows of ``PROFILE``, one per column."""
    got = seen.get
    return [(dataset, c, got["rows"], got[f"null{i}"], got.get(f"bad{i}")) for i, c in enumerate(columns)]


def key_tests(raw: dict[str, DataFrame]) -> DataFrame:
    """B8 and B10 of all datasets: one scan and one shuffle of keys.

    Each row gives its keys, marked by the column they stand in; keys are
    counted per column (combined in the map tasks, so that a key with a third
    of all rows is one row per task) and then side by side per key: a key that
    its own column holds more than once is a duplicate, one that no user has is
    an orphan with as many rows as it was counted.  There is no join."""
    parts, slots = None, {}
    for dataset, df in raw.items():
        keys = []
        if dataset in UNIQUE:
            slots[dataset, "unique", UNIQUE[dataset]] = len(slots)
            keys.append((UNIQUE[dataset], slots[dataset, "unique", UNIQUE[dataset]], UNIQUE[dataset]))
        if dataset in OF_USERS:
            slots[dataset, "relationships", "user_id"] = len(slots)
            keys.append(("user_id", slots[dataset, "relationships", "user_id"], "user_id"))
        if not keys:
            continue
        at = F.array(*[F.struct(F.lit(space).alias("space"), F.lit(slot).alias("slot"), F.col(c).cast("string").alias("key")) for space, slot, c in keys])
        part = df.select(F.inline(at)).where(F.col("key").isNotNull())
        parts = part if parts is None else parts.unionByName(part)
    counted = parts.groupBy("space", "key", "slot").agg(F.count(F.lit(1)).alias("n"))
    beside = counted.groupBy("space", "key").agg(*[F.sum(F.when(F.col("slot") == i, F.col("n"))).alias(f"s{i}") for i in slots.values()])
    users = f"s{slots['users', 'unique', 'user_id']}"
    failures = {i: F.count_if(F.col(f"s{i}") > 1) if test == "unique" else F.sum(F.when(F.col(users).isNull(), F.col(f"s{i}")))
                for (_, test, _), i in slots.items()}
    one = beside.agg(*[F.coalesce(f, F.lit(0)).cast("bigint").alias(f"f{i}") for i, f in failures.items()])
    out = F.array(*[F.struct(F.lit(d).alias("dataset"), F.lit(t).alias("test"), F.lit(c).alias("column"), F.col(f"f{i}").alias("failures"))
                    for (d, t, c), i in slots.items()])
    return one.select(F.inline(out))


def source_tests(raw: dict[str, DataFrame], profile: list | None = None) -> DataFrame:
    """B8-B11 as declared for the six raw datasets: one row per test with the
    number of failing rows (0 = pass).  With the ``profile`` of the load, nulls
    are known and accepted values are looked at only where a bad one was seen;
    without it each dataset is scanned once more."""
    spark = next(iter(raw.values())).sparkSession
    out = key_tests(raw)
    schema = "dataset string, test string, column string, failures bigint"
    if profile is None:
        for d, cols in REQUIRED.items():
            out = out.unionByName(not_null_failures(raw[d], d, list(cols)))
        known = {}
    else:
        known = {(r["dataset"], r["column"]): r for r in profile}
        rows = [(d, "not_null", c, known[d, c]["null_count"]) for d, cols in REQUIRED.items() for c in cols]
        rows += [(d, "accepted_values", c, 0) for d, cols in ACCEPTED.items() for c in cols if not known[d, c]["bad_count"]]
        out = out.unionByName(spark.createDataFrame(rows, schema))
    for d, cols in ACCEPTED.items():
        for c, values in cols.items():
            if profile is None or known[d, c]["bad_count"]:
                bad = accepted_values_failures(raw[d], c, list(values)).agg(F.count(F.lit(1)).alias("failures"))
                out = out.unionByName(bad.select(F.lit(d).alias("dataset"), F.lit("accepted_values").alias("test"), F.lit(c).alias("column"), "failures"))
    return out
