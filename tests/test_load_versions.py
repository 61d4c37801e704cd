"""Loads that fail halfway, incremental months, refused lines."""

import pytest
from pyspark.sql import functions as F

from growlytics.operators import quality
from growlytics.sources import etl, files, versions
from growlytics.sources.warehouse import input_files


class Killed(Exception):
    pass


def die():
    raise Killed


def test_reader_sees_old_or_new(spark, tmp_path):
    base = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        versions.read(spark, base)
    with pytest.raises(Killed):
        versions.replace(spark.range(3).toDF("x"), base, then=die)
    with pytest.raises(FileNotFoundError):
        versions.read(spark, base)
    versions.replace(spark.range(3).toDF("x"), base)
    old = versions.read(spark, base)  # a reader that has begun
    with pytest.raises(Killed):
        versions.replace(spark.range(5).toDF("x"), base, then=die)
    assert versions.read(spark, base).count() == 3
    versions.replace(spark.range(7).toDF("x"), base)
    assert old.count() == 3 and versions.read(spark, base).count() == 7
    assert versions.vacuum(spark, base, older_than_ms=-60_000) == 3  # the first, and the two that were killed
    assert versions.read(spark, base).count() == 7


def _raw(spark, path, name, rows):
    df = spark.createDataFrame(rows, "payment_id long, amount double, payment_date string")
    df.coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")


def _load(spark, path, base, then=None):
    inputs = [f for f in input_files(spark, path) if f[0].endswith(".parquet")]
    return versions.load_months(spark, inputs, lambda paths: spark.read.schema("payment_id long, amount double, payment_date string").parquet(*paths),
                                lambda df: df.dropDuplicates().where("amount > 0"), "to_date(payment_date)", base, then)


def _rows(spark, base):
    return sorted((r.payment_id, r.amount, r.month_id) for r in versions.read_months(spark, base).collect())


def test_one_changed_file_rewrites_its_months(spark, tmp_path):
    path, base = str(tmp_path / "raw"), str(tmp_path / "fact")
    _raw(spark, path, "a", [(1, 1.0, "2001-01-05"), (2, 2.0, "2001-02-05")])
    _raw(spark, path, "b", [(3, 3.0, "2001-02-09"), (3, 3.0, "2001-02-09"), (4, 4.0, "2001-03-01"), (5, -1.0, "2001-03-02")])
    _raw(spark, path, "c", [(6, 6.0, "2001-04-01"), (7, 7.0, None)])
    assert _load(spark, path, base) == [versions.NO_MONTH, 200101, 200102, 200103, 200104]
    all_rows = [(1, 1.0, 200101), (2, 2.0, 200102), (3, 3.0, 200102), (4, 4.0, 200103), (6, 6.0, 200104), (7, 7.0, 0)]
    assert _rows(spark, base) == all_rows
    assert _load(spark, path, base) == []  # nothing changed
    before = {r.month: r.version for r in versions.months(spark, base).collect()}
    # one file changes: its month of before and of now, with the rows that other files have there
    _raw(spark, path, "a", [(1, 1.5, "2001-01-05"), (2, 2.0, "2001-02-05")])
    with pytest.raises(Killed):
        _load(spark, path, base, then=die)
    assert _rows(spark, base) == all_rows
    assert _load(spark, path, base) == [200101, 200102]
    assert _rows(spark, base) == [(1, 1.5, 200101), *all_rows[1:]]
    after = {r.month: r.version for r in versions.months(spark, base).collect()}
    assert {m for m in after if after[m] != before[m]} == {200101, 200102}
    # a row moves to a new month, another file goes
    _raw(spark, path, "a", [(1, 1.5, "2001-05-05"), (2, 2.0, "2001-02-05")])
    import shutil

    shutil.rmtree(f"{path}/c")
    assert _load(spark, path, base) == [versions.NO_MONTH, 200101, 200102, 200104, 200105]
    assert _rows(spark, base) == [(1, 1.5, 200105), (2, 2.0, 200102), (3, 3.0, 200102), (4, 4.0, 200103)]


PAYMENTS = '''payment_id,user_id,amount,payment_date
p1,u1,10.5,2001-01-01
p1,u1,10.5,2001-01-01
p2,u2,abc,2001-01-02
p3,u3,NA,2001-01-03
p4,u4,5
p5,u5,6,2001-01-05,extra
p6,u6,7,soon
p7,"u,7",-8,2001-01-07
p8,,9,
'''


@pytest.fixture
def payments(tmp_path):
    path = tmp_path / "payments.csv"
    path.write_text(PAYMENTS)
    return str(path)


def test_every_line_is_accepted_or_refused(spark, payments, tmp_path):
    out = str(tmp_path / "in")
    assert files.ingest(spark, "payments", payments, out) == (9, 4)
    assert [r.payment_id for r in files.accepted(spark, "payments", out).orderBy("payment_id").collect()] == ["p1", "p1", "p3", "p7", "p8"]
    bad = {r.line: r.reason for r in files.quarantine(spark, "payments", out).collect()}
    assert bad["p4,u4,5"] == bad["p5,u5,6,2001-01-05,extra"] == "fields" and sorted(bad.values()) == ["bad amount", "bad payment_date", "fields", "fields"]
    assert any("abc" in line and "p2" in line for line in bad)
    seven = files.accepted(spark, "payments", out).where("payment_id = 'p7'").first()
    assert (seven.user_id, seven.amount) == ("u,7", -8.0)


def test_load_leaves_clean_files_rejects_and_report(spark, payments, tmp_path):
    base = str(tmp_path / "out")
    report = etl.load(spark, {"payments": payments}, base).first()
    assert (report.lines, report.refused_lines, report.initial_row_count, report.duplicate_rows_removed, report.validation_failures_removed, report.final_row_count) == (9, 4, 5, 1, 2, 2)
    assert report.null_counts["amount"] == 1 and report.null_counts["user_id"] == 1 and report.null_rates["payment_date"] == pytest.approx(0.2)
    assert sorted(r.payment_id for r in etl.clean(spark, "payments", base).collect()) == ["p1", "p8"]
    assert etl.rejected(spark, "payments", base).count() == 4


def test_observed_profile_equals_a_scan(spark, tmp_path):
    df = spark.createDataFrame([("s1", None, "Free", "active"), ("s2", "u", "Gold", None), (None, "u", None, "gone")], "subscription_id string, user_id string, plan string, status string")
    watched, seen = quality.observed(df.repartition(3), "subscriptions")
    watched.write.parquet(str(tmp_path / "x"))
    got = {c: (n, nulls, bad) for _, c, n, nulls, bad in quality.observed_profile(df.columns, "subscriptions", seen)}
    assert got == {"subscription_id": (3, 1, None), "user_id": (3, 1, None), "plan": (3, 1, 1), "status": (3, 1, 1)}
    want = {r.column: r.null_count for r in quality.null_profile(df, "subscriptions").collect()}
    assert {c: x[1] for c, x in got.items()} == want


def _dirty(spark):
    n = "string"
    users = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], f"user_id {n}")
    sessions = spark.createDataFrame([("1", "a"), ("1", "zz"), ("2", "zz"), ("3", None)] + [(f"h{i}", "hot") for i in range(300)], f"session_id {n}, user_id {n}")
    subs = spark.createDataFrame([("s", "active", "Free"), ("s", "odd", "Gold"), ("t", "odd", None)], f"subscription_id {n}, status {n}, plan {n}")
    return {"users": users, "sessions": sessions, "events": spark.createDataFrame([("e",)], f"event_id {n}"), "subscriptions": subs,
            "payments": spark.createDataFrame([], f"payment_id {n}"), "experiments": spark.createDataFrame([("b",), ("q",), (None,)], f"user_id {n}")}


def test_source_tests_with_and_without_profile(spark, tmp_path):
    raw = _dirty(spark)
    plain = {(r.dataset, r.test, r.column): r.failures for r in quality.source_tests(raw).collect()}
    assert plain["users", "unique", "user_id"] == 1 and plain["sessions", "unique", "session_id"] == 1 and plain["subscriptions", "unique", "subscription_id"] == 1
    assert plain["sessions", "relationships", "user_id"] == 302 and plain["experiments", "relationships", "user_id"] == 1
    assert plain["subscriptions", "accepted_values", "status"] == plain["subscriptions", "accepted_values", "plan"] == 1
    assert plain["subscriptions", "not_null", "plan"] == plain["users", "not_null", "user_id"] == 1 and len(plain) == 18
    rows = []
    for d, df in raw.items():
        watched, seen = quality.observed(df, d)
        watched.write.parquet(str(tmp_path / d))
        rows += quality.observed_profile(df.columns, d, seen)
    profile = spark.createDataFrame(rows, quality.PROFILE).collect()
    assert {(r.dataset, r.test, r.column): r.failures for r in quality.source_tests(raw, profile).collect()} == plain


def test_key_tests_scan_each_dataset_once_and_join_nothing(spark, tmp_path):
    raw = {}
    for d, df in _dirty(spark).items():
        df.write.parquet(str(tmp_path / d))
        raw[d] = spark.read.parquet(str(tmp_path / d))
    plan = quality.key_tests(raw)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("FileScan") == len(raw)


def test_fingerprints_resolve_collisions(spark):
    rows = [(1, None, "a"), (1, None, "a"), (1, "a", None), (2, "b", "c"), (None, None, None), (None, None, None)]
    df = spark.createDataFrame(rows, "x int, y string, z string")
    for prints in (quality.fingerprint, lambda d: (F.lit(1), F.lit(2)), lambda d: (F.coalesce(F.col("x"), F.lit(0)) % 2, F.lit(0))):
        r = quality.duplicate_stats(df, "d", prints).first()
        assert (r.initial_rows, r.distinct_rows, r.duplicate_rows) == (6, 4, 2)
    r = quality.duplicate_stats(df.limit(0), "d").first()
    assert (r.initial_rows, r.distinct_rows) == (0, 0)
    # the null mask keeps (null, a) and (a, null) apart without a comparison
    h = df.select(*quality.fingerprint(df)).distinct().count()
    assert h == 4


def test_fingerprint_shuffle_carries_no_row(spark, tmp_path):
    spark.range(1000).select("id", F.lit("long text").alias("t"), F.lit(1).alias("n")).write.parquet(str(tmp_path / "w"))
    df = spark.read.parquet(str(tmp_path / "w"))
    out = quality.duplicate_stats(df, "w")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("hashpartitioning(t") == 0 and "hashpartitioning(id" not in plan.split("Reused")[0].split("LocalTableScan")[0] or "EmptyRelation" in plan or "LocalTableScan" in plan


@pytest.mark.parametrize("n", [0, 1, 7, 100, 499, 500, 900])
def test_exact_sample_equals_the_sorted_one(spark, n):
    from growlytics.operators import experiment_log as XL

    df = spark.range(500).withColumn("v", F.col("id") * 2)
    got = sorted(r.id for r in XL.exact_sample(df, n, "id", 42, few=3).collect())
    assert got == sorted(r.id for r in XL.seeded_sample(df, n, "id", 42).collect()) and len(got) == min(n, 500)
    if 0 < n < 500:
        plan = XL.exact_sample(df, n, "id", 42)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Limit" not in plan
