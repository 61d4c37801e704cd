"""Registered queries: the load from raw files."""

from pyspark.sql import functions as F

from growlytics.operators import marts, quality, staging
from growlytics.plans.oracle import r6
from growlytics.plans.registry import register
from growlytics.session import shared_path
from growlytics.sources import etl, files, versions
from growlytics.sources.warehouse import input_files

# Payments as a raw file might bring them, by a fixed rule in both engines:
# numbers and dates that are none, missing and negative amounts, repeated lines.
LINES = """,
typed AS (
  SELECT payment_id, user_id, payment_date,
         CASE WHEN payment_id % 89 = 0 THEN 'bad amount' WHEN payment_id % 83 = 0 THEN 'bad payment_date' END AS reason,
         CASE WHEN payment_id % 101 = 0 THEN -amount WHEN payment_id % 103 <> 0 THEN amount END AS amount
  FROM payments
),
lines AS (SELECT * FROM typed UNION ALL SELECT * FROM typed WHERE payment_id % 97 = 0),
good AS (SELECT DISTINCT payment_id, user_id, amount, payment_date FROM lines WHERE reason IS NULL)
"""


def _raw_payments(ctx) -> str:
    """The payments as CSV files with faults."""
    pid = F.col("payment_id")
    amount = F.when(pid % 89 == 0, "abc").when(pid % 101 == 0, (-F.col("amount")).cast("string")).when(pid % 103 == 0, "n/a").otherwise(F.col("amount").cast("string"))
    day = F.when((pid % 83 == 0) & (pid % 89 != 0), "soon").otherwise(F.date_format("payment_date", "yyyy-MM-dd"))
    rows = ctx.raw("payments").select("payment_id", "user_id", amount.alias("amount"), day.alias("payment_date"))
    path = shared_path(ctx.spark, "csv", "payments")
    rows.unionAll(rows.where("payment_id % 97 = 0")).write.option("header", True).csv(path)
    return path


@register("a1_quarantine", extra=LINES, sql="""
SELECT 'payments' AS dataset, coalesce(reason, 'accepted') AS verdict, count(*) AS lines FROM lines GROUP BY ALL
UNION ALL SELECT 'payments', 'all', count(*) FROM lines
""")
def a1_quarantine(ctx):
    """Accepted and refused lines of a raw file with faults, and the number of
    lines that the same scan counted."""
    out = shared_path(ctx.spark, "ingested", "payments")
    lines, _ = files.ingest(ctx.spark, "payments", _raw_payments(ctx), out)
    good = files.accepted(ctx.spark, "payments", out).select(F.lit("payments").alias("dataset"), F.lit("accepted").alias("verdict"))
    bad = files.quarantine(ctx.spark, "payments", out).select("dataset", F.col("reason").alias("verdict"))
    counts = good.unionByName(bad).groupBy("dataset", "verdict").agg(F.count(F.lit(1)).alias("lines"))
    return counts.unionByName(ctx.spark.createDataFrame([("payments", "all", lines)], counts.schema))


def _loaded(ctx) -> str:
    base = shared_path(ctx.spark, "etl")
    users = shared_path(ctx.spark, "csv", "users")
    files.write_raw_csv(ctx.raw("users"), users)
    etl.load(ctx.spark, {"payments": _raw_payments(ctx), "users": users}, base)
    return base


@register("a2_clean_files", extra=LINES, sql="""
SELECT payment_id, user_id, round(CAST(amount AS DOUBLE), 6) AS amount, strftime(payment_date, '%Y-%m-%d') AS payment_date FROM good WHERE amount > 0
""")
def a2_clean_files(ctx):
    """The clean payments that a load from raw files leaves (A2, A3)."""
    rows = etl.clean(ctx.spark, "payments", _loaded(ctx))
    return rows.select(F.col("payment_id").cast("bigint").alias("payment_id"), F.col("user_id").cast("bigint").alias("user_id"), "amount", "payment_date")


@register("a5_report", extra=LINES, sql=f"""
SELECT 'payments' AS dataset, (SELECT count(*) FROM lines) AS lines, (SELECT count(reason) FROM lines) AS refused_lines, i.n AS initial_row_count, f.n AS final_row_count,
       i.n - d.n AS duplicate_rows_removed, d.n - f.n AS validation_failures_removed, (SELECT count(*) FROM lines WHERE reason IS NULL AND amount IS NULL) AS amount_nulls,
       {r6('(SELECT count(*) FROM lines WHERE reason IS NULL AND amount IS NULL) / i.n')} AS amount_null_rate
FROM (SELECT count(*) AS n FROM lines WHERE reason IS NULL) i, (SELECT count(*) AS n FROM good) d, (SELECT count(*) AS n FROM good WHERE amount > 0) f
UNION ALL SELECT 'users', count(*), 0, count(*), count(*), 0, 0, NULL, NULL FROM users
""")
def a5_report(ctx):
    """The quality report file of the same load, read back."""
    r = etl.read_report(ctx.spark, _loaded(ctx))
    return r.select("dataset", "lines", "refused_lines", "initial_row_count", "final_row_count", "duplicate_rows_removed", "validation_failures_removed",
                    F.col("null_counts")["amount"].alias("amount_nulls"), F.col("null_rates")["amount"].alias("amount_null_rate"))


@register("a6_incremental_load", sql=f"""
, changed AS (
  SELECT payment_date, CASE WHEN year(payment_date) = 1997 AND payment_id % 2 = 0 THEN amount * 2 ELSE amount END AS amount FROM payments WHERE year(payment_date) <> 1996 AND amount > 0
)
SELECT CAST(strftime(payment_date, '%Y%m') AS BIGINT) AS month, count(*) AS payments, {r6('sum(amount)')} AS amount, year(payment_date) = 1997 AS rebuilt
FROM changed GROUP BY ALL
""")
def a6_incremental_load(ctx):
    """Payments as one file set per year, loaded; then one year changes and
    another goes, and the next load rebuilds the months of those two only."""
    spark = ctx.spark
    path, base = shared_path(spark, "raw", "payments"), shared_path(spark, "fact", "payments")
    raw = ctx.raw("payments").withColumn("y", F.year("payment_date"))
    years = [r["y"] for r in raw.select("y").distinct().collect()]
    raw.write.partitionBy("y").parquet(path)

    def load():
        inputs = [f for f in input_files(spark, path) if f[0].endswith(".parquet")]
        columns = ctx.raw("payments").schema
        return versions.load_months(spark, inputs, lambda paths: spark.read.schema(columns).parquet(*paths),
                                    lambda df: marts.fact_payments(staging.stg_payments(quality.clean(df, "payments"))), "payment_date", base)

    load()
    first = versions.current(spark, base)
    amount = F.when(F.col("payment_id") % 2 == 0, F.col("amount") * 2).otherwise(F.col("amount")).cast("decimal(18,2)")
    ctx.raw("payments").where("year(payment_date) = 1997").withColumn("amount", amount).write.mode("overwrite").parquet(f"{path}/y=1997")
    if 1996 in years:
        ctx.raw("payments").limit(0).write.mode("overwrite").parquet(f"{path}/y=1996")
    load()
    rows = versions.read_months(spark, base).groupBy(F.col("month_id").cast("bigint").alias("month")).agg(
        F.count(F.lit(1)).alias("payments"), F.sum("amount").alias("amount"))
    made = versions.months(spark, base).select(F.col("month").cast("bigint").alias("month"), (F.col("version") != first).alias("rebuilt"))
    return rows.join(made, "month")
