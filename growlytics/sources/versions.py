"""Tables as versioned folders under one pointer.

A load writes new folders and never touches those a reader may be in; the
last thing it does is to replace the pointer, one small file, by an atomic
rename.  A reader that looks before sees the old table whole, one that looks
after sees the new one, and a load that is killed anywhere leaves the old
table as it was.

    <base>/data/<version>/...        parquet, written once
    <base>/catalog/<version>/...     (month, version): what the table consists of
    <base>/files/<version>/...       (path, length, changed, months): what it was made from
    <base>/CURRENT                   the version that counts

A fact is kept by month.  :func:`load_months` compares the input files with
those of the last load and rebuilds only the months that a new, changed or
removed file has or had; all other months stay in the folders they are in.
The lists of months and files are tables themselves (the driver holds a file
listing, as it does for any scan).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The month of rows without a date.
NO_MONTH = 0
FILES = "path string, length bigint, changed bigint"
CATALOG = "month int, version string"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def current(spark: SparkSession, base: str) -> str | None:
    """The version that the pointer names."""
    fs, p = _fs(spark, f"{base}/CURRENT")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def point(spark: SparkSession, base: str, version: str) -> None:
    """Swap the pointer: a new file renamed over the old one in one step."""
    jvm = spark.sparkContext._jvm
    fs, fresh = _fs(spark, f"{base}/CURRENT.{uuid.uuid4().hex}")
    out = fs.create(fresh, True)
    out.write(bytearray(version.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fresh, jvm.org.apache.hadoop.fs.Path(f"{base}/CURRENT"), options)


# ------------------------------------------------------------ whole tables


def replace(df: DataFrame, base: str, then: Callable[[], None] | None = None) -> str:
    """A3: full replace.  ``then`` runs between the write and the swap (tests
    fail there)."""
    spark, version = df.sparkSession, uuid.uuid4().hex
    df.write.parquet(f"{base}/data/{version}")
    if then:
        then()
    point(spark, base, version)
    return version


def read(spark: SparkSession, base: str) -> DataFrame:
    """The current version of a table written by :func:`replace`."""
    version = current(spark, base)
    if version is None:
        raise FileNotFoundError(f"no version of {base} has been completed")
    return spark.read.parquet(f"{base}/data/{version}")


# ----------------------------------------------------------- facts by month


def _month(date: Column) -> Column:
    return F.coalesce(F.year(date) * 100 + F.month(date), F.lit(NO_MONTH))


def load_months(spark: SparkSession, inputs: list[tuple[str, int, int]], scan: Callable[[list[str]], DataFrame],
                build: Callable[[DataFrame], DataFrame], date: str, base: str, then: Callable[[], None] | None = None) -> list[int]:
    """Bring the fact under ``base`` up to the input files (path, length,
    modification time) and return the months that were rebuilt.

    ``scan(paths)`` reads raw files (with ``date``, the raw column or
    expression that gives a row's date), ``build`` makes fact rows of raw rows
    and keeps that column.  Rows that repeat have one date, so a month can be
    cleaned without the others."""
    version, last = uuid.uuid4().hex, current(spark, base)
    now = spark.createDataFrame(inputs, FILES)
    if last:
        before = spark.read.parquet(f"{base}/files/{last}")
    else:
        before = spark.createDataFrame([], FILES + ", months array<int>")
    same = now.join(before, ["path", "length", "changed"])
    fresh = [r["path"] for r in now.join(same.select("path"), "path", "left_anti").select("path").collect()]
    # the months of new and changed files, from their date column alone
    if fresh:
        seen = scan(fresh).select(F.col("_metadata.file_path").alias("path"), _month(F.expr(date)).alias("m"))
        seen = seen.groupBy("path").agg(F.collect_set("m").alias("months"))
        listed = spark.createDataFrame([(p,) for p in fresh], "path string")
        key = F.regexp_replace("path", "^file:/+", "/")
        seen = seen.select(key.alias("k"), "months")
        seen = listed.select("path", key.alias("k")).join(seen, "k", "left").select("path", F.coalesce("months", F.array().cast("array<int>")).alias("months"))
    else:
        seen = spark.createDataFrame([], "path string, months array<int>")
    files = same.unionByName(now.join(seen, "path"))
    files.write.parquet(f"{base}/files/{version}")
    files = spark.read.parquet(f"{base}/files/{version}")
    old = before.join(same.select("path"), "path", "left_anti")
    touched = old.select(F.explode("months").alias("m")).union(seen.select(F.explode("months").alias("m"))).distinct()
    months = sorted(r["m"] for r in touched.collect())
    if not months and last:
        return []
    # every file that has a row of a touched month, and of those rows no others
    wanted = F.array(*[F.lit(m) for m in months]).cast("array<int>")
    paths = [r["path"] for r in files.where(F.arrays_overlap("months", wanted)).select("path").collect()]
    if paths:
        rows = build(scan(paths).where(_month(F.expr(date)).isin(months))).withColumn("month_id", _month(F.expr(date)))
        rows.repartition("month_id", F.pmod(F.xxhash64(*rows.columns), F.lit(64))).write.partitionBy("month_id").parquet(f"{base}/data/{version}")
    have = spark.read.parquet(f"{base}/data/{version}").select("month_id").distinct() if paths else None
    kept = [r for r in (spark.read.parquet(f"{base}/catalog/{last}").collect() if last else []) if r["month"] not in set(months)]
    made = [(r["month_id"], version) for r in have.collect()] if have is not None else []
    spark.createDataFrame([*[tuple(r) for r in kept], *made], CATALOG).coalesce(1).write.parquet(f"{base}/catalog/{version}")
    if then:
        then()
    point(spark, base, version)
    return months


def months(spark: SparkSession, base: str) -> DataFrame:
    """(month, version) of the current state."""
    return spark.read.schema(CATALOG).parquet(f"{base}/catalog/{current(spark, base)}")


def read_months(spark: SparkSession, base: str) -> DataFrame:
    """The fact of one moment: its months, each from the version it is in.  A
    filter on ``month_id`` prunes folders."""
    by_version: dict[str, list[int]] = {}
    for r in months(spark, base).collect():
        by_version.setdefault(r["version"], []).append(r["month"])
    out = None
    for version, ms in sorted(by_version.items()):
        root = f"{base}/data/{version}"
        part = spark.read.option("basePath", root).parquet(*[f"{root}/month_id={m}" for m in sorted(ms)])
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise FileNotFoundError(f"no month of {base} has been completed")
    return out


def vacuum(spark: SparkSession, base: str, older_than_ms: int = 24 * 3600 * 1000) -> int:
    """Remove versions that the current state does not use and that are older
    than any reader is expected to last; returns how many went."""
    now = current(spark, base)
    fs, catalog = _fs(spark, f"{base}/catalog/{now}")
    used = {now} | ({r["version"] for r in months(spark, base).collect()} if fs.exists(catalog) else set())
    limit, gone = spark.sparkContext._jvm.System.currentTimeMillis() - older_than_ms, 0
    for kind in ("data", "catalog", "files"):
        fs, p = _fs(spark, f"{base}/{kind}")
        for s in fs.listStatus(p) if fs.exists(p) else []:
            if s.getPath().getName() not in used and s.getModificationTime() <= limit:
                fs.delete(s.getPath(), True)
                gone += 1
    return gone
