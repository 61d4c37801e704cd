"""Scans and sinks.

All readers use explicit schemas (no inference pass over the data) and all
writers are parallel file writes: one file per task, no driver round trip.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from growlytics.sources.schemas import EXPERIMENT_LOG_SCHEMA, NA_TOKENS, RAW_SCHEMAS


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


_SCHEMAS: dict[str, StructType] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table scan.  The footer schema is looked up once per path and
    then passed explicitly, so each further scan of the table costs no
    footer read on the driver (and every call still yields a fresh plan,
    which keeps self-joins unambiguous)."""
    path = table_path(sf_dir, name)
    schema = _SCHEMAS.get(path)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[path] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)


def _na_to_null(df: DataFrame, schema: StructType) -> DataFrame:
    """Map every NA token to NULL in string columns (Spark has one nullValue)."""
    tokens = list(NA_TOKENS)
    cols: list[Column] = []
    for f in schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, StringType):
            c = F.when(~F.trim(c).isin(tokens), c).alias(f.name)
        cols.append(c)
    return df.select(*cols)


def read_raw(spark: SparkSession, dataset: str, path: str, fmt: str = "csv") -> DataFrame:
    """A1: read one raw dataset with its fixed schema.

    CSV: header row, NA tokens to NULL.  A missing path fails fast at
    planning time (Spark raises ``PATH_NOT_FOUND``), like the reference's
    stop-if-missing check.  ``fmt='parquet'`` reads an already-typed copy.
    """
    schema = RAW_SCHEMAS[dataset]
    if fmt == "parquet":
        return spark.read.parquet(path)
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    return _na_to_null(df, schema)


#: Columns that staging casts, per dataset; a text that cannot be cast refuses its line.
TYPED = {
    "users": {"signup_date": "date"},
    "sessions": {"session_start": "timestamp", "session_end": "timestamp"},
    "events": {"event_time": "timestamp"},
    "subscriptions": {"start_date": "date", "end_date": "date"},
    "payments": {"amount": "double", "payment_date": "date"},
    "experiments": {"assigned_date": "timestamp"},
}
_LINE = "_line"


def read_checked(spark: SparkSession, dataset: str, path: str) -> DataFrame:
    """A1 with a verdict on every line: the dataset's columns, ``reason`` (NULL
    where the line is accepted, else what is wrong with it) and ``line`` (the
    refused line: as read if it has too few or too many fields, else as JSON).

    All fields are read as text, so that an NA token in a number is a NULL and
    not a fault; column pruning is off for this scan, as a line's verdict must
    not depend on which columns a query wants."""
    schema = RAW_SCHEMAS[dataset]
    texts = StructType([StructField(f.name, StringType()) for f in schema.fields])
    df = (
        spark.read.schema(StructType([*texts.fields, StructField(_LINE, StringType())]))
        .option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _LINE).option("columnPruning", False)
        .csv(path)
    )
    df = df.select(*[F.when(~F.trim(c).isin(list(NA_TOKENS)), F.col(c)).alias(c) for c in texts.fieldNames()], _LINE)
    reason = F.when(F.col(_LINE).isNotNull(), "fields")
    for c, t in TYPED.get(dataset, {}).items():
        reason = reason.when((F.trim(c) != "") & F.col(c).try_cast(t).isNull(), f"bad {c}")
    typed = [F.col(f.name) if isinstance(f.dataType, StringType) else F.col(f.name).try_cast(f.dataType.simpleString()).alias(f.name) for f in schema.fields]
    line = F.when(F.col("reason").isNotNull(), F.coalesce(_LINE, F.to_json(F.struct(*texts.fieldNames()))))
    return df.withColumn("reason", reason).select(*typed, "reason", line.alias("line"))


def ingest(spark: SparkSession, dataset: str, path: str, out: str) -> tuple[int, int]:
    """Read a raw file set once and write its accepted lines and its refused
    ones (the quarantine) beside each other under ``out``; returns how many
    lines there were and how many were refused, as the write counted them."""
    seen = Observation()
    df = read_checked(spark, dataset, path)
    df = df.observe(seen, F.count(F.lit(1)).alias("lines"), F.count("reason").alias("refused"))
    df.withColumn("accepted", F.col("reason").isNull()).write.mode("overwrite").partitionBy("accepted").parquet(out)
    return seen.get["lines"], seen.get["refused"]


def accepted(spark: SparkSession, dataset: str, out: str) -> DataFrame:
    """The accepted lines of an ingested dataset."""
    return _ingested(spark, dataset, out).where("accepted").select(*RAW_SCHEMAS[dataset].fieldNames())


def quarantine(spark: SparkSession, dataset: str, out: str) -> DataFrame:
    """The refused lines of an ingested dataset: dataset, reason, line."""
    return _ingested(spark, dataset, out).where("NOT accepted").select(F.lit(dataset).alias("dataset"), "reason", "line")


def _ingested(spark: SparkSession, dataset: str, out: str) -> DataFrame:
    fields = [*RAW_SCHEMAS[dataset].fields, StructField("reason", StringType()), StructField("line", StringType()), StructField("accepted", BooleanType())]
    return spark.read.schema(StructType(fields)).parquet(out)


def read_jdbc_table(spark: SparkSession, url: str, table: str, partition_column: str,
                    lower: int, upper: int, num_partitions: int, properties: dict | None = None) -> DataFrame:
    """A4 for an external warehouse: a partitioned JDBC scan (one range of
    ``partition_column`` per task, never one connection for the whole
    table)."""
    return spark.read.jdbc(
        url, table, column=partition_column, lowerBound=lower, upperBound=upper,
        numPartitions=num_partitions, properties=properties or {},
    )


def read_experiment_log(spark: SparkSession, path: str) -> DataFrame:
    """The external experiment log; ``timestamp`` parsed to a timestamp."""
    df = spark.read.schema(EXPERIMENT_LOG_SCHEMA).option("header", True).csv(path)
    df = _na_to_null(df, EXPERIMENT_LOG_SCHEMA)
    return df.withColumn("timestamp", F.to_timestamp("timestamp"))


def write_clean(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """A2: write a cleaned dataset (parquet by default, CSV with header)."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


def load_table(df: DataFrame, name: str, partition_by: list[str] | None = None,
               bucket_by: tuple[int, str] | None = None) -> None:
    """Full-replace load of a managed table.

    ``partition_by`` lays facts out by month so date predicates prune;
    ``bucket_by=(n, key)`` co-locates tables joined on ``key``.  Readers by
    path have :mod:`growlytics.sources.versions`, where a replace is atomic.
    """
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        w = w.bucketBy(bucket_by[0], bucket_by[1]).sortBy(bucket_by[1])
    w.saveAsTable(name)


def write_report(report: DataFrame, path: str) -> None:
    """A5: the quality report as JSON lines, one record per dataset."""
    report.coalesce(1).write.mode("overwrite").json(path)


def write_raw_csv(df: DataFrame, path: str) -> None:
    """Write a dataset the way the raw files look (header, text dates)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        t = f.dataType.simpleString()
        if t == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        elif t.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        cols.append(c.alias(f.name))
    df.select(*cols).write.mode("overwrite").option("header", True).csv(path)


def exists(path: str) -> bool:
    return os.path.exists(path)
