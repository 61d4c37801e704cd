"""The load from raw files: scan, quarantine, clean files, quality report.

For each dataset, :func:`load` reads the raw file set once (A1), keeps refused
lines in a quarantine, cleans the accepted rows (B3-B6), writes them as
``clean_<dataset>`` (A2) and adds a row to the quality report (A5).  Every
table is replaced by a swapped pointer, and the report, which is written last,
names what belongs together: a load that dies leaves the last one readable.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from growlytics.operators import quality
from growlytics.session import shared_path
from growlytics.sources import files, versions


def load(spark: SparkSession, inputs: dict[str, str], base: str, workers: int = 4) -> DataFrame:
    """``inputs``: dataset to the path of its raw CSV files.  Returns the
    quality report (one row per dataset)."""
    def one(dataset: str) -> tuple:
        landed = shared_path(spark, "ingested", dataset)
        lines, refused = files.ingest(spark, dataset, inputs[dataset], landed)
        versions.replace(files.quarantine(spark, dataset, landed), f"{base}/rejected_{dataset}")
        rows = files.accepted(spark, dataset, landed)
        versions.replace(quality.clean(rows, dataset), f"{base}/clean_{dataset}")
        return dataset, lines, refused, landed

    with ThreadPoolExecutor(max_workers=workers) as pool:
        done = list(pool.map(one, inputs))
    report = None
    for dataset, lines, refused, landed in done:
        part = quality.full_report(files.accepted(spark, dataset, landed), dataset)
        part = part.withColumns({"lines": F.lit(lines).cast("bigint"), "refused_lines": F.lit(refused).cast("bigint")})
        report = part if report is None else report.unionByName(part)
    files.write_report(report, f"{base}/report")
    return read_report(spark, base)


def clean(spark: SparkSession, dataset: str, base: str) -> DataFrame:
    """A cleaned dataset as the last load left it."""
    return versions.read(spark, f"{base}/clean_{dataset}")


def rejected(spark: SparkSession, dataset: str, base: str) -> DataFrame:
    """Its refused lines."""
    return versions.read(spark, f"{base}/rejected_{dataset}")


REPORT = ("dataset string, initial_row_count bigint, final_row_count bigint, duplicate_rows_removed bigint, validation_failures_removed bigint, "
          "null_counts map<string,bigint>, null_rates map<string,double>, lines bigint, refused_lines bigint")


def read_report(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema(REPORT).json(f"{base}/report")
