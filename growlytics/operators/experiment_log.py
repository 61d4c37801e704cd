"""Experiment-log preparation: B12-B16 (the generator's data steps, re-aimed
as table operators on an exposure log ``user_id, timestamp, group,
landing_page, converted``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growlytics.config import Params
from growlytics.functions.dates import lit_ts


def consistent_assignments(log: DataFrame) -> DataFrame:
    """Keep (control, old_page) and (treatment, new_page) exposures."""
    g, lp = F.col("group"), F.col("landing_page")
    return log.where(((g == "control") & (lp == "old_page")) | ((g == "treatment") & (lp == "new_page")))


def keep_first(log: DataFrame, key: str = "user_id", order: tuple[str, ...] = ("timestamp",),
               tiebreak: str | None = None) -> DataFrame:
    """First row per key, by ``order`` then ``tiebreak``.

    ``min(struct(order..., tiebreak, rest...))`` per key is a partial
    aggregate: each task keeps one candidate per key before the shuffle, so
    a key with a third of all rows costs no more than any other (a
    ``row_number`` window would sort that key's rows in one task)."""
    first_cols = [*order, *([tiebreak] if tiebreak else [])]
    rest = [c for c in log.columns if c != key and c not in first_cols]
    packed = F.struct(*[F.col(c) for c in first_cols + rest])
    return log.groupBy(key).agg(F.min(packed).alias("_first")).select(key, "_first.*").select(*log.columns)


def seeded_sample(df: DataFrame, n: int, key: str, seed: int) -> DataFrame:
    """Reproducible sample of ``n`` rows (all when n >= rows).

    Rows are ranked by ``md5(key || '|' || seed)`` (ties by key) and the
    first n kept: Spark plans ``orderBy().limit(n)`` as a per-partition
    top-n merged once (no full sort).  The limit is the operator itself;
    md5 makes the sample reproducible by any engine."""
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))
    return df.orderBy(h, F.col(key)).limit(n)


def last_of_sample(df: DataFrame, n: int, key: str, seed: int, few: int = 4096) -> Column | None:
    """The condition that holds for the first ``n`` rows by (md5 of key and
    seed, key), and for all further rows of the last one's key; None if
    n <= 0.  Rows without a key come first.

    The md5 of a row is compared digit by digit: a histogram of the next four
    hex digits says in which bucket the n-th row lies, then only that bucket is
    counted again, until it has at most ``few`` rows.  Those are counted per
    key and give the last one that stays.  A histogram has at most 65,536
    rows; there is no sort and no task that gathers the sample."""
    if n <= 0:
        return None
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))
    prefix, left, inside = "", n, df
    while True:
        part = F.substring(h, len(prefix) + 1, 4)
        steps = inside.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.col("p").asc_nulls_first()).collect()
        for r in steps:
            if r["c"] >= left:
                break
            left -= r["c"]
        else:
            return F.lit(True)  # fewer than n rows
        if r["p"] is None:
            return h.isNull()
        prefix += r["p"]
        inside = df.where(h.startswith(prefix))
        if r["c"] <= few or len(prefix) == 32:
            break
    for r in inside.groupBy(h.alias("h"), F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("c")).orderBy("h", "k").collect():
        if r["c"] >= left:
            break
        left -= r["c"]
    return h.isNull() | (h < r["h"]) | ((h == r["h"]) & (F.col(key) <= F.lit(r["k"])))


def exact_sample(df: DataFrame, n: int, key: str, seed: int, few: int = 4096) -> DataFrame:
    """B14 for any ``n``: the rows of :func:`seeded_sample`, by a filter over
    ``df``.  ``key`` tells rows apart (as after B13)."""
    last = last_of_sample(df, n, key, seed, few)
    return df.limit(0) if last is None else df.where(last)


def seeded_sample_fraction(df: DataFrame, fraction: float, key: str, seed: int) -> DataFrame:
    """B14 for very large samples: a hash threshold keeps about ``fraction``
    of the rows with no ordering or single-partition step."""
    cut = int(fraction * 10_000)
    return df.where(F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(10_000)) < cut)


def rescale_timestamps(df: DataFrame, col: str, start, end, out: str = "scaled_time") -> DataFrame:
    """Map [min, max] of ``col`` linearly onto [start, end]; a zero
    range maps everything to ``start``.  The min / max is a one-row
    aggregate attached with a broadcast cross join."""
    ts = F.col(col).cast("timestamp")
    mm = df.agg(F.unix_micros(F.min(ts)).alias("_lo"), F.unix_micros(F.max(ts)).alias("_hi"))
    s0 = F.unix_micros(lit_ts(start))
    span = F.unix_micros(lit_ts(end)) - s0
    rng = F.col("_hi") - F.col("_lo")
    scaled = F.when(
        rng > 0,
        F.timestamp_micros(
            F.round(s0 + (F.unix_micros(ts) - F.col("_lo")) * (span.cast("double") / rng.cast("double"))).cast("bigint")
        ),
    ).otherwise(lit_ts(start))
    return df.crossJoin(F.broadcast(mm)).withColumn(out, scaled).drop("_lo", "_hi")


def enrol(users: DataFrame, p: Params, signup_col: str = "scaled_time") -> DataFrame:
    """Users signing up on or after the enrolment start join the
    experiment: control -> Control, treatment -> Variant."""
    return users.where(F.col(signup_col) >= lit_ts(p.enrol_start)).select(
        F.lit(p.experiment_id).alias("experiment_id"),
        F.when(F.col("group") == "control", "Control").otherwise("Variant").alias("variant"),
        "user_id",
        F.col(signup_col).alias("assigned_date"),
    )


def prepare(log: DataFrame, p: Params, sample: bool = False) -> DataFrame:
    """B12 -> B13 -> (B14) -> B15: one row per user with its scaled time."""
    first = keep_first(consistent_assignments(log), "user_id", ("timestamp",), "exposure_id"
                       if "exposure_id" in log.columns else None)
    if sample:
        first = exact_sample(first, p.sample_size, "user_id", p.seed)
    return rescale_timestamps(first, "timestamp", p.rescale_start, p.rescale_end)
