"""Exact top-k search by integer inner product, in norm buckets.

Vectors are sorted into buckets of similar length (a grid of norm classes,
each split by hash into blocks of bounded size).  Queries are a stated set
(every id divisible by ``every``); they meet the buckets in blocks.  A first
round finds, per query, the k best of a seed block of the longest vectors; its
k-th score is a lower bound theta.  In the second round each bucket derives a
local cosine threshold theta / (|q| * longest): above 1 the bucket is skipped
(length pruning for the whole bucket); when it is selective the candidates are
cut by coordinates (the query's largest coordinate must lie in a range that
the cosine threshold allows), otherwise by length alone.  What is left is
verified by exact integer products, and each bucket returns its k best.

Defined cases: vectors that are null, empty, or hold a null or non-finite
component take no part; vectors of another length than the query's are not
compared; a null id takes no part; repeated rows are candidates of their own;
ties go to the smaller id; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from growlytics.llm.common import by_value, pick, staged

by_value(__name__)
BLOCK, QUERIES = 16384, 256
OUT = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, v (array<long>), dim, norm class and its hash block."""
    rows = pick(vectors, vec_id="long", embedding="array<double>")
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where("vec_id is not null and embedding is not null and size(embedding) > 0").where(good)
    rows = rows.select("vec_id", F.transform("embedding", lambda x: F.floor(x * scale)).alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return rows.select("vec_id", "v", F.size("v").alias("dim"), norm.alias("norm")).withColumn(
        "cls", F.floor(F.log(F.greatest(F.col("norm"), F.lit(1.0))) * 20).cast("long"))


def _products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Exact inner products: floats while all sums are below 2**53, else
    Python integers (a score beyond 64 bits is held at the end of the range)."""
    most = np.abs(q).astype(object).max(initial=0) * np.abs(p).astype(object).max(initial=0) * q.shape[1]
    if most < 2**53:
        return (q.astype(np.float64) @ p.astype(np.float64).T).astype(np.int64)
    full = q.astype(object) @ p.astype(object).T
    return np.clip(full, -(2**63), 2**63 - 1).astype(np.int64)


def _best(qid, pid, rows, cols, scores, k):
    """The k best per query, by (score desc, id)."""
    order = np.lexsort((pid[cols], -scores.astype(np.float64), rows)) if np.abs(scores).max(initial=0) < 2**53 else np.array(
        sorted(range(len(rows)), key=lambda i: (rows[i], -int(scores[i]), pid[cols[i]])), np.int64)
    rows, cols, scores = rows[order], cols[order], scores[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    keep = place < k
    return pd.DataFrame({"query_id": qid[rows[keep]], "vec_id": pid[cols[keep]], "score": scores[keep]})


def _search(k: int):
    def run(key, queries, block):
        if not len(queries) or not len(block):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        pid, p = block["vec_id"].to_numpy(np.int64), np.array(block["v"].tolist(), dtype=np.int64)
        length = np.sqrt((p.astype(np.float64) ** 2).sum(axis=1))
        order = np.argsort(-length, kind="stable")
        pid, p, length = pid[order], p[order], length[order]
        pf = p.astype(np.float64)
        unit = pf / np.maximum(length, 1e-300)[:, None]
        out = []
        for lo in range(0, len(queries), QUERIES):
            part = queries.iloc[lo:lo + QUERIES]
            qid, q = part["query_id"].to_numpy(np.int64), np.array(part["q"].tolist(), dtype=np.int64)
            theta = part["theta"].to_numpy(np.float64)  # -inf: not known yet
            qn = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
            # Cauchy-Schwarz: a vector can only matter where |q| |p| >= theta
            slack = 1e-9 * qn * length[0] + 1e-6
            live = qn * length[0] + slack >= theta
            if not live.any():
                continue
            rows, cols = [], []
            with np.errstate(divide="ignore", invalid="ignore"):
                local = theta / (qn * length[0])
            hard = live & (local > 0.6)  # selective: coordinate pruning pays
            for i in np.flatnonzero(hard):
                n = int(np.searchsorted(-length, -(theta[i] - slack[i]) / qn[i], side="right"))
                f = int(np.abs(q[i]).argmax())
                u, t = q[i, f] / qn[i], max(local[i] - 1e-9, -1.0)
                # cos(q, p) <= u x + sqrt(1 - u^2) sqrt(1 - x^2) for p's unit coordinate x
                x = np.clip(unit[:n, f], -1, 1)
                ok = u * x + np.sqrt(max(0.0, 1 - u * u)) * np.sqrt(1 - x * x) >= t - 1e-9
                c = np.flatnonzero(ok & (pid[:n] != qid[i]))
                rows.append(np.full(len(c), i)), cols.append(c)
            got = []
            if rows:
                r, c = np.concatenate(rows), np.concatenate(cols)
                if len(r):
                    s = np.concatenate([_products(q[i:i + 1], p[x])[0] for i, x in zip(np.flatnonzero(hard), cols)])
                    got.append((r, c, s))
            easy = np.flatnonzero(live & ~hard)
            for step in range(0, len(p), 4096) if len(easy) else ():
                s = _products(q[easy], p[step:step + 4096])
                s = np.where(pid[None, step:step + 4096] == qid[easy][:, None], np.iinfo(np.int64).min, s)
                if s.shape[1] > k:  # everything equal to or above the k-th stays: ties are settled by id below
                    kth = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k][:, None]
                    r, c = np.nonzero((s >= kth) & (s > np.iinfo(np.int64).min))
                else:
                    r, c = np.nonzero(s > np.iinfo(np.int64).min)
                got.append((easy[r], c + step, s[r, c]))
            if got:
                r, c, s = (np.concatenate([g[i] for g in got]) for i in range(3))
                out.append(_best(qid, pid, r, c, s, k))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")

    return run


def search(vectors: DataFrame, every: int = 50, k: int = 5, scale: int = 256, block: int = BLOCK, query_block: int = 4096) -> DataFrame:
    """query_id, rank, vec_id, score.  A task holds one block of candidates
    and one block of queries."""
    rows = staged(quantised(vectors, scale), "topk-vectors")
    # one row per vector length and norm class (a logarithmic grid)
    sizes = rows.groupBy("dim", "cls").agg(F.ceil(F.count("*") / block).cast("long").alias("blocks"))
    asked = F.count(F.when(F.col("vec_id") % every == 0, 1))
    parts = rows.groupBy("dim").agg(F.greatest(F.lit(1), F.ceil(asked / query_block)).cast("long").alias("parts"))
    sizes = staged(sizes.join(parts, "dim"), "topk-classes")
    rows = rows.join(sizes, ["dim", "cls"]).withColumn("blk", F.pmod(F.xxhash64("vec_id"), F.col("blocks")))
    rows = staged(rows, "topk-buckets")
    queries = rows.where(f"vec_id % {every} = 0").select(
        "dim", F.col("vec_id").alias("query_id"), F.col("v").alias("q"), F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("parts")).alias("part"))
    keys = ["dim", "cls", "blk", "part"]
    none = F.lit(float("-inf"))

    def met(q: DataFrame, classes: DataFrame, only_first: bool) -> DataFrame:
        last = F.lit(0) if only_first else F.col("blocks") - 1
        left = q.join(classes.select("dim", "cls", "blocks"), "dim").withColumn("blk", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))))
        right = rows.join(classes.select("dim", "cls"), ["dim", "cls"]) if only_first else rows
        right = right.where("blk = 0") if only_first else right
        right = right.select("dim", "cls", "blk", "vec_id", "v", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
        left = left.toDF(*[f"q_{c}" if c in keys else c for c in left.columns])  # names of their own: both sides stem from one table
        return left.groupBy(*[f"q_{c}" for c in keys]).cogroup(right.groupBy(*keys)).applyInPandas(_search(k), OUT)

    # first round: one block of the longest vectors of each dimension gives theta
    longest = sizes.groupBy("dim").agg(F.max(F.struct("cls", "blocks")).alias("s")).select("dim", "s.cls", "s.blocks")
    first = met(queries.withColumn("theta", none), longest, True)
    theta = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("m"))
    theta = theta.select("query_id", F.when(F.col("n") >= k, F.col("m").cast("double")).otherwise(none).alias("theta"))
    theta = staged(theta, "topk-theta")
    queries = queries.join(theta, "query_id", "left").withColumn("theta", F.coalesce("theta", none))
    hits = met(queries, sizes, False)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
