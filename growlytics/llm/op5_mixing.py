"""Mixing sources to target weights by a hypergeometric splitting tree.

1. Targets: sources in code-point order (null last) get the weights in turn;
   the budget (``share`` of all words) is filled like water: no target is
   above ``most`` times its source, the excess goes to the others by weight.
2. Blocks: a source's documents are dealt by hash into blocks of about
   ``block_words`` words; an affine permutation orders the blocks.  The mix
   takes whole passes over the source and then the first blocks of one more
   pass, up to the target to the word: in the last block documents go in hash
   order and the last one gives its first words only (repeated rows of one
   document share what is left alike, so a few words may be missing).
3. Tree: the exact numbers of drawn blocks per source are split among the
   output shards by recursive halving; each node draws its left half from a
   multivariate hypergeometric distribution (numpy generator seeded by the
   node), so that every shard has a fair, exact, disjoint share.  A leaf
   needs only the path from the root: shards are drawn in parallel.
4. Inside a shard, rows are shuffled by hash (``pos``).

Nothing grows on the driver but one row per source.  Block and superblock
sums are pre-aggregated; prefix sums run per superblock of 1024 blocks, so a
source with a third of the corpus is not one task.

Defined cases: null or empty text has size 0 and is taken 0 words; null
sources are one source, last in order; repeated rows are documents of their
own; an empty table gives an empty mix; equal documents tie and are
interchangeable; extra columns are carried along.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from growlytics.llm.common import WORD, by_value, plain, restored, small, staged

by_value(__name__)
_PRIME = 2654435761


def targets(sized: DataFrame, weights=(5.0, 2.0, 1.0), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, rn, source_size, target) for a table with source and size."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("rn", F.row_number().over(order))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.col("rn") - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("w", w).withColumn("full_at", F.col("source_size") * F.lit(most) / F.col("w"))
    up = Window.orderBy("full_at", "rn")
    everything = up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = (
        per.withColumn("capped", F.coalesce(F.sum(F.col("source_size") * F.lit(most)).over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("open_w", F.sum("w").over(up.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("budget", F.sum("source_size").over(everything) * F.lit(share))
        .withColumn("level", (F.col("budget") - F.col("capped")) / F.col("open_w"))
        .withColumn("k", F.row_number().over(up))
        .withColumn("hit", F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("k", "level"))).over(everything))
    )
    target = F.when(F.col("k") >= F.col("hit.k"), F.col("w") * F.col("hit.level")).otherwise(F.col("source_size") * F.lit(most))
    return per.select("source", "rn", "source_size", target.cast("double").alias("target"))


def _descend(counts: np.ndarray, shards: int, seed: int):
    """Leaf -> (starts, counts) of its blocks per source; nodes on the current
    path are kept, so that neighbouring leaves share work."""
    path: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def leaf(i: int):
        lo, hi = 0, shards
        start, cnt = np.zeros_like(counts), counts
        while hi - lo > 1:
            mid = (lo + hi) // 2
            if (lo, hi) not in path:
                left = int(cnt.sum()) * (mid - lo) // (hi - lo)
                rng = np.random.default_rng([seed, lo, hi])
                path[lo, hi] = rng.multivariate_hypergeometric(cnt, left).astype(np.int64) if len(cnt) else cnt
            take = path[lo, hi]
            if i < mid:
                cnt, hi = take, mid
            else:
                start, cnt, lo = start + take, cnt - take, mid
        for k in [k for k in path if k[1] <= lo]:
            del path[k]
        return start, cnt

    return leaf


def _leaves(rns: list[int], quotas: list[int], shards: int, seed: int):
    def run(frames):
        leaf = _descend(np.array(quotas, np.int64), shards, seed)
        for f in frames:
            for i in sorted(f["id"].tolist()):
                start, cnt = leaf(i)
                keep = np.flatnonzero(cnt)
                yield pd.DataFrame({"shard": np.full(len(keep), i, np.int64), "rn": np.array(rns, np.int64)[keep],
                                    "lo": start[keep], "hi": start[keep] + cnt[keep]})

    return run


def placements(docs: DataFrame, weights=(5.0, 2.0, 1.0), share: float = 1.5, most: float = 2.0,
               block_words: int = 1 << 16, shard_words: int = 1 << 20, seed: int = 17,
               keep: bool = False) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, taken and
    ``placed``, an array of (copy, shard, words); with ``keep`` also all
    columns as c0, c1, ..."""
    spark = docs.sparkSession
    rows, at = plain(docs, doc_id="long", text="string", source="string")
    carried = rows.columns if keep else []
    base = rows.withColumns({n: F.col(c) for n, c in at.items()}).select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                       F.xxhash64("doc_id", "text", F.lit(seed)).alias("h"), *carried)
    slim = staged(base.drop(*carried), "mix-sizes")
    plan = [r.asDict() for r in targets(slim, weights, share, most).collect()]  # one row per source
    for r in plan:
        size, quota = r["source_size"], math.floor(r["target"] + 0.5)
        r["blocks"] = max(1, math.ceil(size / block_words))
        r["passes"], r["rest"] = divmod(min(quota, math.floor(most * size)), size) if size else (0, 0)
    schema = "source string, rn long, source_size long, target double, blocks long, passes long, rest long"
    sources = spark.createDataFrame([tuple(r[c.split()[0]] for c in schema.split(", ")) for r in plan], schema)

    def dealt(df: DataFrame) -> DataFrame:
        s = sources.withColumnRenamed("source", "its")
        return (df.join(s, df["source"].eqNullSafe(s["its"])).drop("its")
                .withColumn("block", F.pmod(F.col("h"), F.col("blocks")))
                .withColumn("rank", F.pmod(F.col("block") * F.lit(_PRIME) + F.lit(seed), F.col("blocks"))))

    blocks = dealt(slim).groupBy("rn", "rank", "blocks", "passes", "rest").agg(F.sum("size").alias("n_words"))
    blocks = staged(blocks.withColumn("part", F.floor(F.col("rank") / 1024)), "mix-blocks")
    parts = blocks.groupBy("rn", "part").agg(F.sum("n_words").alias("part_words"))
    before = Window.partitionBy("rn").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("rn", "part", F.coalesce(F.sum("part_words").over(before), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("rn", "part").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("part_start") + F.coalesce(F.sum("n_words").over(inside), F.lit(0))
    blocks = blocks.join(parts, ["rn", "part"]).withColumn("need", F.col("rest") - start)
    blocks = staged(blocks.select("rn", "rank", "blocks", "passes", "n_words", "need"), "mix-needs")

    drawn = blocks.groupBy("rn").agg((F.max("blocks") * F.max("passes") + F.max(F.when(F.col("need") > 0, F.col("rank") + 1).otherwise(0))).alias("q"))
    quotas = {r["rn"]: r["q"] for r in drawn.collect()}  # one row per source
    shards = max(1, math.ceil(sum(r["passes"] * r["source_size"] + r["rest"] for r in plan) / shard_words))
    rns = sorted(quotas)
    leaves = spark.range(shards).mapInPandas(_leaves(rns, [quotas[r] for r in rns], shards, seed), "shard long, rn long, lo long, hi long")
    ordinals = leaves.select("shard", "rn", F.explode(F.sequence("lo", F.col("hi") - 1)).alias("ordinal"))
    ordinals = ordinals.join(sources.select("rn", "blocks"), "rn")
    at = ordinals.groupBy("rn", (F.col("ordinal") % F.col("blocks")).alias("rank")).agg(
        F.sort_array(F.collect_list(F.struct(F.floor(F.col("ordinal") / F.col("blocks")).alias("copy"), "shard"))).alias("at"))
    blocks = staged(blocks.select("rn", "rank", "n_words", "need").join(at, ["rn", "rank"], "left"), "mix-drawn")

    cut = (F.col("need") > 0) & (F.col("need") < F.col("n_words"))
    # what the rows of each source's one cut block still give, from the slim
    # rows; equal rows share alike
    edge = dealt(slim).join(small(staged(blocks.where(cut).select("rn", "rank", "need"), "mix-cut")), ["rn", "rank"]).where("size > 0")
    edge = edge.groupBy("rn", "h", "need").agg(F.sum("size").alias("group"))
    ahead = F.coalesce(F.sum("group").over(Window.partitionBy("rn").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    edge = edge.withColumn("give", F.greatest(F.lit(0), F.least("group", F.col("need") - ahead))).where("give > 0")
    edge = small(staged(edge.select("rn", "h", "group", "give"), "mix-edge"))

    # the text meets the block plan and the edge where it is, if they are
    # small enough to be sent; else it is shuffled by block, once
    out = dealt(base).join(small(blocks), ["rn", "rank"]).join(edge, ["rn", "h"], "left")
    part = F.floor(F.col("give") * F.col("size") / F.col("group"))
    last = F.when(cut, F.coalesce(part, F.lit(0))).when(F.col("need") > 0, F.col("size")).otherwise(F.lit(0))
    out = out.withColumn("last", last.cast("long"))
    given = F.transform(F.coalesce("at", F.array().cast("array<struct<copy:bigint,shard:bigint>>")), lambda x: F.struct(
        x["copy"].alias("copy"), x["shard"].alias("shard"), F.when(x["copy"] < F.col("passes"), F.col("size")).otherwise(F.col("last")).alias("words")))
    out = out.withColumn("placed", F.filter(given, lambda x: x["words"] > 0))
    taken = F.col("passes") * F.col("size") + F.col("last")
    return out.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "placed", "h", *carried)


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: the columns of ``docs`` (``text`` cut to its first
    ``mix_words`` words where a document is the last of its source's draw)
    and mix_shard, mix_pos, mix_copy, mix_words."""
    names = docs.columns
    seed = options.get("seed", 17)
    placed = placements(docs, keep=True, **options).select("doc_id", "size", "h", *[f"c{i}" for i in range(len(names))], F.explode("placed").alias("p"))
    order = Window.partitionBy("p.shard").orderBy(F.xxhash64("h", "p.copy", F.lit(seed + 1)), "doc_id")
    placed = placed.withColumn("mix_pos", F.row_number().over(order).cast("long"))
    placed = placed.select("*", F.col("p.shard").alias("mix_shard"), F.col("p.copy").alias("mix_copy"), F.col("p.words").alias("mix_words"))
    text = F.col(f"c{names.index('text')}").cast("string")
    cut = F.concat_ws(" ", F.slice(F.regexp_extract_all(text, F.lit(f"({WORD})")), 1, F.greatest(F.lit(1), F.col("mix_words").cast("int"))))
    text = F.when(F.col("mix_words") < F.col("size"), cut).otherwise(text)
    return restored(placed, names, "mix_shard", "mix_pos", "mix_copy", "mix_words", text=text)
