"""N-gram Jaccard join by chosen paths.

A document is the set of its ``n``-word shingles (lower-cased words; a
shorter text is one shingle).  Texts with equal sets collapse to a node.  The
chosen-path join splits the nodes recursively: at each tree node a set
follows the tokens j with h(path, j) < 1 / (t |x|), so a pair at the
threshold t shares about one path a level while unrelated sets part at once.
The paths depend on the set alone, so every task writes the chains of its own
sets; Spark counts the buckets level by level, and only the buckets that are
still large are split on.  Small buckets are compared in full.  Large buckets
are first compared with a few hubs, which joins crowds of near copies in one
step; a bucket that is still large at the last level is then compared in full
too, blocks against blocks, wherever its members are not yet in one component.
So every bucket at the end of a path is compared in full, and the runs give
the expected recall of a pair at the threshold, ``recall``: with p the chance
that the lineage of a pair survives all levels, ceil(log(1 - recall) /
log(1 - p)) runs.

Candidates are verified exactly.  Classes are the connected components of the
verified links; inside each class the links are then counted exactly, in
blocks of bounded size, so also links that no bucket held count.

Defined cases: null or blank texts have no shingle; each distinct one is its
own class without links; a class's id is its smallest non-null doc_id (null
if it has none); repeated rows and equal texts are links of each other; extra
columns are ignored or carried along.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growlytics.llm.common import Tokens, by_value, components, mix, pick, plain, restored, rolled, row_key, slices, small, staged

by_value(__name__)
N, NUM, DEN, DEPTH, LIMIT, RECALL, BLOCK, WIDE, AGREE = 5, 4, 5, 3, 12, 0.999, 256, 8192, 46
_ODD = np.uint64(0x9E3779B97F4A7C15)


def runs_needed(num: int, den: int, depth: int, recall: float) -> int:
    """Runs until a pair at the threshold shares a chain of ``depth`` tokens
    with probability ``recall``: common tokens chosen per level are about
    Poisson with mean |x & y| / (t |x|) = 2 / (1 + t)."""
    t, alive = num / den, 1.0
    for _ in range(depth):
        alive = 1 - math.exp(-2 / (1 + t) * alive)
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - alive)))


def shingle_sets(texts, n: int = N) -> list[np.ndarray]:
    """Distinct shingle hashes of each text, sorted."""
    t = Tokens([x.lower() if x else x for x in texts])
    h = t.hashes()
    every = rolled(h, n)
    out = []
    for a, b in zip(t.offsets[:-1].tolist(), t.offsets[1:].tolist()):
        out.append(np.unique(every[a:b - n + 1]) if b - a >= n else rolled(h[a:b], b - a) if b > a else h[a:a])
    return out


def chains(x: np.ndarray, runs: int, depth: int, num: int, den: int) -> np.ndarray:
    """The chosen paths of a set: rows of ``depth`` path ids (0 where the
    lineage has ended).  All open paths of a level go on at once."""
    if not len(x):
        return np.zeros((0, depth), np.uint64)
    limit = np.uint64(min(2**64 - 1, int(den / (num * len(x)) * 2**64)))
    seed = mix(np.arange(1, runs + 1, dtype=np.uint64) * _ODD)
    path, done = np.zeros((runs, 0), np.uint64), []
    for level in range(depth):
        up, kid = [], []
        step = max(1, (1 << 17) // len(x))
        for lo in range(0, len(seed), step):
            v = mix(x[None, :] ^ seed[lo:lo + step, None])
            i, j = np.nonzero(v <= limit)
            # ids that do not tell where the limit is
            up.append(i + lo), kid.append(mix(v[i, j] ^ (seed[lo + i] * _ODD)) | np.uint64(1))
        up, kid = np.concatenate(up) if up else np.zeros(0, np.int64), np.concatenate(kid) if kid else np.zeros(0, np.uint64)
        if level:
            ended = np.ones(len(seed), bool)
            ended[up] = False
            done.append(np.hstack([path[ended], np.zeros((int(ended.sum()), depth - level), np.uint64)]))
        path, seed = np.hstack([path[up], kid[:, None]]), kid
    return np.vstack([*done, path])


def sketch(x: np.ndarray) -> int:
    """64 bits: one of the least hash in each of 64 bins.  Two sets agree in
    about (1 + J) / 2 of them (more, if bins are empty)."""
    if not len(x):
        return 0
    v = mix(x ^ _ODD)
    at = (v >> np.uint64(58)).astype(np.int64)
    least = np.full(64, 2**64 - 1, np.uint64)
    np.minimum.at(least, at, v)
    bits = np.where(least < np.uint64(2**64 - 1), mix(least) & np.uint64(1), np.uint64(0))
    return int((bits << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64).view(np.int64))


def _nodes(n: int, runs: int, depth: int, num: int, den: int):
    def run(frames):
        for f in frames:
            texts = f["text"].tolist()
            for lo, hi in slices(texts):
                sets = shingle_sets(texts[lo:hi], n)
                rid = f["rid"].to_numpy(np.int64)[lo:hi]
                key = np.array([int(mix(x).sum(dtype=np.uint64).view(np.int64)) if len(x) else r for x, r in zip(sets, rid)], np.int64)
                yield pd.DataFrame({"rid": rid, "doc_id": f["doc_id"].array[lo:hi], "key": key, "n": [len(x) for x in sets], "sketch": [sketch(x) for x in sets],
                                    "paths": [chains(x, runs, depth, num, den).ravel().view(np.int64) for x in sets]})

    return run


def _sets(n: int):
    def run(frames):
        for f in frames:
            texts = f["text"].tolist()
            for lo, hi in slices(texts):
                yield pd.DataFrame({"key": f["key"].iloc[lo:hi].to_numpy(), "w": f["weight"].iloc[lo:hi].to_numpy(),
                                    "x": [s.view(np.int64) for s in shingle_sets(texts[lo:hi], n)]})

    return run


def candidates(nodes: DataFrame, depth: int = DEPTH, limit: int = LIMIT, num: int = NUM, den: int = DEN, agree: int = AGREE) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of node keys, a < b, from the buckets of the path tree,
    that pass the length filter and whose sketches agree in ``agree`` of 64
    bits (58 are expected at the threshold 0.8, with a deviation of 2.4); and
    the members (bucket, size, key, n, sketch) of the buckets that are still
    large at the last level, which have only met their hubs."""
    ids = [f"p{i}" for i in range(depth)]
    own = ["key", "n", "sketch"]
    chain = F.transform(F.sequence(F.lit(0), F.size("paths") - 1, F.lit(depth)), lambda i: F.slice("paths", i + 1, depth))
    rows = nodes.where("size(paths) > 0").select(*own, F.explode(chain).alias("c")).select(*own, *[F.col("c")[i].alias(p) for i, p in enumerate(ids)])

    def alike(x: str, y: str):
        return (F.greatest(f"{x}.n", f"{y}.n") * num <= F.least(f"{x}.n", f"{y}.n") * den) & (
            F.bit_count(F.col(f"{x}.sketch").bitwiseXOR(F.col(f"{y}.sketch"))) <= 64 - agree)

    out = None
    for level, p in enumerate(ids):
        rows = rows.where(F.col(p) != 0)
        members = rows.select(p, *own).distinct()
        sizes = staged(members.groupBy(p).agg(F.count("*").alias("size")).where("size > 1"), f"join-sizes-{level}")
        met = staged(members.join(sizes, p), f"join-met-{level}")
        few, many = met.where(F.col("size") <= limit), met.where(F.col("size") > limit)
        pairs = few.alias("x").join(few.alias("y"), (F.col(f"x.{p}") == F.col(f"y.{p}")) & (F.col("x.key") < F.col("y.key")) & alike("x", "y"))
        pairs = pairs.select(F.col("x.key").alias("a"), F.col("y.key").alias("b"))
        me = F.struct(*own)
        # the same three for most buckets of a crowd, so that its pairs stay few; the last level does not depend on them
        hubs = many.groupBy(p).agg(F.min(me).alias("h0"), F.max(me).alias("h1"), F.min(F.struct(F.xxhash64("key"), me.alias("me")))["me"].alias("h2"))
        stars = many.join(hubs, p).select(me.alias("x"), F.explode(F.array_distinct(F.array("h0", "h1", "h2"))).alias("y")).where((F.col("x.key") != F.col("y.key")) & alike("x", "y"))
        stars = stars.select(F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b"))
        pairs = staged(pairs.union(stars).distinct(), f"join-pairs-{level}")
        out = pairs if out is None else out.union(pairs)
        if level + 1 < depth:
            rows = staged(rows.join(many.select(p).distinct(), p).select(*own, *ids[level + 1:]), f"join-rows-{level}")
    return out.distinct(), met.where(F.col("size") > limit).select(F.col(p).alias("bucket"), "size", *own)


def _sides(f):
    """The rows of the two blocks of a group, and whether they are the same."""
    left = (f["blk"] == f["i"]).to_numpy()
    same = bool((f["i"] == f["j"]).iloc[0])
    a = np.flatnonzero(left)
    return a, a if same else np.flatnonzero(~left), same


def _similar(x, a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
    """Which of the sets ``a`` and ``b`` of ``x`` are similar, exactly."""
    size = x.map(len).to_numpy(np.int64)
    every = np.concatenate(x.tolist()) if len(x) else np.empty(0, np.int64)
    _, code, times = np.unique(every, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(x)), size)
    shared = times[code] > 1
    number = np.cumsum(times > 1) - 1
    code, row = number[code[shared]], row[shared]
    order = np.argsort(code, kind="stable")
    code, row = code[order], row[order]
    common = np.zeros((len(x), len(x)), np.float32)
    width = int(code[-1]) + 1 if len(code) else 0
    for lo in range(0, width, 4096):  # a slice of the shared shingles at a time
        s, e = np.searchsorted(code, [lo, lo + 4096])
        m = np.zeros((len(x), min(4096, width - lo)), np.float32)
        m[row[s:e], code[s:e] - lo] = 1
        common += m @ m.T
    return common[np.ix_(a, b)] * (num + den) >= num * (size[a][:, None] + size[b][None, :])


def _met(num: int, den: int, agree: int):
    def run(f):
        """The rows of a group that pass the filters with a row of the other
        block that is in another component."""
        a, b, _ = _sides(f)
        n, sk, comp = (f[c].to_numpy(np.int64) for c in ("n", "sketch", "comp"))
        keep = np.zeros(len(f), bool)
        for lo in range(0, len(a), 256):
            x, y = a[lo:lo + 256, None], b[None, :]
            ok = comp[x] != comp[y]
            ok &= np.maximum(n[x], n[y]) * num <= np.minimum(n[x], n[y]) * den
            ok &= np.bitwise_count((sk[x] ^ sk[y]).view(np.uint64)) <= 64 - agree
            keep[x[ok.any(1), 0]] = True
            keep[b[ok.any(0)]] = True
        return f.loc[keep, ["bucket", "key", "comp"]]

    return run


def _joins(num: int, den: int):
    def run(f):
        """Links of a group that join its components (a spanning forest)."""
        a, b, _ = _sides(f)
        key, comp = f["key"].to_numpy(np.int64), f["comp"].to_numpy(np.int64)
        ok = _similar(f["x"], a, b, num, den) & (comp[a][:, None] != comp[b][None, :])
        up, out = {c: c for c in comp.tolist()}, []

        def root(c):
            while up[c] != c:
                up[c] = c = up[up[c]]
            return c

        for i, j in np.argwhere(ok).tolist():
            s, t = root(int(comp[a[i]])), root(int(comp[b[j]]))
            if s != t:
                up[max(s, t)] = min(s, t)
                out.append((min(key[a[i]], key[b[j]]), max(key[a[i]], key[b[j]])))
        return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)

    return run


def _against(rows: DataFrame, block: int, *cols: str) -> DataFrame:
    """Every bucket (with its ``size``) in salted blocks of about ``block``
    rows; one group (bucket, i, j) for each two blocks."""
    rows = rows.withColumn("blocks", F.ceil(F.col("size") / block).cast("int")).withColumn("blk", F.pmod(F.xxhash64("key", "bucket"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select("bucket", F.least("blk", "other").alias("i"), F.greatest("blk", "other").alias("j"), "blk", "key", "comp", *cols)


def crowded(large: DataFrame, comps: DataFrame, sets: DataFrame, num: int = NUM, den: int = DEN, block: int = BLOCK, wide: int = WIDE, agree: int = AGREE) -> DataFrame:
    """Links (a, b) that join components inside the large buckets: all members
    of a bucket that is not one component are compared, by the filters in
    blocks of ``wide``, then those that pass by their sets in blocks of
    ``block``."""
    group = ["bucket", "i", "j"]
    rows = large.join(comps.withColumnRenamed("node", "key"), "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    mixed = rows.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("bucket")
    rows = _against(staged(rows.join(mixed, "bucket"), "join-crowds"), wide, "n", "sketch")
    met = staged(rows.groupBy(*group).applyInPandas(_met(num, den, agree), "bucket long, key long, comp long").distinct(), "join-crowds-met")
    rows = met.join(met.groupBy("bucket").agg(F.count("*").alias("size")), "bucket").join(sets.select("key", "x"), "key")
    return _against(rows, block, "x").groupBy(*group).applyInPandas(_joins(num, den), "a long, b long").distinct()


def _links(num: int, den: int):
    def run(f):
        """Links between the two blocks of a group (or inside one), by key."""
        a, b, same = _sides(f)
        ok = _similar(f["x"], a, b, num, den)
        w = f["w"].to_numpy(np.int64)
        if same:
            np.fill_diagonal(ok, False)
        key = f["key"].to_numpy()
        out = [pd.DataFrame({"key": key[a], "links": ok @ w[b]})]
        if not same:
            out.append(pd.DataFrame({"key": key[b], "links": ok.T @ w[a]}))
        return pd.concat(out)

    return run


def joined(docs: DataFrame, n: int = N, num: int = NUM, den: int = DEN, depth: int = DEPTH, limit: int = LIMIT,
           recall: float = RECALL, block: int = BLOCK, wide: int = WIDE) -> DataFrame:
    """(rid, doc_id, class_id, n_links, leader) per row of ``docs`` (doc_id,
    rid, text); leader is the rid of the class's first document."""
    runs = runs_needed(num, den, depth, recall)
    member = docs.select("doc_id", "rid", "text").mapInPandas(_nodes(n, runs, depth, num, den), "rid long, doc_id long, key long, n int, sketch long, paths array<long>")
    member = staged(member, "join-members")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nul"), "doc_id", "rid")).alias("first")
    nodes = member.groupBy("key", "n", "sketch").agg(first, F.count("*").alias("copies"), F.first("paths").alias("paths"))
    nodes = staged(nodes, "join-nodes")
    pairs, large = candidates(nodes, depth, limit, num, den)
    pairs = staged(pairs, "join-candidates")

    wanted = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).union(large.select("key")).distinct()
    wanted = nodes.join(wanted, "key").select("key", F.col("first.rid").alias("rid"), F.col("copies").alias("weight"))
    sets = docs.select("rid", "text").join(small(staged(wanted, "join-wanted")), "rid").dropDuplicates(["key"]).select("key", "weight", "text")
    sets = staged(sets.mapInPandas(_sets(n), "key long, w long, x array<long>"), "join-sets")
    both = pairs.join(sets.select(F.col("key").alias("a"), F.col("x").alias("xa")), "a").join(sets.select(F.col("key").alias("b"), F.col("x").alias("xb")), "b")
    common = F.size(F.array_intersect("xa", "xb"))
    links = both.where(common * (num + den) >= num * (F.size("xa") + F.size("xb"))).select("a", "b")
    links = staged(links, "join-links")
    comps = staged(components(links, "join-classes"), "join-components")
    more = staged(crowded(large, comps, sets, num, den, block, wide), "join-crowd-links")
    if not more.isEmpty():
        comps = staged(components(links.union(more), "join-classes"), "join-components")

    # exact links inside the classes, blocks against blocks
    size = comps.groupBy("comp").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    rows = comps.join(size, "comp").withColumnRenamed("node", "key").withColumn("blk", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    rows = rows.join(sets, "key").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("comp", F.least("blk", "other").alias("i"), F.greatest("blk", "other").alias("j"), "blk", "key", "w", "x")
    counted = rows.groupBy("comp", "i", "j").applyInPandas(_links(num, den), "key long, links long").groupBy("key").agg(F.sum("links").alias("links"))

    of = nodes.select("key", "n", "first", "copies").join(comps.withColumnRenamed("node", "key"), "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    heads = of.groupBy("comp").agg(F.min("first").alias("head"))
    of = of.join(heads, "comp").join(counted, "key", "left")
    of = staged(of.select("key", "head", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "n"), "join-labels")
    out = member.select("rid", "doc_id", "key").join(small(of), "key")
    blank = F.col("n") == 0
    return out.select("rid", "doc_id", F.col("head.doc_id").alias("class_id"), F.when(blank, 0).otherwise(F.col("n_links")).cast("long").alias("n_links"), F.col("head.rid").alias("leader"))


def classes(docs: DataFrame, **options) -> DataFrame:
    """doc_id, class_id, n_links for every document: the links are the other
    documents whose similarity is at least num/den."""
    rows = pick(docs, doc_id="long", text="string").withColumn("rid", row_key("doc_id", "text"))
    return joined(rows, **options).select("doc_id", "class_id", "n_links")


def representatives(docs: DataFrame, **options) -> DataFrame:
    """One document of each class (the first by doc_id); blank texts stay;
    columns as given."""
    rows, at = plain(docs, doc_id="long", text="string")
    rows = rows.withColumn("rid", row_key(at["doc_id"], at["text"]))
    out = joined(rows.select("rid", F.col(at["doc_id"]).alias("doc_id"), F.col(at["text"]).alias("text")), **options)
    leaders = staged(out.select(F.col("leader").alias("rid")).distinct(), "join-leaders")
    return restored(rows.join(small(leaders), "rid").dropDuplicates(["rid"]), docs.columns)
