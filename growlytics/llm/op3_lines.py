"""Line deduplication by an exact set-similarity join.

A line is the set of its words.  A line is removed when an earlier line (by
doc_id, nulls last, then line number) of the corpus has Jaccard similarity of
at least num/den to it; similarity is judged on the input, so the result does
not depend on an order of removals.  Blank lines stay.

1. Word frequencies give the global order "rarest first" (any total order is
   exact): words are counted in ``BUCKETS`` buckets of their hash, a table of
   fixed size; ties are ordered by hash.
2. Equal sets collapse to their first line (partial aggregation, so a line
   that stands in a third of all documents is one row per task).
3. Where more than ``CROWD`` lines share a min-hash, the first one is tried
   for all others.  What it matches exactly is settled, so a large group of
   near copies does not become all pairs.
4. All other lines probe an inverted index: the rarest words of each line
   (prefix filter; the shorter line of a pair needs fewer of them) meet those
   of all lines, under the length filter, the positional filter and a
   parity-bitmap bound on the symmetric difference (all exact: they drop no
   pair above the threshold).  Postings are dealt by word into buckets of
   bounded mean size, packed, and compared there.  One earlier match settles
   a line, so a bucket gives the ``FEW`` earliest candidates of each line.
5. Candidates are verified on the words themselves, the earliest of each line
   first.
6. A line that none of them settles is searched for by its words in buckets
   that had more for it and by its words with more than ``HOT`` postings: a
   semi join of these postings with all postings of the same words, on the
   words of the lines.  No step keeps more rows than a fixed number per posting.

Defined cases: null text stays null; empty and blank texts have no lines to
remove; repeated rows are one document and get the same result; equal lines
inside a document count as repeats; extra columns are carried along.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from growlytics.llm.common import Tokens, appended, by_value, mix, plain, restored, row_key, slices, small, staged

by_value(__name__)
NUM, DEN, MINHASHES = 4, 5, 3
BUCKETS, SHARE, CROWD, SOME = 1 << 22, 1e-6, 16, 8
ROW = "key long, n int, bm1 long, bm2 long, m0 long, m1 long, m2 long, nul boolean, doc_id long, rid long, line int, prefix array<int>"
#: The postings of about so many lines make a bucket; a task packs so many postings at a time, and compares so many pairs
#: at a time; a word with more postings than ``HOT`` is left to Spark's join, which splits it; a bucket gives a line so ``FEW``
#: candidates.
LINES, PACK, BLOCK, HOT, FEW = 1 << 13, 1 << 20, 1 << 18, 1 << 14, 4
POSTING = {"tok": np.uint32, "n": np.int32, "pos": np.int32, "key": np.int64, "bm1": np.uint64, "bm2": np.uint64}
PACKED = "bucket int, tok binary, n binary, pos binary, key binary, bm1 binary, bm2 binary"
SHARED = "key long, key_0 long, tok int"
_TOP = np.uint64(42)  # the 22 highest bits choose the bucket


def _frequencies(share: float):
    def run(batches):
        import pyarrow as pa

        count, total = np.zeros(BUCKETS, np.int64), 0
        for b in batches:
            texts = b.column("text").to_pylist()
            for lo, hi in slices(texts):
                h = Tokens(texts[lo:hi]).hashes()
                np.add.at(count, (h >> _TOP).astype(np.int64), 1)
                total += len(h)
        at = np.flatnonzero(count >= max(2.0, total * share))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(count[at])], ["bucket", "n"])

    return run


def frequency_classes(texts: DataFrame, share: float = SHARE) -> np.ndarray:
    """A class from 0 (rare) to 63 for each bucket of word hashes: the
    logarithm of the bucket's count.  A bucket that no task finds frequent
    stays at 0; that only moves its words in the order."""
    counts = texts.mapInArrow(_frequencies(share), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(BUCKETS, np.uint8)
    out[counts["bucket"].to_numpy(np.int64)] = np.minimum(63, 1 + np.log2(counts["n"].to_numpy(np.float64)) * 1.5).astype(np.uint8)
    return out


def _prefix(n, num: int, den: int):
    return n - (num * n + den - 1) // den + 1


def _sorted_sets(line: np.ndarray, rarity: np.ndarray, h: np.ndarray):
    """Order words by (line, rarity, hash) and drop repeats in a line."""
    if line[-1] < 1 << 18:
        key = line.astype(np.uint64) << np.uint64(46) | rarity.astype(np.uint64) << np.uint64(40) | h >> np.uint64(24)
        order = np.argsort(key)
    else:
        order = np.lexsort((h, rarity, line))
    line, h = line[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (line[1:] != line[:-1]) | (h[1:] != h[:-1])
    return line[new], h[new]


def _lines(shared, num: int, den: int):
    one = np.uint64(1)

    def run(batches):
        import pyarrow as pa

        rarity = shared.value
        for b in batches:
            texts = b.column("text").to_pylist()
            ids = b.column("doc_id")
            rids = b.column("rid").to_numpy()
            for lo, hi in slices(texts):
                t = Tokens(texts[lo:hi])
                if not len(t):
                    continue
                ends = np.flatnonzero(t.bytes == 10)
                line = np.searchsorted(ends, t.start)
                h = t.hashes()
                line, h = _sorted_sets(line, rarity[(h >> _TOP).astype(np.int64)], h)
                heads = np.flatnonzero(np.r_[True, line[1:] != line[:-1]])
                which = line[heads]
                n = np.diff(np.append(heads, len(h)))
                text = np.searchsorted(t.begin, np.concatenate([[0], ends + 1])[which], side="right") - 1
                first = np.searchsorted(ends, t.begin[:-1])  # the number of each text's first line
                low = (h & one).astype(bool)
                bits = one << ((h >> one) & np.uint64(63))
                size = _prefix(n, num, den)
                offsets = np.concatenate([[0], np.cumsum(size)])
                at = np.repeat(heads - offsets[:-1], size) + np.arange(offsets[-1])
                short = (h >> np.uint64(32)).astype(np.uint32).view(np.int32)
                doc = ids.take(pa.array(lo + text))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (
                    np.add.reduceat(mix(h), heads).view(np.int64), n.astype(np.int32),
                    np.bitwise_xor.reduceat(np.where(low, bits, np.uint64(0)), heads).view(np.int64),
                    np.bitwise_xor.reduceat(np.where(low, np.uint64(0), bits), heads).view(np.int64),
                    *[np.minimum.reduceat(mix(h ^ np.uint64(0x9E3779B97F4A7C15 * (i + 1) % 2**64)), heads).view(np.int64) for i in range(MINHASHES)])] + [
                    doc.is_null(), doc, pa.array(rids[lo + text]), pa.array((which - first[text]).astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(short[at]))],
                    ["key", "n", "bm1", "bm2", "m0", "m1", "m2", "nul", "doc_id", "rid", "line", "prefix"])

    return run


def _verified(docs: DataFrame, pairs: DataFrame, num: int, den: int, what: str) -> DataFrame:
    """The keys of ``pairs`` (key, rid, line and the earlier key_0, rid_0,
    line_0) whose similarity is really at least num/den.

    One earlier match settles a line, so each line looks at its earliest
    candidate first, then, if that was none, at the next ``SOME``, and only
    what is still open at all others: the pairs that are verified stay in
    proportion to the lines, not to the squares of groups.  The texts are read
    once, for the words of all lines in ``pairs``."""
    sets = _words(docs, _ends(pairs), what)
    found, left = None, pairs
    for k in (1, SOME, None):
        if k is None:
            now = left
        else:
            turn = F.row_number().over(Window.partitionBy("key").orderBy("key_0"))
            now = staged(left.withColumn("turn", turn).where(F.col("turn") <= k).drop("turn"), what + "-now")
        hit = _matching(sets, now, num, den, what)
        found = hit if found is None else found.union(hit)
        if k is not None:
            left = staged(left.join(small(hit), "key", "left_anti").join(now.select("key", "key_0"), ["key", "key_0"], "left_anti"), what + "-left")
            if left.isEmpty():
                break
    return found


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select("rid", "line").union(pairs.select("rid_0", "line_0")).distinct()


def _words(docs: DataFrame, ends: DataFrame, what: str) -> DataFrame:
    """(rid, line, w) of the lines ``ends`` (rid, line): w has each word once."""
    wanted = staged(ends.groupBy("rid").agg(F.collect_set("line").alias("lines")), what + "-wanted")
    # the lines of a text are split once and only the wanted ones go on
    chosen = F.flatten(F.transform(F.array(F.split("text", "\n")), lambda x: F.transform("lines", lambda i: F.struct(i.alias("line"), F.get(x, i).alias("x")))))
    sets = docs.join(small(wanted), "rid").select("rid", F.inline(chosen))
    # repeated rows of a document have the same lines
    sets = sets.groupBy("rid", "line").agg(F.first("x").alias("x"))
    toks = F.array_distinct(F.filter(F.split("x", r"[\x20\x09-\x0D]+"), lambda x: x != ""))
    return staged(sets.select("rid", "line", toks.alias("w")), what + "-words")


def _matching(sets: DataFrame, pairs: DataFrame, num: int, den: int, what: str) -> DataFrame:
    sets = sets.join(small(staged(_ends(pairs), what + "-ends")), ["rid", "line"], "left_semi")
    both = pairs.join(sets, ["rid", "line"]).join(sets.select(F.col("rid").alias("rid_0"), F.col("line").alias("line_0"), F.col("w").alias("w_0")), ["rid_0", "line_0"])
    return staged(both.where(_alike("w", "w_0", num, den)).select("key").distinct(), what)


def _alike(w: str, w_0: str, num: int, den: int):
    return F.size(F.array_intersect(w, w_0)) * (num + den) >= num * (F.size(w) + F.size(w_0))


def _similar(a: str, b: str, num: int, den: int):
    """Length filter, and the symmetric difference (at least the bits in
    which the bitmaps differ) at most (den - num) / (den + num) of both
    lengths together."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    apart = sum((F.bit_count(F.col(f"{a}.{m}").bitwiseXOR(F.col(f"{b}.{m}"))) for m in ("bm1", "bm2")), F.lit(0))
    return (F.greatest(na, nb) * num <= F.least(na, nb) * den) & ((na + nb) * (den - num) >= apart * (num + den))


def _searched(docs: DataFrame, firsts: DataFrame, still: DataFrame, num: int, den: int, what: str) -> DataFrame:
    """The keys of ``still`` (key, tok) that share this first word with an
    earlier line and whose similarity is at least num/den: a semi join, which
    looks for one match and keeps no pairs."""
    post = ["key", "n", "bm1", "bm2", "rid", "line", F.posexplode("prefix").alias("pos", "tok")]
    probes = staged(firsts.join(small(still), "key", "left_semi").select(*post).join(small(still), ["key", "tok"], "left_semi"), what + "-probes")
    lists = staged(firsts.select(*post).join(small(staged(probes.select("tok").distinct(), what + "-toks")), "tok", "left_semi"), what + "-lists")
    sets = _words(docs, lists.select("rid", "line").distinct(), what)
    p, i = (x.join(sets, ["rid", "line"]).drop("rid", "line") for x in (probes, lists))
    left = F.least(F.col("p.n") - F.col("p.pos"), F.col("i.n") - F.col("i.pos"))
    meets = (F.col("p.tok") == F.col("i.tok")) & (F.col("i.key") < F.col("p.key")) & (left * (num + den) >= (F.col("p.n") + F.col("i.n")) * num)
    hit = p.alias("p").join(i.alias("i"), meets & _similar("p", "i", num, den) & _alike("p.w", "i.w", num, den), "left_semi")
    return staged(hit.select("key").distinct(), what)


def _packed(buckets: int):
    """The postings (word, line, place of the word in the line's order) of a
    run of lines, dealt by word: one row per bucket, its columns as bytes."""
    def row(held):
        import pyarrow as pa

        held = {c: np.concatenate([x[c] for x in held]).astype(t, copy=False) for c, t in POSTING.items()}
        bucket = held["tok"] % np.uint32(buckets)
        order = np.argsort(bucket, kind="stable")
        there, heads = np.unique(bucket[order], return_index=True)
        ends = np.append(heads, len(order))[1:]
        out = [pa.array(there.astype(np.int32))]
        for c in POSTING:
            x = held[c][order]
            out.append(pa.array([x[a:z].tobytes() for a, z in zip(heads.tolist(), ends.tolist())], pa.binary()))
        return pa.RecordBatch.from_arrays(out, ["bucket", *POSTING])

    def run(batches):
        held, size = [], 0
        for b in batches:
            many = b.column("prefix").value_lengths().to_numpy().astype(np.int64)
            tok = b.column("prefix").flatten().to_numpy()
            x = {c: np.repeat(b.column(c).to_numpy(), many) for c in ("n", "key", "bm1", "bm2")}
            held.append(x | {"tok": tok.view(np.uint32), "pos": np.arange(len(tok)) - np.repeat(np.cumsum(many) - many, many)})
            size += len(tok)
            if size >= PACK:
                yield row(held)
                held, size = [], 0
        if size:
            yield row(held)

    return run


def _earliest(x: np.ndarray, y: np.ndarray, few: int):
    """Pairs without repeats, of each x those with its ``few`` smallest y; and
    where x was in more pairs."""
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    x, y = x[new], y[new]
    _, heads, many = np.unique(x, return_index=True, return_counts=True)
    first = np.arange(len(x)) - np.repeat(heads, many) < few
    return x[first], y[first], np.repeat(many > few, many)[first]


def _shared(num: int, den: int, hot: int, few: int | None = None):
    """Pairs of lines that share a word of a bucket and may be similar: of
    each open line (key) the ``few`` earliest before it (key_0); None: all
    pairs.  The postings (key, tok) of open lines with more pairs come too, and
    those of words with more than ``hot`` postings, which are not compared.

    Of two lines the shorter one has a common word in its index prefix, the
    longer one in its whole prefix.  So, by word and length, each posting of
    an index prefix meets those that follow it, as far as the length filter
    reaches; a settled line meets open ones only."""
    def run(table):
        import pyarrow as pa

        p = {c: np.frombuffer(b"".join(table.column(c).to_pylist()), t) for c, t in POSTING.items()}
        at = p["tok"].astype(np.uint64) << np.uint64(32) | np.abs(p["n"]).astype(np.uint64)
        order = np.argsort(at)
        at, p = at[order], {c: x[order] for c, x in p.items()}
        n, key, bm1, bm2, unsettled = np.abs(p["n"]).astype(np.int64), p["key"], p["bm1"], p["bm2"], p["n"] > 0
        rest = n - p["pos"]
        heads = np.flatnonzero(np.r_[True, p["tok"][1:] != p["tok"][:-1]])
        many = np.diff(np.append(heads, len(at)))
        large = np.repeat(many > hot, many)
        reach = np.searchsorted(at, (at >> np.uint64(32) << np.uint64(32)) + (n * den // num).astype(np.uint64), side="right")
        index = (p["pos"] < _prefix(n, 2 * num, num + den)) & ~large
        opens = np.flatnonzero(unsettled)
        a, b = np.flatnonzero(index & unsettled), np.flatnonzero(index & ~unsettled)
        x, y = key[:0], key[:0]
        found, held = [], 0
        for i, lo, hi, ranks in ((a, a + 1, reach[a], None), (b, np.searchsorted(opens, b), np.searchsorted(opens, reach[b]), opens)):
            sums = np.concatenate([[0], np.cumsum(hi - lo)])
            cuts = np.unique(np.append(np.searchsorted(sums, np.arange(0, sums[-1], BLOCK)), len(i)))
            for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                k = np.repeat(i[s:e], hi[s:e] - lo[s:e])
                j = np.repeat(lo[s:e] - sums[s:e], hi[s:e] - lo[s:e]) + np.arange(sums[s], sums[e])
                j = j if ranks is None else ranks[j]
                both = n[k] + n[j]
                ok = np.minimum(rest[k], rest[j]) * (num + den) >= both * num
                k, j, both = k[ok], j[ok], both[ok]
                apart = np.bitwise_count(bm1[k] ^ bm1[j]).astype(np.int64) + np.bitwise_count(bm2[k] ^ bm2[j])
                ok = (both * (den - num) >= apart * (num + den)) & (key[k] != key[j])
                if few is not None:  # the later line is open
                    ok &= np.where(key[k] > key[j], unsettled[k], unsettled[j])
                k, j = key[k[ok]], key[j[ok]]
                found.append((np.maximum(k, j), np.minimum(k, j)))
                held += len(k)
                if few is not None and held >= BLOCK:  # one more than few tells that there are more
                    x, y, _ = _earliest(*map(np.concatenate, zip((x, y), *found)), few + 1)
                    found, held = [], 0
        x, y = map(np.concatenate, zip((x, y), *found))
        left = large & unsettled
        if few is not None:
            x, y, more = _earliest(x, y, few)
            left |= unsettled & np.isin(key, x[more])
        toks = p["tok"][left].view(np.int32)
        return pa.table([pa.array(np.concatenate([x, key[left]])), pa.concat_arrays([pa.array(y), pa.nulls(len(toks), pa.int64())]),
                         pa.concat_arrays([pa.nulls(len(x), pa.int32()), pa.array(toks)])], ["key", "key_0", "tok"])

    return run


def kept_lines(docs: DataFrame, num: int = NUM, den: int = DEN, crowd: int = CROWD, hot: int = HOT, few: int = FEW) -> DataFrame:
    """(rid, line) of the lines with words that stay; docs: doc_id, rid, text."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(frequency_classes(docs.select("text")))  # BUCKETS bytes
    lines = docs.select("doc_id", "rid", "text").mapInArrow(_lines(shared, num, den), ROW)
    sets, rest = ["key", "n", "bm1", "bm2"], ["nul", "doc_id", "rid", "line", "m0", "m1", "m2", "prefix"]
    firsts = lines.groupBy(*sets).agg(F.min(F.struct(*rest)).alias("s")).select("n", "bm1", "bm2", *[f"s.{c}" for c in rest])
    # place in the corpus: by doc_id, nulls last, then by row and line; from here on a line's key grows with it
    firsts = firsts.withColumn("d", F.coalesce("doc_id", F.lit(2**63 - 1))).drop("nul", "doc_id").orderBy("d", "rid", "line")
    firsts = staged(firsts.withColumn("key", F.monotonically_increasing_id()).drop("d"), "lines-first")
    here = ["n", "bm1", "bm2", "rid", "line"]

    # in a crowd that shares a min-hash, the first line is tried for all others
    bands = firsts.select("key", *here, F.posexplode(F.array("m0", "m1", "m2")).alias("slot", "m"))
    crowds = bands.groupBy("slot", "m").agg(F.min("key").alias("head"), F.count("*").alias("size")).where(F.col("size") > crowd)
    crowds = staged(crowds.select("slot", "m", "head"), "lines-crowds")
    heads = firsts.select(F.col("key").alias("head"), F.struct("key", *here).alias("i")).join(small(staged(crowds.select("head").distinct(), "lines-heads")), "head")
    crowds = staged(crowds.join(heads, "head").select("slot", "m", "i"), "lines-tries")
    tried = bands.alias("p").join(small(crowds), ["slot", "m"])
    tried = tried.where((F.col("i.key") < F.col("p.key")) & _similar("p", "i", num, den))
    tried = tried.select("p.key", "p.rid", "p.line", F.col("i.key").alias("key_0"), F.col("i.rid").alias("rid_0"), F.col("i.line").alias("line_0")).distinct()
    settled = _verified(docs, staged(tried, "lines-tried"), num, den, "lines-settled")

    # all others probe the prefix index; a settled line has its length negated,
    # it is only met as the earlier one
    gone = small(settled.withColumn("gone", F.lit(True)))
    listed = firsts.join(gone, "key", "left").withColumn("n", F.when(F.col("gone"), -F.col("n")).otherwise(F.col("n")))
    packed = listed.select("key", "n", "bm1", "bm2", "prefix").mapInArrow(_packed(1 + firsts.count() // LINES), PACKED)
    found = staged(packed.groupBy("bucket").applyInArrow(_shared(num, den, hot, few), SHARED), "lines-shared")
    pairs = staged(found.where("key_0 is not null").select("key", "key_0").distinct(), "lines-candidates")
    ends = staged(pairs.select("key").union(pairs.select("key_0")).distinct(), "lines-ends")
    place = staged(firsts.select("key", "rid", "line").join(small(ends), "key"), "lines-places")
    pairs = pairs.join(place, "key").join(place.select(*[F.col(c).alias(f"{c}_0") for c in ("key", "rid", "line")]), "key_0")
    also = _verified(docs, staged(pairs, "lines-pairs"), num, den, "lines-also")
    done = staged(settled.union(also), "lines-done")

    still = staged(found.where("key_0 is null").select("key", "tok").join(small(done), "key", "left_anti"), "lines-still")
    if not still.isEmpty():
        done = staged(done.union(_searched(docs, firsts, still, num, den, "lines-searched")), "lines-gone")
    return firsts.join(small(done), "key", "left_anti").select("rid", "line")


def _strip(texts, kept):
    out, n_lines, n_removed = [], [], []
    for t, k in zip(texts, kept):
        if t is None:
            out.append(None), n_lines.append(0), n_removed.append(0)
            continue
        stay = set(k or ())
        lines = t.split("\n")
        full = [bool(x.strip(" \t\n\v\f\r")) for x in lines]
        left = [x for i, x in enumerate(lines) if not full[i] or i in stay]
        out.append("\n".join(left)), n_lines.append(sum(full)), n_removed.append(len(lines) - len(left))
    return out, n_lines, n_removed


def deduplicated(docs: DataFrame, num: int = NUM, den: int = DEN) -> DataFrame:
    """The columns of ``docs`` (text without the removed lines) and
    dedup_lines, dedup_removed: lines with words, and how many went."""
    rows, at = plain(docs, doc_id="long", text="string")
    rows = rows.withColumn("rid", row_key(at["doc_id"], at["text"]))
    kept = kept_lines(rows.select("rid", F.col(at["doc_id"]).alias("doc_id"), F.col(at["text"]).alias("text")), num, den)
    kept = staged(kept.groupBy("rid").agg(F.collect_list("line").alias("kept")), "lines-kept")  # the lines of one document
    out = appended(rows.join(small(kept), "rid", "left"), [at["text"], "kept"], _strip, {"left": "string", "dedup_lines": "bigint", "dedup_removed": "bigint"}, (at["text"], "kept"))
    return restored(out, docs.columns, "dedup_lines", "dedup_removed", text=F.col("left"))


def without_repeats(docs: DataFrame, **options) -> DataFrame:
    """The documents with their remaining lines; a document all of whose
    lines were repeats goes; columns as given."""
    return deduplicated(docs, **options).where("dedup_lines > dedup_removed or dedup_lines = 0").drop("dedup_lines", "dedup_removed")
