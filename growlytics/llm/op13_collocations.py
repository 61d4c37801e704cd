"""Collocations per language by top-order marginalisation.

1. Each text is lower-cased (A-Z) and split into pieces and words.  Every word
   occurrence leads one window: itself and the next words of its piece, up to
   ``ORDER`` in all, padded at the piece's end.  Only these longest windows
   are counted; words stand in them as 64-bit hashes (0 is padding).  A task
   counts the windows of a slice of texts before anything is shuffled.
2. Equal windows meet, sorted by their words, and are summed in one pass.  A
   window below ``least`` can be no candidate; what it still owes are the
   counts of its prefixes, so it goes on as the longest prefix that can reach
   ``least`` (its first pair, or its first word), padded.  That loses no count
   and leaves few rows.
3. ``ROLLUP`` over the window's columns sums successively shorter prefixes: a
   phrase of k words occurs exactly where it leads a window, so its count is
   that of its k-word prefix, and the total of a language is its number of
   words.  There is no n-gram explosion per length.
4. Cuts are scored in exact decimals, contained phrases dropped by the highest
   count among the phrases around them, and only the rows that can be among
   the first ``top`` of their language get their words back, by one more pass
   over the texts that keeps the distinct words wanted.

Skew: windows are dealt by language and first word.  A word that leads more
than 1 / ``PARTS`` of the windows of a sample of rows is split by second
words, and a pair that does is split by third words, so that no part is
expected to hold more; the sample decides only where rows are summed, never
what is counted.  At most ``PARTS`` words, and as many pairs, can be that
frequent: that bounds the tables sent to the tasks.

Hashes: words of one language are told apart by 64 bits; among 10^8 distinct
words two fall together with probability 3e-4.

Defined cases: null text is empty, null lang is ``und`` (one language with a
lang that is written so); rows are documents, repeated ones count each; texts
without a word and empty tables give no rows; ties in score and count go by
the phrase's UTF-8 bytes; extra columns do no harm."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from growlytics.llm.common import by_value, flags, hashed, mix, pick, slices, small, staged

by_value(__name__)
ORDER, LEAST, TOP, PARTS, CHARS, ROWS = 3, 10, 2000, 1 << 14, 1 << 22, 1 << 18
SAMPLE = 1 / 64
_BREAK, _GAP = flags(b".,;:!?\n\x0b\x0c\r"), flags(b" \t")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
WINDOWS = "lid long, w1 long, w2 long, w3 long, part int, c long"


def _words(texts):
    """The words of a slice: bytes, ranges, hashes (never 0), the piece and
    the text of each."""
    parts = [t.encode("utf-8", "replace") if t else b"" for t in texts]
    data = _LOWER[np.frombuffer(b"\n".join([*parts, b""]), np.uint8)]
    stops = _BREAK[data]
    inside = ~(stops | _GAP[data])
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    start, end = edge[::2], edge[1::2]
    h = hashed(data, start, end)
    h[h == 0] = 1
    size = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    text = np.searchsorted(np.cumsum(size), start, side="right")
    return data, start, end, h, np.cumsum(stops)[start] if len(start) else start, text


def _lead(h: np.ndarray, piece: np.ndarray, k: int) -> np.ndarray:
    """The k-th next word of the same piece, else padding."""
    out = np.zeros(len(h), np.uint64)
    if len(h) > k:
        out[:-k] = np.where(piece[k:] == piece[:-k], h[k:], np.uint64(0))
    return out


def _counted(lid: np.ndarray, w: list[np.ndarray]):
    """Distinct windows and their counts."""
    key = lid.copy()
    for x in w:
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + x)
    order = np.argsort(key, kind="stable")
    cols = [x[order] for x in (lid, *w)]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for x in cols:
        new[1:] |= x[1:] != x[:-1]
    at = np.flatnonzero(new)
    cols = [x[at] for x in cols]
    c = np.diff(np.append(at, len(order)))
    order = np.lexsort(cols[::-1])
    return [x[order] for x in cols], c[order]


def _named(*words) -> np.ndarray:
    """A hash of a language's word or pair."""
    out = mix(words[0])
    for w in words[1:]:
        out = mix(out + w)
    return out


def _parts(heavy, lid, w1, w2, w3) -> np.ndarray:
    """Which part of its first word a window goes to: 0 if the word is not
    split, above 0 by second words, below 0 by third words too."""
    part = np.zeros(len(w1), np.int32)
    for sign, names, splits, name, by in ((1, *heavy[0], (lid, w1), w2), (-1, *heavy[1], (lid, w1, w2), w2 + mix(w3))):
        if len(names):
            x = _named(*name)
            at = np.minimum(np.searchsorted(names, x), len(names) - 1)
            part = np.where(names[at] == x, sign * (1 + (mix(by + np.uint64(1)) % splits[at]).astype(np.int32)), part)
    return part.astype(np.int32)


def _windows(heavy):
    """Counted windows of slices of texts."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            texts = b.column("text").to_pylist()
            lids = b.column("lid").to_numpy(zero_copy_only=False).view(np.uint64)
            for lo, hi in slices(texts, CHARS):
                _, _, _, h, piece, text = _words(texts[lo:hi])
                if not len(h):
                    continue
                cols, c = _counted(lids[lo:hi][text], [h, _lead(h, piece, 1), _lead(h, piece, 2)])
                yield pa.RecordBatch.from_arrays([*[pa.array(x.view(np.int64)) for x in cols], pa.array(_parts(heavy, *cols)), pa.array(c.astype(np.int64))],
                                                 ["lid", "w1", "w2", "w3", "part", "c"])

    return run


_NOTHING = (np.empty(0, np.uint64), np.empty(0, np.uint64))


def _heavy(rows: DataFrame):
    """First words and pairs that lead more than 1 / PARTS of the windows of a
    sample, and into how many parts they are split."""
    got = rows.sample(False, SAMPLE, 7).mapInArrow(_windows((_NOTHING, _NOTHING)), WINDOWS)
    got = staged(got.groupBy("lid", "w1", "w2").agg(F.sum("c").alias("c")), "phrases-sample")
    total = got.agg(F.sum("c")).first()[0] or 0
    out = []
    for names in (["lid", "w1"], ["lid", "w1", "w2"]):
        top = got.groupBy(*names).agg(F.sum("c").alias("c")).where(F.col("c") * PARTS > total).toPandas()  # fewer than PARTS rows
        x = _named(*[top[n].to_numpy(np.int64).view(np.uint64) for n in names])
        order = np.argsort(x)
        out.append((x[order], np.ceil(top["c"].to_numpy(np.float64) * PARTS / max(total, 1)).astype(np.uint64)[order]))
    return tuple(out)


_SORTED = ["w1", "lid", "part", "w2", "w3"]


def _collapsed(least: int):
    """Sorted windows to summed ones: those of at least ``least``, and the
    rest as padded prefixes."""
    def cut(cols, c):
        w1, lid, part, w2, w3 = cols
        change = np.zeros(len(c), bool)
        change[:1] = True
        for x in (w1, lid):
            change[1:] |= x[1:] != x[:-1]
        word = change.copy()
        for x in (part, w2):
            change[1:] |= x[1:] != x[:-1]
        pair = change.copy()
        change[1:] |= w3[1:] != w3[:-1]
        at = np.flatnonzero(change)
        n = np.add.reduceat(c, at)
        often = (n >= least) & (w3[at] != 0)
        heads = np.flatnonzero(pair[at])
        rest, every = np.add.reduceat(np.where(often, 0, n), heads), np.add.reduceat(n, heads)
        head = at[heads]
        stay = ((every >= least) | (part[head] < 0)) & (rest > 0)
        yield lid[at[often]], w1[at[often]], w2[at[often]], w3[at[often]], n[often]
        yield lid[head[stay]], w1[head[stay]], w2[head[stay]], np.zeros(stay.sum(), np.int64), rest[stay]
        firsts = np.flatnonzero(word[head])
        short = np.add.reduceat(np.where(stay, 0, rest), firsts)
        first, some = head[firsts], short > 0
        none = np.zeros(some.sum(), np.int64)
        yield lid[first[some]], w1[first[some]], none, none, short[some]

    def run(batches):
        import pyarrow as pa

        held, size = [], 0

        def flush(final: bool):
            nonlocal held, size
            table = pa.Table.from_batches(held)
            cols, c = [table.column(n).to_numpy() for n in _SORTED], table.column("c").to_numpy()
            stop = len(c)
            if not final:  # the last pair may go on
                same = np.ones(len(c), bool)
                for x in cols[:4]:
                    same &= x == x[-1]
                stop = len(c) - int(np.argmin(same[::-1])) if not same.all() else 0
            held = table.slice(stop).combine_chunks().to_batches()
            size = len(c) - stop
            if stop:
                for out in cut([x[:stop] for x in cols], c[:stop]):
                    if len(out[0]):
                        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x, np.int64)) for x in out], ["lid", "w1", "w2", "w3", "c"])

        for b in batches:
            if b.num_rows:
                held.append(b)
                size += b.num_rows
            if size >= ROWS and len(held) > 1:
                yield from flush(False)
        if size:
            yield from flush(True)

    return run


def counts(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lid, w1, w2, w3, k, f): every phrase of k words (the others are 0)
    that occurs at least ``least`` times; k = 0: the words of the language.
    And (lid, lang)."""
    rows = pick(docs, text="string", lang="string").withColumn("lang", F.coalesce("lang", F.lit("und")))
    langs = rows.select("lang").distinct().select(F.xxhash64("lang").alias("lid"), "lang")
    rows = rows.select(F.xxhash64("lang").alias("lid"), "text")
    found = rows.mapInArrow(_windows(_heavy(rows)), WINDOWS).repartition("lid", "w1", "part").sortWithinPartitions(*_SORTED)
    leading = found.mapInArrow(_collapsed(least), "lid long, w1 long, w2 long, w3 long, c long")
    cube = leading.rollup("lid", "w1", "w2", "w3").agg(F.sum("c").alias("f"), F.grouping_id().alias("g"))
    k = F.when(F.col("g") == 0, 3).when(F.col("g") == 1, 2).when(F.col("g") == 3, 1).when(F.col("g") == 7, 0)
    w = [F.coalesce(f"w{i}", F.lit(0)).alias(f"w{i}") for i in (1, 2, 3)]
    cube = cube.select("lid", *w, k.alias("k"), "f").where("k is not null")
    # a row that ends in padding is a shorter phrase, which has its own row
    # (a condition on the grouping alone, which filters before the sums)
    padding = F.when(F.col("k") == 3, F.col("w3") == 0).when(F.col("k") == 2, F.col("w2") == 0).otherwise(F.lit(False))
    cube = cube.where(~padding).where(F.when(F.col("k") == 0, F.lit(True)).otherwise(F.col("f") >= least))
    return staged(cube, "phrases-counts"), staged(langs, "phrases-langs")


def _spelled(wanted: str):
    """The distinct words of each slice: lid, hash, word."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            texts = b.column("text").to_pylist()
            lids = b.column("lid").to_numpy(zero_copy_only=False).view(np.uint64)
            for lo, hi in slices(texts, CHARS):
                data, start, end, h, _, text = _words(texts[lo:hi])
                lid = lids[lo:hi][text]
                _, at = np.unique(mix(h + mix(lid)), return_index=True)
                raw = data.tobytes()
                word = [raw[x:y] for x, y in zip(start[at].tolist(), end[at].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(lid[at].view(np.int64)), pa.array(h[at].view(np.int64)), pa.array(word, pa.binary())], ["lid", wanted, "word"])

    return run


def scored(f: DataFrame) -> DataFrame:
    """The candidates of a table of counts with a, l, r, score of their
    lowest-scoring cut; contained ones are dropped by :func:`kept`."""
    def part(n: int, *names: str) -> DataFrame:
        cols = [F.col(f"w{i}").alias(x) for i, x in enumerate(names[:-1], 1)]
        return small(f).where(F.col("k") == n).select("lid", *cols, F.col("f").alias(names[-1]))

    two = f.where("k = 2").select("lid", "w1", "w2", "w3", "k", F.col("f").alias("a"))
    two = two.join(part(1, "w1", "l1"), ["lid", "w1"]).join(part(1, "w2", "r1"), ["lid", "w2"])
    three = f.where("k = 3").select("lid", "w1", "w2", "w3", "k", F.col("f").alias("a"))
    three = (three.join(part(1, "w1", "l1"), ["lid", "w1"]).join(part(2, "w2", "w3", "r1"), ["lid", "w2", "w3"])
             .join(part(2, "w1", "w2", "l2"), ["lid", "w1", "w2"]).join(part(1, "w3", "r2"), ["lid", "w3"]))
    both = two.unionByName(three, allowMissingColumns=True)
    big = [F.col(x).cast("decimal(16,0)").alias(x) for x in ("a", "l1", "r1", "l2", "r2")]
    both = both.select("lid", "w1", "w2", "w3", "k", *big)
    cut = [F.when(F.col(f"l{i}").isNotNull(), F.struct(F.expr(f"(a * a * 1000000BD) div (l{i} * r{i})").alias("score"), F.lit(i).alias("cut"),
                                                       F.col(f"l{i}").cast("long").alias("l"), F.col(f"r{i}").cast("long").alias("r"))) for i in (1, 2)]
    low = F.least(*cut)
    return both.select("lid", "w1", "w2", "w3", "k", F.col("a").cast("long").alias("a"), low["l"].alias("l"), low["r"].alias("r"), low["score"].cast("long").alias("score"))


def kept(rows: DataFrame, f: DataFrame, share: int = 50) -> DataFrame:
    """Without the phrases that lie in a longer one with at least ``share``
    percent of their count."""
    longer = f.where("k = 3")
    inside = longer.select("lid", "w1", "w2", "f").unionByName(longer.select("lid", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "f"))
    inside = inside.groupBy("lid", "w1", "w2").agg(F.max("f").alias("around")).withColumn("k", F.lit(2))
    out = rows.join(inside, ["lid", "w1", "w2", "k"], "left")
    return out.where(F.col("around").isNull() | (F.col("around").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * share)).drop("around")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, share: int = 50) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of
    each language."""
    f, langs = counts(docs, least)
    # all rows that tie with the last place stay, until the words are known;
    # ranked in parts of a language first, so that no task meets all its rows
    best = kept(scored(f), f, share).withColumn("part", F.pmod(F.xxhash64("w1", "w2", "w3"), F.lit(64)))
    for names in (["lid", "part"], ["lid"]):
        place = Window.partitionBy(*names).orderBy(F.desc("score"), F.desc("a"))
        best = best.withColumn("at", F.rank().over(place)).where(F.col("at") <= top).drop("at")
    best = best.drop("part")
    best = staged(best, "phrases-best")
    wanted = best.select("lid", F.explode(F.array("w1", "w2", "w3")).alias("h")).where("h <> 0").distinct()
    rows = pick(docs, text="string", lang="string").select(F.xxhash64(F.coalesce("lang", F.lit("und"))).alias("lid"), "text")
    words = rows.mapInArrow(_spelled("h"), "lid long, h long, word binary").join(small(staged(wanted, "phrases-wanted")), ["lid", "h"])
    words = staged(words.groupBy("lid", "h").agg(F.min(F.col("word").cast("string")).alias("word")), "phrases-words")
    for i in (1, 2, 3):
        best = best.join(small(words).select("lid", F.col("h").alias(f"w{i}"), F.col("word").alias(f"x{i}")), ["lid", f"w{i}"], "left")
    best = best.withColumn("phrase", F.concat_ws(" ", "x1", "x2", "x3"))
    n = small(f).where("k = 0").select("lid", F.col("f").alias("n"))
    best = best.join(n, "lid").join(small(langs), "lid")
    rank = F.row_number().over(Window.partitionBy("lid").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    out = best.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
