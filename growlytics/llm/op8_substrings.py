"""Substring deduplication with a compressed FM-index per shard.

A window is ``window`` consecutive words of one document.  A word goes when a
window over it also starts in a document with a smaller doc_id.

1. Anchors: in each window the 5-word run with the smallest hash.  Equal
   windows have equal anchors, so a window can only repeat where its anchor
   stands in several documents; anchors (about one in five words) are counted
   with partial minima and maxima of doc_id, not collected.
2. Consecutive windows with one repeated anchor are cut out as a piece.  Equal
   pieces collapse to one with the smallest doc_id (a passage of thousands of
   documents is one piece), and are dealt to shards by anchor; an anchor whose
   distinct pieces exceed a shard's share is dealt by whole windows instead.
3. Each shard builds an FM-index of its pieces: suffix array by prefix
   doubling, Burrows-Wheeler transform in a wavelet matrix of packed bits.
   The pieces stream through backward search, all at once, word by word; the
   length of the current match is the matching statistic (up to the
   threshold), and where it reaches the window, the suffix interval gives the
   smallest doc_id of all occurrences.
4. The windows found go back to their documents.

Defined cases: null or blank texts have no words (kept text ''); texts
shorter than the window lose nothing; a null doc_id is larger than all
others, and rows with equal doc_id do not remove each other's words; repeated
rows get the same result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growlytics.llm.common import Tokens, appended, by_value, mix, pick, rolled, row_key, slices, small, staged, words

by_value(__name__)
WINDOW, GRAM, SHARD_WORDS = 13, 5, 1 << 19


#: The bits below bit i of a 64-bit word.
_BELOW = (np.uint64(1) << np.arange(64, dtype=np.uint64)) - np.uint64(1)


def _suffixes(text: np.ndarray, sigma: int) -> np.ndarray:
    """The suffix array of codes below ``sigma`` (an end sorts before all
    codes): suffixes are sorted by as many codes as fit one integer, then
    those that are still alike by twice as many, until none are."""
    n, bits = len(text), int(sigma).bit_length()
    step = min(max(1, 63 // bits), max(1, n))
    padded = np.concatenate([text.astype(np.int64) + 1, np.zeros(step, np.int64)])
    key = np.zeros(n, np.int64)
    for j in range(step):
        key <<= bits
        key |= padded[j:j + n]
    sa, rank, alike = np.argsort(key), np.zeros(n + 1, np.int64), np.arange(n)
    rank[n] = -1
    got = sa
    key = key[got]
    while True:
        # a rank is the place of the first of those alike, so others' ranks stay
        head = np.ones(len(got) + 1, bool)
        head[1:-1] = key[1:] != key[:-1]
        rank[got] = np.maximum.accumulate(np.where(head[:-1], alike, 0))
        alike = alike[~(head[:-1] & head[1:])]
        if not len(alike):
            return sa
        got = sa[alike]
        key = rank[got] * (n + 1) + rank[np.minimum(got + step, n)] + 1
        order = np.argsort(key)
        got, key = got[order], key[order]
        sa[alike] = got
        step *= 2


class FMIndex:
    """Over a sequence of codes >= 0, where 0 separates (and ends) pieces."""

    def __init__(self, text: np.ndarray, sigma: int):
        n = len(text)
        sa = _suffixes(text, sigma)
        self.sa, self.n, self.sigma, self.text = sa, n, sigma, text
        bwt = text[sa - 1]
        self.c = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])[:sigma]
        self.levels = max(1, int(sigma - 1).bit_length())
        self.bits, self.ranks, self.zeros = [], [], []
        for level in range(self.levels - 1, -1, -1):
            bit = ((bwt >> level) & 1).astype(np.uint8)
            packed = np.packbits(np.append(bit, np.zeros(64 + (-n) % 64, np.uint8)), bitorder="little").view(np.uint64)
            self.bits.append(packed)
            self.ranks.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int32)]).astype(np.int32))
            self.zeros.append(n - int(bit.sum()))
            up = bit.view(bool)
            bwt = np.concatenate([bwt[~up], bwt[up]])
        self.first = self._map(np.arange(sigma), np.zeros(sigma, np.int64))

    def _map(self, code: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Positions followed down the wavelet matrix along the codes' bits."""
        for i in range(self.levels):
            word = at >> 6
            ones = self.ranks[i][word] + np.bitwise_count(self.bits[i][word] & _BELOW[at & 63])
            up = code & (1 << (self.levels - 1 - i)) != 0
            at = np.where(up, self.zeros[i] + ones, at - ones)
        return at

    def extend(self, code: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        """One step of backward search for many intervals."""
        base = self.c[code] - self.first[code]
        return base + self._map(code, lo), base + self._map(code, hi)

    def statistics(self, query: np.ndarray, ends: np.ndarray, begins: np.ndarray, depth: int):
        """Truncated matching statistics of streamed sequences, all at once.

        Sequence i is query[begins[i]:ends[i]]; it is read from its end.  At
        each word the current match is extended by backward search; a match
        of ``depth`` words is first cut by its last word: its interval grows
        to all suffixes with the same first ``depth - 1`` words.  Returns, for
        each position, the length of the match that begins there (at most
        ``depth``) and its suffix interval."""
        n = len(query)
        lo, hi, length = np.zeros(n, np.int64), np.full(n, self.n, np.int64), np.zeros(n, np.int64)
        group, stop = self.prefixes(depth - 1)
        at = ends - 1
        a, b, got = np.zeros(len(ends), np.int64), np.full(len(ends), self.n, np.int64), np.zeros(len(ends), np.int64)
        live = np.flatnonzero(at >= begins)
        while len(live):
            long_ = live[got[live] == depth]
            g = group[a[long_]]
            a[long_], b[long_], got[long_] = stop[g], stop[g + 1], depth - 1
            x, y = self.extend(query[at[live]], a[live], b[live])
            ok = x < y
            a[live], b[live] = np.where(ok, x, 0), np.where(ok, y, self.n)
            got[live] = np.where(ok, got[live] + 1, 0)
            p = at[live]
            lo[p], hi[p], length[p] = a[live], b[live], got[live]
            at[live] -= 1
            live = live[at[live] >= begins[live]]
        return length, lo, hi

    def prefixes(self, k: int):
        """Groups of neighbouring suffixes with equal first ``k`` codes: the
        group of each rank, and where each group starts (and the last ends)."""
        padded = np.concatenate([self.text, np.zeros(k, np.int64)]).astype(np.uint64)
        h = rolled(mix(padded + np.uint64(1)), k)[:self.n][self.sa]
        new = np.concatenate([[True], h[1:] != h[:-1]])
        return np.cumsum(new) - 1, np.append(np.flatnonzero(new), self.n)


def _runs(t: Tokens, window: int):
    """The runs of consecutive windows with one anchor, over all texts of a
    slice: (text, first word, number of windows, hash of the anchor)."""
    h = t.hashes()
    g = rolled(h, GRAM)
    n = len(h) - window + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 4
    best, width = g, 1
    while width < window - GRAM + 1:  # least of ever more runs
        more = min(width, window - GRAM + 1 - width)
        best = np.minimum(best[:len(best) - more], best[more:])
        width += more
    of = t.of()
    inside = of[:n] == of[window - 1:]
    head = inside.copy()
    # the first least run moves on when it is left behind, or undercut
    head[1:] &= ~inside[:-1] | (g[:n - 1] == best[:-1]) | (best[1:] != best[:-1])
    first = np.flatnonzero(head)
    # a run ends before the next one, or where the text has no more windows
    last_window = t.offsets[of[first] + 1] - window
    stop = np.minimum(np.append(first[1:], n), last_window + 1)
    return of[first], first, stop - first, best[first].view(np.int64)


def _list_anchors(window: int):
    def run(frames):
        for f in frames:
            texts = f["text"].tolist()
            d, rid = f["d"].to_numpy(np.int64), f["rid"].to_numpy(np.int64)
            for lo, hi in slices(texts):
                of, _, _, anchor = _runs(Tokens(texts[lo:hi]), window)
                yield pd.DataFrame({"anchor": anchor, "d": d[lo + of], "rid": rid[lo + of]})

    return run


def _cut(window: int):
    def run(batches):
        import pyarrow as pa

        for b in batches:
            texts, wanted = b.column("text").to_pylist(), b.column("anchors")
            d, rid = b.column("d").to_numpy(), b.column("rid").to_numpy()
            bounds, values = wanted.offsets.to_numpy(), wanted.values.to_numpy()
            for lo, hi in slices(texts):
                t = Tokens(texts[lo:hi])
                of, first, n, anchor = _runs(t, window)
                if not len(of):
                    continue
                # (text, anchor) among the wanted ones of that text
                mine = np.repeat(np.arange(hi - lo), np.diff(bounds[lo:hi + 1]))
                pairs = np.unique(mix(values[bounds[lo]:bounds[hi]].view(np.uint64) ^ mix(mine.astype(np.uint64))))
                good = np.isin(mix(anchor.view(np.uint64) ^ mix(of.astype(np.uint64))), pairs)
                of, first, n, anchor = of[good], first[good], n[good], anchor[good]
                # the words of the slice, one blank between them
                size = t.end - t.start + 1
                place = np.concatenate([[0], np.cumsum(size)])
                plain_ = np.full(place[-1], 32, np.uint8)
                at = np.arange(place[-1]) - np.repeat(place[:-1] - t.start, size)
                inside = at < np.repeat(t.end, size)
                plain_[inside] = t.bytes[at[inside]]
                a, z = place[first], place[first + n + window - 1] - 1
                offsets = np.concatenate([[0], np.cumsum(z - a)])
                data = plain_[np.repeat(a - offsets[:-1], z - a) + np.arange(offsets[-1])]
                piece = pa.StringArray.from_buffers(len(of), pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(rid[lo + of]), pa.array(d[lo + of]), pa.array(anchor), pa.array((first - t.offsets[of]).astype(np.int32)),
                                                  pa.array(n.astype(np.int32)), piece], ["rid", "d", "route", "start", "n", "piece"])

    return run


def _recut(window: int):
    """Pieces of overfull anchors become single windows, dealt by content."""
    def run(frames):
        for f in frames:
            rows = []
            for rid, d, start, n, piece in zip(f["rid"], f["d"], f["start"], f["n"], f["piece"]):
                w = piece.split(" ")
                h = rolled(Tokens([piece]).hashes(), window).view(np.int64)
                rows += [(rid, d, int(h[k]), start + k, 1, " ".join(w[k:k + window])) for k in range(n)]
            yield pd.DataFrame(rows, columns=["rid", "d", "route", "start", "n", "piece"])

    return run


def _search(window: int):
    def run(f):
        """The smallest doc_id of each window of a shard's distinct pieces."""
        t = Tokens(f["piece"].tolist())
        codes, distinct = pd.factorize(t.hashes())
        offsets, sizes, lists = t.offsets, t.sizes(), f["piece"]
        text = np.zeros(len(codes) + len(lists) + 1, np.int64)
        at = np.arange(len(codes)) + np.repeat(np.arange(len(lists)), sizes)
        text[at] = codes + 1
        d = np.zeros(len(text), np.int64)
        d[at] = np.repeat(f["d"].to_numpy(np.int64), sizes)
        index = FMIndex(text, len(distinct) + 1)
        first = offsets[:-1] + np.arange(len(lists))
        length, lo, hi = index.statistics(text, first + sizes, first, window)
        begin = np.flatnonzero(length >= window)
        # intervals of one depth are equal or disjoint: one minimum for each
        starts, which = np.unique(lo[begin], return_inverse=True)
        stop = np.zeros(len(starts), np.int64)
        stop[which] = hi[begin]
        by_rank = np.append(d[index.sa], np.iinfo(np.int64).max)
        cuts = np.column_stack([starts, stop]).ravel()
        least = np.minimum.reduceat(by_rank, cuts)[::2] if len(cuts) else np.empty(0, np.int64)
        low = np.zeros(len(text), np.int64)
        low[begin] = least[which]
        return pd.DataFrame({"k1": f["k1"], "k2": f["k2"], "low": [low[a:a + s - window + 1] for a, s in zip(first, sizes)]})

    return run


def _strip(window: int):
    def fn(texts, found):
        n, gone, digest, kept_text = [], [], [], []
        for t, starts in zip(texts, found):
            w = left = words(t)
            if starts is not None and len(starts):
                s = np.asarray(starts, np.int64)
                cover = np.zeros(len(w) + 1, np.int64)
                cover[s] += 1  # once for equal starts
                cover[s + window] -= 1
                left = list(compress(w, (np.cumsum(cover[:-1]) <= 0).tolist()))
            kept = b" ".join(left)
            n.append(len(w)), gone.append(len(w) - len(left)), digest.append(hashlib.sha256(kept).hexdigest())
            kept_text.append(kept.decode("utf-8", "replace"))
        return n, gone, digest, kept_text

    return fn


def repeats(docs: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(rid, start) of every window that also starts in a document with a
    smaller doc_id; docs: doc_id, rid, text."""
    docs = docs.select("rid", "text", F.coalesce("doc_id", F.lit(2**63 - 1)).alias("d"))
    listed = docs.mapInPandas(_list_anchors(window), "anchor long, d long, rid long")
    again = listed.groupBy("anchor").agg(F.min("d").alias("lo"), F.max("d").alias("hi")).where("lo < hi").select("anchor")
    again = staged(again, "repeat-anchors")
    own = listed.select("rid", "anchor").join(again, "anchor").groupBy("rid").agg(F.collect_set("anchor").alias("anchors"))  # of one document
    own = staged(own, "repeat-own")
    schema = "rid long, d long, route long, start int, n int, piece string"
    # from here on a piece is known by two 64-bit hashes
    keys = [F.xxhash64("piece").alias("k1"), F.xxhash64("piece", F.lit(1)).alias("k2")]
    pieces = docs.join(own, "rid").mapInArrow(_cut(window), schema)
    pieces = staged(pieces.select("*", *keys), "repeat-pieces")

    heavy = pieces.groupBy("route", "k1", "k2").agg(F.first("n").alias("n")).groupBy("route").agg(F.sum(F.col("n") + window - 1).alias("w"))
    heavy = small(staged(heavy.where(F.col("w") > shard_words // 4).select("route"), "repeat-heavy"))
    split = staged(pieces.join(heavy, "route").select("rid", "d", "route", "start", "n", "piece").mapInPandas(_recut(window), schema).select("*", *keys), "repeat-windows")
    pieces = pieces.join(heavy, "route", "left_anti").select(*split.columns).union(split)
    distinct = staged(pieces.groupBy("route", "piece", "k1", "k2", "n").agg(F.min("d").alias("d")), "repeat-distinct")
    total = distinct.agg(F.coalesce(F.sum(F.col("n") + window - 1), F.lit(0))).first()[0]
    shards = max(1, -(-total // shard_words))
    low = distinct.select(F.pmod(F.xxhash64("route"), F.lit(shards)).alias("shard"), "piece", "k1", "k2", "d")
    low = staged(low.groupBy("shard").applyInPandas(_search(window), "k1 long, k2 long, low array<long>"), "repeat-low")
    hits = pieces.select("rid", "d", "start", "k1", "k2").join(low, ["k1", "k2"])
    starts = F.filter(F.transform("low", lambda x, i: F.when(x < F.col("d"), F.col("start") + i)), lambda x: x.isNotNull())
    return hits.select("rid", starts.alias("starts")).where("size(starts) > 0")


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept (the text that is left)
    and starts (the repeated windows) for every document."""
    rows = pick(docs, doc_id="long", text="string").withColumn("rid", row_key("doc_id", "text"))
    found = repeats(rows, **options).groupBy("rid").agg(F.array_distinct(F.flatten(F.collect_list("starts"))).alias("starts"))  # of one document
    found = staged(found, "repeat-found")
    out = appended(rows.join(found, "rid", "left"), ["text", "starts"], _strip(options.get("window", WINDOW)),
                   {"n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string", "kept": "string"}, ("text", "rid"), arrays=("starts",))
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256", "kept", "starts")
