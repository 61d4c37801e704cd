"""Benchmark decontamination by template canonicalisation.

Texts and benchmark items become sequences of template tokens: words without
case and outer punctuation, with numbers, units and names (capitalised inside
a sentence) replaced by typed placeholders.  Windows of ``window`` template
tokens are hash-joined: the items' windows are a small table that is shipped
to the tasks in parts of a checked size, whatever the number of items.  A hit
then needs consistent slots: along an alignment, the same item value must
always stand for the same document value and the reverse.  A document holds
an item if such windows, at one place of it, cover more than half of the
item's tokens; so a question with other numbers or names is caught, a text
that shares a phrase is not.  Where values differ, at least half of what is
covered must be literal words, ``TELLING`` different ones of them of four
letters or more (shorter ones are mostly function words, which any text of
the same form has); with equal values that is not asked.

Defined cases: null or empty texts hold nothing; items of fewer than
``least`` tokens are not searched for; items shorter than the window are one
window of their own length; repeated rows get the same answer; a null item_id
is reported as null; extra columns are ignored or carried along.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growlytics.llm.common import WORD, Tokens, appended, by_value, flags, hashed, pick, plain, restored, revived, rolled, shipped, slices

by_value(__name__)
WINDOW, LEAST, TELLING, PART_WORDS = 8, 5, 3, 1 << 21
NUM, UNIT, NAME = (np.uint64(i) for i in (1, 2, 3))
_NUMBERS = ("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen "
            "nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion").split()
_UNITS = ("mm cm dm km ft yd mi mg kg oz lb lbs ml cl gal sec min hr hrs ms kmh mph kw kwh hz khz mhz ghz kb mb gb tb pa bar cal "
          "kcal kj usd eur gbp dollars euros cents meters metres miles kilometers kilometres grams kilograms pounds ounces liters "
          "litres seconds minutes hours days weeks months years degrees percent").split()
_DIGIT = flags(b"0123456789")
_SMALL, _UPPER = flags(bytes(range(97, 123))), flags(bytes(range(65, 91)))
_WIDE = np.arange(256) >= 128
_ALNUM = _DIGIT | _SMALL | _UPPER | _WIDE
_STOP = flags(b".!?:|")


def _of_words(some: list[str]) -> np.ndarray:
    return np.sort(Tokens([" ".join(some)]).hashes())


def _in(sorted_: np.ndarray, x: np.ndarray) -> np.ndarray:
    return sorted_[np.minimum(np.searchsorted(sorted_, x), len(sorted_) - 1)] == x


def templates(texts: list):
    """(template codes, values, characters, offsets) of the texts' tokens.  A token is a
    word without the marks around it; number: it starts with a digit and has
    at most two letters, or is a number word."""
    t = Tokens(texts)
    data, n = t.bytes, len(t.bytes)
    # the same bytes in small letters, where the case does not change their number
    small = b"\n".join([low if len(low := x.lower().encode("utf-8", "replace")) == len(x.encode("utf-8", "replace")) else x.encode("utf-8", "replace").lower()
                        for x in (x or "" for x in texts)] + [b""])
    small = np.frombuffer(small, np.uint8)
    changed = small != data
    mark = _ALNUM[data]
    after = np.minimum.accumulate(np.where(mark, np.arange(n), n)[::-1])[::-1] if n else np.zeros(0, np.int64)
    before = np.maximum.accumulate(np.where(mark, np.arange(n), -1)) if n else np.zeros(0, np.int64)
    start, end = after[t.start], before[t.end - 1] + 1
    core = start < end  # also: the first mark is inside the word
    core &= start < t.end
    start, end = np.where(core, start, t.start), np.where(core, end, t.end)

    def within(mask):
        total = np.concatenate([[0], np.cumsum(mask)])
        return total[end] - total[start]

    h = hashed(small, start, end)
    h[h < 16] = 16
    upper = within(changed & ((data & 0xC0) != 0x80) | np.concatenate([changed[1:] & ((data[1:] & 0xC0) == 0x80), [False]]))
    first = data[start] if len(t) else np.zeros(0, np.uint8)
    letters = within(_SMALL[data] | _UPPER[data] | _WIDE[data])
    code = h.copy()
    begins = changed[start] | np.where(start + 1 < n, changed[np.minimum(start + 1, max(n - 1, 0))] & (first >= 0xC0), False) if len(t) else np.zeros(0, bool)
    name = begins & (upper == 1) & (end - start > 1)
    # a word after a line end, or after a word that ends a sentence, has a capital anyway
    stops = np.zeros(n + 1, np.int64)
    np.cumsum(_STOP[data] | (data == 10), out=stops[1:])
    if len(t):
        gap = np.concatenate([[1], stops[t.start[1:]] - stops[np.minimum(end[:-1], t.start[1:])]])
        gap[t.offsets[:-1][t.offsets[:-1] < len(t)]] = 1
        name &= (gap == 0) & (stops[start] == stops[t.start])
    code[name] = NAME
    code[_in(UNIT_HASHES, h)] = UNIT
    code[_DIGIT[first] & (letters <= 2) | _in(NUMBER_HASHES, h)] = NUM
    return code[core], h[core], within((data & 0xC0) != 0x80)[core], np.concatenate([[0], np.cumsum(core)])[t.offsets]


NUMBER_HASHES, UNIT_HASHES = _of_words(_NUMBERS), _of_words(_UNITS)


class Items:
    """The windows of some benchmark items, sorted by hash, per length."""

    def __init__(self, ids: list, texts: list, window: int = WINDOW, least: int = LEAST):
        t, v, chars, off = templates(texts)
        self.ids, self.t, self.v, self.wide, self.off = ids, t, v, chars >= 4, off
        per = defaultdict(list)
        for i in range(len(ids)):
            n = int(off[i + 1] - off[i])
            if n >= least:
                k = min(n, window)
                h = rolled(t[off[i]:off[i + 1]], k)
                per[k] += [(int(x), i, p) for p, x in enumerate(h)]
        self.per = {}
        for k, rows in per.items():
            rows.sort()
            self.per[k] = (np.array([r[0] for r in rows], np.uint64), [(r[1], r[2]) for r in rows])

    def alignments(self, t: np.ndarray, off: np.ndarray) -> dict:
        """Text -> {(item, diagonal): its equal windows}, for a slice of texts."""
        found: dict = defaultdict(lambda: defaultdict(list))
        for k, (sorted_h, at) in self.per.items():
            h = rolled(t, k)
            if not len(h) or not len(sorted_h):
                continue
            lo = np.searchsorted(sorted_h, h)
            hit = np.flatnonzero(sorted_h[np.minimum(lo, len(sorted_h) - 1)] == h)
            text = np.searchsorted(off, hit, side="right") - 1
            inside = hit + k <= off[text + 1]
            for d, i in zip(hit[inside].tolist(), text[inside].tolist()):
                j = int(lo[d])
                while j < len(at) and sorted_h[j] == h[d]:
                    item, p = at[j]
                    found[i][item, d - p].append((d, p, k))
                    j += 1
        return found

    def hits(self, diagonals: dict, t: np.ndarray, v: np.ndarray) -> dict:
        """Item id -> number of consistent windows of one text, for the items
        of which it holds enough."""
        good: dict = defaultdict(list)
        for (item, diagonal), found in diagonals.items():
            base, there, back = int(self.off[item]), {}, {}
            for d, p, k in sorted(found):
                mine, its, its_v = t[d:d + k], self.t[base + p:base + p + k], v[d:d + k]
                if not np.array_equal(mine, its):
                    continue
                item_v = self.v[base + p:base + p + k]
                slots = np.flatnonzero(mine < 16).tolist()
                pairs = [(int(item_v[s]), int(its_v[s])) for s in slots]
                same = all(a == b for a, b in pairs)
                if not same and any(there.get(a, b) != b or back.get(b, a) != a for a, b in pairs):
                    continue
                trial, rev = dict(there), dict(back)
                if not same and any(trial.setdefault(a, b) != b or rev.setdefault(b, a) != a for a, b in pairs):
                    continue
                there, back = {**there, **dict(pairs)}, {**back, **{b: a for a, b in pairs}}
                good[item].append((diagonal, p, k, same))
        out: dict = defaultdict(int)
        for item, found in good.items():
            if self.enough(item, sorted(found)):
                out[self.ids[item]] += len(found)
        return out

    def enough(self, item: int, found: list) -> bool:
        """Whether windows (diagonal, place in the item, length, equal values)
        hold most of an item at one place of a text: on diagonals less than a
        window apart, so that words may be put in or left out."""
        lo, hi = int(self.off[item]), int(self.off[item + 1])
        t, wide = self.t[lo:hi], self.wide[lo:hi]
        for first in dict.fromkeys(f[0] for f in found):
            here = [f for f in found[bisect_left(found, (first,)):] if f[0] < first + WINDOW]
            for some in ([f for f in here if f[3]], here):  # with equal values only, then all
                held = np.zeros(hi - lo, bool)
                for _, p, k, _ in some:
                    held[p:p + k] = True
                literal = held & (t >= 16)
                if 2 * held.sum() > hi - lo and (all(f[3] for f in some) or 2 * literal.sum() >= held.sum() and len(np.unique(t[literal & wide])) >= TELLING):
                    return True
        return False


def _search(shared):
    def fn(texts):
        items = revived(Items, shared)
        ids, n = [[] for _ in texts], [0] * len(texts)
        for lo, hi in slices(texts):
            t, v, _, off = templates(texts[lo:hi])
            for i, diagonals in items.alignments(t, off).items():
                got = items.hits(diagonals, t, v)
                if got:
                    ids[lo + i] = sorted(got, key=lambda x: (x is None, x or 0))
                    n[lo + i] = sum(got.values())
        return ids, n

    return fn


def flagged(docs: DataFrame, text: str, benchmark: DataFrame, window: int = WINDOW, part_words: int = PART_WORDS) -> DataFrame:
    """``docs`` (with distinct names), item_ids (array<long>) and n_windows.
    The items are shipped in parts of about ``part_words`` words; every part
    meets every document."""
    spark = docs.sparkSession
    items = pick(benchmark, item_id="long", text="string").where("text is not null")
    total = items.select(F.sum(F.regexp_count("text", F.lit(WORD)))).first()[0] or 0
    parts = max(1, -(-total // part_words))
    out = docs.withColumn("item_ids", F.array().cast("array<bigint>")).withColumn("n_windows", F.lit(0).cast("long"))
    for p in range(parts):
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(parts)) == p).collect()  # one part
        shared = shipped(spark, Items([r[0] for r in rows], [r[1] for r in rows], window))
        out = appended(out, [text], _search(shared), {"part_ids": "array<bigint>", "part_n": "bigint"})
        out = out.select(*docs.columns, F.array_sort(F.array_union("item_ids", "part_ids")).alias("item_ids"), (F.col("n_windows") + F.col("part_n")).alias("n_windows"))
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """doc_id, contaminated, item_ids, n_windows for every document."""
    out = flagged(pick(docs, doc_id="long", text="string"), "text", benchmark, **options)
    return out.select("doc_id", (F.col("n_windows") > 0).alias("contaminated"), "item_ids", "n_windows")


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that hold no benchmark item; columns as given."""
    rows, at = plain(docs, text="string")
    return restored(flagged(rows, at["text"], benchmark, **options).where("n_windows = 0"), docs.columns)
