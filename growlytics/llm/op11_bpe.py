"""Byte-level BPE: texts to token ids and back, by a contiguous rank array.

1. Added tokens of the vocabulary file cut a text into segments (leftmost,
   longest), each segment is split into words by the public pattern of this
   vocabulary family (contractions, letters, numbers, other marks, each with
   one blank before it; runs of white space).  The split works on the code
   points of a slice of texts at once: classes come from a table, every word
   start follows from its neighbours.
2. Each distinct word of a slice is merged once.  A short word holds its part
   boundaries and the rank of each adjacent pair of parts side by side; the
   array is scanned for its minimum (leftmost first), that boundary is
   deleted and the two ranks beside it are looked up again, until no pair has
   a rank.  A word over ``SHORT`` bytes does the same with a heap in place of
   the scan, so that its cost does not grow with the square of its length.
3. Ids of distinct words are laid end to end; the words of all texts gather
   theirs from it.  Decoding gathers the bytes of the ids.

Memory: one slice of texts (``CHARS`` characters, or one longer text), and a
table of merged words of at most ``KEPT`` entries per Python worker.  The vocabulary,
whose size its file fixes, is the only broadcast.  Nothing is shuffled.

Defined cases: null and empty texts have no tokens; ids outside the
vocabulary decode to nothing; bytes that are not UTF-8 decode to U+FFFD, null
ids to a null text; repeated rows get equal results; an empty table gives an
empty one; extra columns are carried along, whatever their names."""

from __future__ import annotations

import heapq
import json
import unicodedata

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from growlytics.llm.common import by_value, hashed, plain, restored, shipped, revived, slices

by_value(__name__)
SHORT, KEPT, CHARS = 192, 1 << 19, 1 << 21
LETTER, NUMBER, OTHER, SPACE = range(4)
# The contractions that the public pattern splits off, and Unicode's white space.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


# Letters and numbers that Unicode 16 added, for interpreters with older tables.
NEW_LETTERS = [(0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
               (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
               (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0)]
NEW_NUMBERS = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]


def _classes() -> np.ndarray:
    """The class of every code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(i))[0], OTHER) for i in range(0x110000)), np.uint8, 0x110000)
    for kind, ranges in ((LETTER, NEW_LETTERS), (NUMBER, NEW_NUMBERS)):
        for lo, hi in ranges:
            out[lo:hi + 1] = kind
    out[WHITE] = SPACE
    return out


def printable() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable
    Latin-1 stands for itself, the others follow from U+0100 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in kept]
    return {**{chr(b): b for b in kept}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class Vocabulary:
    """Ids, merge ranks and added tokens of a byte-level BPE file (JSON)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as fh:
            spec = json.load(fh)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre.get("use_regex", True) or model["ignore_merges"]:
            raise ValueError(f"not a plain byte-level BPE vocabulary: {path}")
        if any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens that look at their surroundings are not supported")
        chars = printable()
        raw = {t: bytes(chars[c] for c in t) for t in model["vocab"]}
        ids = {raw[t]: i for t, i in model["vocab"].items()}
        self.first = [ids[bytes([b])] for b in range(256)]
        pairs = [[ids[bytes(chars[c] for c in part)] for part in (m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        self.ranks = {a << 32 | b: r for r, (a, b) in enumerate(pairs)}
        self.kept = {}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*ids.values(), *self.added.values()]) + 1
        made = [b""] * size
        for b, i in ids.items():
            made[i] = b
        self.made = [ids[made[a] + made[b]] for a, b in pairs]  # the id that each rank makes
        for t, i in self.added.items():
            made[i] = t.encode()
        self.flat = np.frombuffer(b"".join(made), np.uint8)
        self.at = np.concatenate([[0], np.cumsum([len(b) for b in made])])

    # ------------------------------------------------------------ one word

    def merged(self, word: bytes) -> list[int]:
        parts = [self.first[b] for b in word]
        return self._scanned(parts) if len(parts) <= SHORT else self._queued(parts)

    def _scanned(self, parts: list[int]) -> list[int]:
        """``ranks[i]`` belongs to the boundary between parts i and i + 1;
        deleting a boundary closes the gap in both lists."""
        get, made, none = self.ranks.get, self.made, len(self.made)
        ranks = [get(a << 32 | b, none) for a, b in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == none:
                break
            i = ranks.index(least)
            parts[i] = made[least]
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = get(parts[i] << 32 | parts[i + 1], none)
            if i:
                ranks[i - 1] = get(parts[i - 1] << 32 | parts[i], none)
        return parts

    def _queued(self, parts: list[int]) -> list[int]:
        """The same merges from a heap of (rank, place); a part that was
        merged away has id -1."""
        get, n = self.ranks.get, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := get(parts[i] << 32 | parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] < 0 or j >= n or get(parts[i] << 32 | parts[j]) != r:
                continue
            parts[i], parts[j] = self.made[r], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (r := get(parts[k] << 32 | parts[after[k]])) is not None:
                    heapq.heappush(heap, (r, k))
        return [p for p in parts if p >= 0]

    # ----------------------------------------------------------- many texts

    def encode(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a list of texts, and where each text's ids begin."""
        segments, owner, fixed = self._segments(texts)
        points = np.frombuffer("".join(segments).encode("utf-32-le", "replace"), np.uint32)
        sizes = np.fromiter(map(len, segments), np.int64, len(segments))
        begin = np.concatenate([[0], np.cumsum(sizes)])
        start = np.flatnonzero(_starts(points, begin, self.table()))
        end = np.append(start[1:], len(points))[:len(start)]
        kinds, which = self._distinct(points, start, end)
        # ids of the distinct words, end to end; those of added tokens follow
        lists = [*[self._known(w) for w in kinds], *[[i] for i in fixed]]
        length = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter((i for x in lists for i in x), np.int32, int(length.sum()))
        at = np.concatenate([[0], np.cumsum(length)])
        # the words of all segments, with each added token after its segment
        seg = np.searchsorted(begin, start, side="right") - 1
        ends = np.flatnonzero(owner[1:] == owner[:-1]) if len(owner) else np.empty(0, np.int64)
        order = np.argsort(np.concatenate([2 * seg, 2 * ends + 1]), kind="stable")
        which = np.concatenate([which, len(kinds) + np.arange(len(ends))])[order]
        text = np.concatenate([owner[seg], owner[ends]])[order] if len(order) else np.empty(0, np.int64)
        n = length[which]
        total = np.concatenate([[0], np.cumsum(n)])
        ids = flat[np.repeat(at[which] - total[:-1], n) + np.arange(total[-1])]
        per = np.bincount(text, n, len(texts)).astype(np.int64) if len(text) else np.zeros(len(texts), np.int64)
        return ids, np.concatenate([[0], np.cumsum(per)])

    def table(self) -> np.ndarray:
        if "classes" not in vars(self):
            self.classes = _classes()
        return self.classes

    def _segments(self, texts):
        """Texts cut at added tokens; the text of each segment; the id after
        each segment that is not the last of its text."""
        import re

        pattern = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        segments, owner, fixed = [], [], []
        for i, t in enumerate(texts):
            parts = pattern.split(t) if t and pattern else [t or ""]
            segments += parts[::2]
            owner += [i] * len(parts[::2])
            fixed += [self.added[p] for p in parts[1::2]]
        return segments, np.array(owner, np.int64), fixed

    def _distinct(self, points, start, end):
        """The distinct words, and which of them each word is: by hash, and
        compared character by character with the first of its hash."""
        if not len(start):
            return [], np.empty(0, np.int64)
        h = hashed(points, start, end)
        _, first, which = np.unique(h, return_index=True, return_inverse=True)
        size, head = end - start, first[which]
        same = np.array_equal(size, size[head])
        if same:
            same = np.array_equal(points, points[np.repeat(start[head] - start, size) + np.arange(len(points))])
        if same:
            return [points[a:b].tobytes().decode("utf-32-le") for a, b in zip(start[first].tolist(), end[first].tolist())], which
        words = [points[a:b].tobytes().decode("utf-32-le") for a, b in zip(start.tolist(), end.tolist())]
        place = {w: i for i, w in enumerate(dict.fromkeys(words))}
        return list(place), np.array([place[w] for w in words], np.int64)

    def _known(self, word: str) -> list[int]:
        kept = self.kept
        ids = kept.get(word)
        if ids is None:
            ids = self.merged(word.encode("utf-8", "replace"))
            if len(word) <= SHORT:
                if len(kept) >= KEPT:
                    kept.clear()
                kept[word] = ids
        return ids

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The text of each offsets range of ids."""
        ids = np.where((ids >= 0) & (ids < len(self.at) - 1), ids, -1)
        size = np.where(ids >= 0, np.diff(self.at)[ids], 0)
        total = np.concatenate([[0], np.cumsum(size)])
        raw = self.flat[np.repeat(self.at[ids] - total[:-1], size) + np.arange(total[-1])].tobytes()
        ends = total[offsets].tolist()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]


def _starts(points: np.ndarray, begin: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """True where a word of the public pattern starts.

    A word is a run of one class; the last of a run of blanks before
    something else is a word's first character if it is U+0020, else a word
    of its own; a contraction at the start of a word ends that word."""
    n = len(points)
    kind = classes[points]
    first = np.zeros(n + 1, bool)
    first[begin] = True
    first = first[:n]
    new = first.copy()
    if n < 2:
        return new
    new[1:] |= kind[1:] != kind[:-1]
    # blanks before something else in the same segment
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~first[1:])
    new[last] = True
    new[last[points[last] == 32] + 1] = False
    quote = np.flatnonzero((points == 39) & new)
    if len(quote):
        padded = np.concatenate([points, np.zeros(3, np.uint32)])
        stop = np.append(first, [True, True, True])
        for c in CONTRACTIONS:
            hit = quote
            for k, ch in enumerate(c, 1):
                hit = hit[(padded[hit + k] == ord(ch)) & ~stop[hit + k]]
            for k in range(1, len(c) + 1):
                new[hit + k] = False
            after = hit + len(c) + 1
            new[after[after < n]] = True
    return new


def _encoding(shared, at: int):
    def run(batches):
        import pyarrow as pa

        vocabulary = revived(Vocabulary, shared)
        for b in batches:
            texts = b.column(at).to_pylist()
            ids, counts = [], [np.zeros(1, np.int64)]
            for lo, hi in slices(texts, CHARS):
                got, offsets = vocabulary.encode(texts[lo:hi])
                ids.append(got)
                counts.append(np.diff(offsets))
            offsets = np.cumsum(np.concatenate(counts))
            column = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(np.concatenate([np.empty(0, np.int32), *ids])))
            yield pa.RecordBatch.from_arrays([*b.columns, column], [*b.schema.names, "ids"])

    return run


def _decoding(shared, at: int, keep: list[int]):
    def run(batches):
        import pyarrow as pa

        vocabulary = revived(Vocabulary, shared)
        for b in batches:
            column = b.column(at)
            ids = column.flatten().to_numpy(zero_copy_only=False)
            ids = np.nan_to_num(ids, nan=-1).astype(np.int64)
            size = np.array([0 if n is None else n for n in column.value_lengths().to_pylist()], np.int64)
            texts, offsets = [], np.concatenate([[0], np.cumsum(size)])
            for lo in range(0, len(column), 64):
                part = offsets[lo:lo + 65]
                texts += vocabulary.decode(ids[part[0]:part[-1]], part - part[0])
            out = [t if ok else None for t, ok in zip(texts, column.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in keep], pa.array(out, pa.string())], [*[b.schema.names[i] for i in keep], "decoded"])

    return run


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """The columns of ``docs`` and ``ids``: the token ids of its text, with
    the vocabulary file at ``path`` (read on the driver, broadcast)."""
    shared = shipped(docs.sparkSession, Vocabulary(path))
    rows, at = plain(docs, text="string")
    out = rows.mapInArrow(_encoding(shared, rows.columns.index(at["text"])), StructType([*rows.schema.fields, StructField("ids", ArrayType(IntegerType()))]))
    return restored(out, docs.columns, "ids")


def decoded(rows: DataFrame, path: str, drop_ids: bool = False) -> DataFrame:
    """The columns of ``rows`` (without ``ids`` if so asked) and ``decoded``:
    the text of its ids."""
    shared = shipped(rows.sparkSession, Vocabulary(path))
    names = rows.columns
    at = names.index("ids")
    flat, _ = plain(rows, ids="array<int>")
    keep = [i for i in range(len(names)) if not (drop_ids and i == at)]
    schema = StructType([*[flat.schema.fields[i] for i in keep], StructField("decoded", StringType())])
    out = flat.mapInArrow(_decoding(shared, at, keep), schema)
    return out.select(*[F.col(f"c{i}").alias(names[i]) for i in keep], "decoded")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (ids in decimal, joined by commas) and
    decoded_sha256 of each document."""
    from growlytics.llm.common import pick

    rows = encoded(pick(docs, doc_id="long", text="string"), path)
    ids = F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256)
    rows = rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), ids.alias("ids_sha256"), "ids")
    return decoded(rows, path, drop_ids=True).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
