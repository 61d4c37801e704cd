"""Language identification by multilingual mixture inference.

Learning counts byte trigrams of lower-cased words per language in hashed
buckets (a bounded table: languages x ``BUCKETS``), summed inside tasks
before the shuffle.  A document is a mixture: each word comes from language l
with probability pi_l, and a word's likelihood under l is the product of its
trigrams' probabilities.  Expectation-maximisation estimates pi per document;
the set of languages is chosen by penalised likelihood: languages are dropped,
smallest share first, as long as log L - |set| * log(n) / 2 does not fall.

Defined cases: null text, empty text or a text without any letter gives
``und`` with score 0; with no training rows every text is ``und``; ties go to
the smaller language name; repeated rows get the same answer; rows with null
doc_id count as text '' for the fold.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growlytics.llm.common import Tokens, appended, by_value, flags, held_out, pick, plain, restored, slices, sums

by_value(__name__)
BUCKETS = 1 << 15
FOLDS = 5


_LETTER = flags(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
_EDGE = np.arange(256, dtype=np.uint32)
_EDGE[[9, 10, 11, 12, 13]] = 32


def _trigrams(t: Tokens):
    """The buckets of the trigrams around each byte of the words (blanks
    stand around a word), and the offsets of each word's."""
    raw = _EDGE[np.concatenate([[32], t.bytes, [32]]).astype(np.int64)]
    code = raw[:-2] << np.uint32(16) | raw[1:-1] << np.uint32(8) | raw[2:]
    size = t.end - t.start
    offsets = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(t.start - offsets[:-1], size) + np.arange(offsets[-1])
    return ((code[at] * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64), offsets


def _lettered(t: Tokens) -> np.ndarray:
    """Which words have a letter (of any script)."""
    if not len(t):
        return np.zeros(0, bool)
    ok = np.diff(np.concatenate([[0], np.cumsum(_LETTER[t.bytes])])[np.stack([t.start, t.end])], axis=0)[0] > 0
    wide = np.diff(np.concatenate([[0], np.cumsum(t.bytes >= 128)])[np.stack([t.start, t.end])], axis=0)[0] > 0
    for i in np.flatnonzero(wide & ~ok).tolist():
        ok[i] = any(c.isalpha() for c in t.raw[t.start[i]:t.end[i]].decode("utf-8", "replace"))
    return ok


def _lower(texts) -> Tokens:
    return Tokens([t.lower() if t else t for t in texts])


def _count(frames):
    total: dict[str, np.ndarray] = {}
    for f in frames:
        for lang, texts in f.groupby("lang")["text"]:
            texts = texts.tolist()
            into = total.setdefault(lang, np.zeros(BUCKETS, np.int64))
            for lo, hi in slices(texts):
                into += np.bincount(_trigrams(_lower(texts[lo:hi]))[0], minlength=BUCKETS)
    for lang, n in total.items():
        at = np.flatnonzero(n)
        yield pd.DataFrame({"lang": lang, "bucket": at, "n": n[at]})


def learn(docs: DataFrame, folds: int = FOLDS) -> tuple[list[str], np.ndarray]:
    """(languages, log probabilities [BUCKETS, languages]) from the rows that
    are not held out.  The driver gets at most BUCKETS rows per language."""
    rows = pick(docs, doc_id="long", text="string", lang="string")
    rows = rows.where(~held_out("doc_id", folds)).where("lang is not null and text is not null")
    counts = rows.select("lang", "text").mapInPandas(_count, "lang string, bucket long, n long")
    got = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(got["lang"].unique().tolist())
    table = np.full((BUCKETS, len(langs)), 0.5)
    at = {lang: i for i, lang in enumerate(langs)}
    table[got["bucket"].to_numpy(np.int64), got["lang"].map(at).to_numpy(np.int64)] += got["n"].to_numpy()
    return langs, np.log(table / table.sum(axis=0)) if langs else table


def _em(lik, doc, offsets, n, pi, steps):
    """Shares and log-likelihoods after ``steps`` rounds."""
    for _ in range(steps):
        part = lik * pi[doc]
        part /= part.sum(axis=1, keepdims=True)
        pi = sums(part, offsets) / n[:, None]
    return pi, sums(np.log((lik * pi[doc]).sum(axis=1)), offsets)


def infer(word_ll: np.ndarray, offsets: np.ndarray, steps: int = 6) -> np.ndarray:
    """Shares per document [documents, languages] from the log-likelihoods
    of their words; every document has at least one word."""
    n = np.diff(offsets).astype(np.float64)
    langs = word_ll.shape[1]
    lik = np.exp(np.maximum(word_ll - word_ll.max(axis=1, keepdims=True), -60.0))
    doc = np.repeat(np.arange(len(n)), np.diff(offsets))
    pi, _ = _em(lik, doc, offsets, n, np.full((len(n), langs), 1.0 / langs), steps)
    pi = np.where(pi * n[:, None] < 0.5, 0.0, pi)  # less than half a word
    top = pi.argmax(axis=1)
    pi[np.arange(len(n)), top] = np.maximum(pi[np.arange(len(n)), top], 1e-12)
    pi /= pi.sum(axis=1, keepdims=True)
    pi, ll = _em(lik, doc, offsets, n, pi, 2)
    penalty = np.log(np.maximum(n, 2.0)) / 2
    open_ = np.flatnonzero((pi > 0).sum(axis=1) > 1)
    while len(open_):
        sub = np.concatenate([np.arange(offsets[i], offsets[i + 1]) for i in open_])
        sub_off = np.concatenate([[0], np.cumsum(n[open_]).astype(np.int64)])
        tried = pi[open_].copy()
        low = np.where(tried > 0, tried, np.inf).argmin(axis=1)
        tried[np.arange(len(open_)), low] = 0
        tried /= tried.sum(axis=1, keepdims=True)
        sub_doc = np.repeat(np.arange(len(open_)), np.diff(sub_off))
        tried, sub_ll = _em(lik[sub], sub_doc, sub_off, n[open_], tried, 4)
        better = sub_ll + penalty[open_] >= ll[open_]
        kept = open_[better]
        pi[kept], ll[kept] = tried[better], sub_ll[better]
        open_ = kept[(pi[kept] > 0).sum(axis=1) > 1]
    return pi


def _judge(langs: list[str], table: np.ndarray, texts: list):
    pred, score, shares = ["und"] * len(texts), [0.0] * len(texts), [[] for _ in texts]
    for lo, hi in slices(texts):
        t = _lower(texts[lo:hi])
        use = _lettered(t)
        sizes = sums(use, t.offsets).astype(np.int64)
        some = np.flatnonzero(sizes)
        if not len(some) or not langs:
            continue
        at, word_at = _trigrams(t)
        word_ll = np.column_stack([sums(table[at, i], word_at) for i in range(len(langs))])
        pi = infer(word_ll[use], np.concatenate([[0], np.cumsum(sizes[some])]))
        for i, k, p in zip(some.tolist(), pi.argmax(axis=1).tolist(), pi):
            pred[lo + i], score[lo + i], shares[lo + i] = langs[k], min(1.0, max(0.0, float(p[k]))), p.tolist()
    return pred, score, shares


def judged(docs: DataFrame, text: str, langs: list[str], table: np.ndarray) -> DataFrame:
    """``docs`` (with distinct names) and lang_pred, score, shares."""
    shared = docs.sparkSession.sparkContext.broadcast(table)  # BUCKETS x languages doubles

    def fn(texts):
        return _judge(langs, shared.value, texts)

    return appended(docs, [text], fn, {"lang_pred": "string", "score": "double", "shares": "array<double>"})


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray] | None = None, folds: int = FOLDS) -> DataFrame:
    """doc_id, held_out, lang_pred, score (share of the predicted language)
    and shares (one per learned language, in order; empty for ``und``)."""
    out = judged(pick(docs, doc_id="long", text="string"), "text", *(model or learn(docs, folds)))
    return out.select("doc_id", held_out("doc_id", folds).alias("held_out"), "lang_pred", "score", "shares")


def keep_identified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows whose language is identified with at least ``least`` share;
    columns as given."""
    rows, at = plain(docs, text="string")
    out = judged(rows, at["text"], *learn(docs)).where(f"lang_pred <> 'und' and score >= {least}")
    return restored(out, docs.columns)
