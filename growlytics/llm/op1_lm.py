"""Language-model scoring: a log-bilinear model trained with NCE.

Counts.  Training words are counted inside tasks and summed by a 64-bit hash
of the word; the counts stay a distributed table.  Words with a share of at
least ``SHARE`` of all tokens (so at most 1/SHARE words) are shipped to the
tasks; the counts of all rarer words are joined by shuffle.

Model.  The model's symbols are the end, the most frequent words, and classes
of all other words by the hash of their last bytes (so an unseen word has a
class too).  The log-bilinear model predicts a symbol from a weighted sum of
the embeddings of the ``CONTEXT`` symbols before it.  Noise-contrastive
estimation trains it in numpy on every training document: each task runs
AdaGrad over its own documents from the current parameters, and the tasks'
parameters are averaged by tokens, in rounds over growing disjoint shares of
the documents.  Scoring multiplies contexts with all symbols in batches and
normalises exactly; within a class a word has (c+0.1) / (N_class +
0.1 (V_class + 1)), with one place per class for unseen words.  So the
probabilities of all words at a position sum to one.

Defined cases: null text is empty and has one token, the end; a null doc_id
has the text '' for the fold; repeated rows are scored (and learned from) one
by one; ties between equally frequent words go to the smaller hash; without
training rows all counts are 0 and the model is the uniform one; extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growlytics.llm.common import Tokens, added, by_value, held_out, mix, pick, revived, shipped, slices, staged, sums

by_value(__name__)
FOLDS, SHARE = 10, 1e-6
SHORT, CLASSES, WIDTH, CONTEXT, NOISE, BATCH = 127, 128, 16, 5, 64, 2048
SYMBOLS = 1 + SHORT + CLASSES  # 0 is the end, which also stands before a text
ROUNDS = (1, 3, 12)  # sixteenths of the training documents
RATE, SEED = 0.15, 5
END = np.int64(0)  # the end's place among the words' hashes: class 0, all other bits 0
_CLASS = np.uint64(CLASSES - 1)


def _encoded(texts):
    """(words with an end after each text, offsets).  The lowest bits of a
    word's hash are its class, by the hash of its last three bytes."""
    t = Tokens(texts, lower=True)
    size = t.end - t.start
    tail = t.bytes[t.end - 1].astype(np.uint64) if len(t) else np.zeros(0, np.uint64)
    for j in (2, 3):
        ok = size >= j
        tail[ok] |= t.bytes[t.end[ok] - j].astype(np.uint64) << np.uint64(8 * (j - 1))
    tok = ((t.hashes() | (_CLASS + np.uint64(1))) & ~_CLASS) | (mix(tail) & _CLASS)  # never END
    offsets = t.offsets + np.arange(len(t.offsets))
    out = np.full(offsets[-1], END, np.int64)
    at = np.arange(len(t)) + t.of()
    out[at] = tok.view(np.int64)
    return out, offsets


def _count(frames):
    held, size = [], 0

    def flush():
        tok = np.concatenate([h[0] for h in held])
        n = np.concatenate([h[1] for h in held])
        tok, at = np.unique(tok, return_inverse=True)
        return tok, np.bincount(at, weights=n).astype(np.int64)

    for f in frames:
        texts = f["text"].tolist()
        for lo, hi in slices(texts):
            held.append(np.unique(_encoded(texts[lo:hi])[0], return_counts=True))
            size += len(held[-1][0])
            if size > 3_000_000:
                held = [flush()]
                size = len(held[0][0])
                if size > 1_500_000:
                    yield pd.DataFrame({"tok": held[0][0], "n": held[0][1]})
                    held, size = [], 0
    if held:
        tok, n = flush()
        yield pd.DataFrame({"tok": tok, "n": n})


class Vocabulary:
    """What the tasks need to know of the counts: totals, the frequent
    words (sorted by hash) and, per class, tokens and words outside the short
    list."""

    def __init__(self, counts: DataFrame, share: float = SHARE):
        total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
        self.n, self.v = int(total[0]), int(total[1])
        got = counts.where(F.col("n") >= max(1.0, self.n * share)).toPandas()  # at most 1 / share rows
        got = got.sort_values("tok", ignore_index=True)
        self.tok, self.c = got["tok"].to_numpy(np.int64), got["n"].to_numpy(np.int64)
        order = [i for i in np.lexsort((self.tok, -self.c)).tolist() if self.tok[i] != END][:SHORT]
        self.symbol = np.full(len(self.tok), -1, np.int64)
        self.symbol[order] = 1 + np.arange(len(order))
        self.symbol[self.tok == END] = 0
        by_hash = sorted(order)
        self.short, self.short_symbol = self.tok[by_hash], self.symbol[by_hash]
        known = [int(t) for t in self.short] + [int(END)]
        cls = F.col("tok").bitwiseAND(F.lit(CLASSES - 1))
        by = counts.where(~F.col("tok").isin(known)).groupBy(cls.alias("cls")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).toPandas()
        self.class_n, self.class_v = np.zeros(CLASSES), np.zeros(CLASSES)
        self.class_n[by["cls"]], self.class_v[by["cls"]] = by["n"], by["v"]
        uni = np.zeros(SYMBOLS)
        uni[self.symbol[self.symbol >= 0]] = self.c[self.symbol >= 0]
        uni[1 + SHORT:] = self.class_n
        self.unigram = (uni + 0.5) / (uni + 0.5).sum()

    def symbols(self, tok: np.ndarray) -> np.ndarray:
        out = 1 + SHORT + (tok & (CLASSES - 1))
        if len(self.short):
            at = np.minimum(np.searchsorted(self.short, tok), len(self.short) - 1)
            out = np.where(self.short[at] == tok, self.short_symbol[at], out)
        return np.where(tok == END, 0, out)

    def counts_of(self, tok: np.ndarray) -> np.ndarray:
        """Count of each word, -1 if it is not among the shipped ones."""
        if not len(self.tok):
            return np.full(len(tok), -1, np.int64)
        at = np.minimum(np.searchsorted(self.tok, tok), len(self.tok) - 1)
        return np.where(self.tok[at] == tok, self.c[at], -1)


# ------------------------------------------------------------------ the model


def start(unigram: np.ndarray) -> np.ndarray:
    """Initial parameters, flat: R, Q (symbols x width), b, C (context x width)."""
    rng = np.random.default_rng(SEED)
    return np.concatenate([rng.normal(0, 0.1, 2 * SYMBOLS * WIDTH), np.log(unigram), np.full(CONTEXT * WIDTH, 1.0 / CONTEXT)]).astype(np.float32)


def _split(p: np.ndarray):
    k = SYMBOLS * WIDTH
    return p[:k].reshape(SYMBOLS, WIDTH), p[k:2 * k].reshape(SYMBOLS, WIDTH), p[2 * k:2 * k + SYMBOLS], p[2 * k + SYMBOLS:].reshape(CONTEXT, WIDTH)


def contexts(symbols: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The CONTEXT symbols before each position (the end before a text)."""
    n = len(symbols)
    first = np.repeat(offsets[:-1], np.diff(offsets))
    out = np.zeros((n, CONTEXT), np.int64)
    place = np.arange(n) - first
    for j in range(min(CONTEXT, n - 1)):
        out[j + 1:, j] = symbols[:n - j - 1]
        out[place <= j, j] = 0
    return out


def _scatter(size: int, index: np.ndarray, rows: np.ndarray) -> np.ndarray:
    order = np.argsort(index.astype(np.uint16), kind="stable")  # sorted by radix
    sorted_ = index[order]
    heads = np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1]])
    out = np.zeros((size, rows.shape[1]), np.float32)
    out[sorted_[heads]] = np.add.reduceat(rows[order], heads, axis=0)
    return out


def _context_vectors(R: np.ndarray, C: np.ndarray, ctx: np.ndarray) -> np.ndarray:
    """The weighted sum of the embeddings of each row of ``ctx``."""
    r = (R * C[0])[ctx[:, 0]]
    for j in range(1, CONTEXT):
        r += (R * C[j])[ctx[:, j]]
    return r


def nce_step(p, grad2, ctx, target, noise, log_kpn):
    """One AdaGrad step of noise-contrastive estimation in place; the noise
    words are shared by the batch, so scores are one matrix product."""
    R, Q, b, C = _split(p)
    r = _context_vectors(R, C, ctx)
    pos = np.einsum("bd,bd->b", r, Q[target]) + b[target] - log_kpn[target]
    neg = r @ Q[noise].T
    neg += b[noise] - log_kpn[noise]
    n = len(target)
    g_pos = -1 / (1 + np.exp(np.clip(pos, -30, 30)))  # d loss / d pos
    g_neg = np.clip(neg, -30, 30, out=neg)  # d loss / d neg, in place
    np.exp(np.negative(g_neg, out=g_neg), out=g_neg)
    np.reciprocal(np.add(g_neg, 1, out=g_neg), out=g_neg)
    g_r = g_pos[:, None] * Q[target] + g_neg @ Q[noise]
    g = np.zeros_like(p)
    gR, gQ, gb, gC = _split(g)
    gQ += _scatter(SYMBOLS, target, g_pos[:, None] * r)
    np.add.at(gQ, noise, g_neg.T @ r)
    gb += np.bincount(target, weights=g_pos, minlength=SYMBOLS).astype(np.float32)
    gb += np.bincount(noise, weights=g_neg.sum(axis=0), minlength=SYMBOLS).astype(np.float32)
    for j in range(CONTEXT):
        of_symbol = _scatter(SYMBOLS, ctx[:, j], g_r)
        gR += of_symbol * C[j]
        gC[j] += (of_symbol * R).sum(axis=0)
    g /= n
    grad2 += g * g
    p -= RATE * g / np.sqrt(grad2 + 1e-8)


def log10_softmax(p: np.ndarray, ctx: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Normalised log10 probabilities of the targets, in batches."""
    R, Q, b, C = _split(p)
    out, ones = np.empty(len(target)), np.ones(SYMBOLS, np.float32)
    with_b = np.hstack([Q, b[:, None]]).T
    widest, highest = float(np.sqrt((Q * Q).sum(axis=1).max())), float(b.max())
    for lo in range(0, len(target), 1024):  # a batch's scores stay in the processor's cache
        c, t = ctx[lo:lo + 1024], target[lo:lo + 1024]
        r = _context_vectors(R, C, c)
        s = np.hstack([r, ones[:1].repeat(len(t))[:, None]]) @ with_b
        hit = s[np.arange(len(t)), t].astype(np.float64)
        top = 0.0
        if float(np.sqrt((r * r).sum(axis=1).max())) * widest + highest > 60:
            top = max(0.0, float(s.max()) - 60)  # keeps the exponentials finite
        if top:
            s -= top
        np.exp(s, out=s)
        out[lo:lo + 1024] = (hit - top - np.log((s @ ones).astype(np.float64))) / np.log(10)
    return out


def _train(shared, params: np.ndarray):
    def run(frames):
        vocabulary, p = revived(Vocabulary, shared), params.copy()
        grad2 = np.full(len(p), 1e-3, np.float32)
        rng = np.random.default_rng(SEED)
        log_kpn = np.log(NOISE * vocabulary.unigram).astype(np.float32)
        total = 0
        for f in frames:
            texts = f["text"].tolist()
            for lo, hi in slices(texts):
                tok, offsets = _encoded(texts[lo:hi])
                s = vocabulary.symbols(tok)
                ctx = contexts(s, offsets)
                order = rng.permutation(len(s))
                noise = rng.choice(SYMBOLS, (len(s) // BATCH + 1, NOISE), p=vocabulary.unigram)
                for k in range(0, len(s), BATCH):
                    i = order[k:k + BATCH]
                    nce_step(p, grad2, ctx[i], s[i], noise[k // BATCH], log_kpn)
                total += len(s)
        if total:
            v = np.append(p.astype(np.float64) * total, total)
            part = 2048
            yield pd.DataFrame({"i": np.arange(-(-len(v) // part)), "v": [v[k:k + part].tolist() for k in range(0, len(v), part)]})

    return run


def train(rows: DataFrame, shared, vocabulary: Vocabulary) -> np.ndarray:
    """Parameters after all rounds; every training document is in one."""
    p = start(vocabulary.unigram)
    lot, lo = F.pmod(F.xxhash64("doc_id", "text", F.lit(SEED)), F.lit(16)), 0
    for width in ROUNDS:
        share = rows.where((lot >= lo) & (lot < lo + width))
        got = added(share.select("text").mapInPandas(_train(shared, p), "i long, v array<double>")).toPandas().sort_values("i")
        if len(got):
            v = np.concatenate(got["v"].tolist())
            p = (v[:-1] / v[-1]).astype(np.float32)
        lo += width
    return p


def _score(shared, params):
    def run(frames):
        vocabulary, p = revived(Vocabulary, shared), params.value
        all_n, all_v = vocabulary.n, vocabulary.v
        for f in frames:
            texts = f["text"].tolist()
            for lo, hi in slices(texts):
                tok, offsets = _encoded(texts[lo:hi])
                s, c = vocabulary.symbols(tok), vocabulary.counts_of(tok)
                lm = log10_softmax(p, contexts(s, offsets), s)
                known, cls = c >= 0, tok & (CLASSES - 1)
                of_c = np.log10(np.maximum(c, 0) + 0.1)
                base = np.where(known, of_c - np.log10(all_n + 0.1 * (all_v + 1)), 0.0)
                lm += np.where(known & (s > SHORT), of_c - np.log10(vocabulary.class_n[cls] + 0.1 * (vocabulary.class_v[cls] + 1)), 0.0)
                other = np.flatnonzero(~known)
                of = np.searchsorted(offsets, other, side="right") - 1
                order = np.lexsort((tok[other], of))
                of, rare = of[order], tok[other][order]
                head = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (rare[1:] != rare[:-1])]) if len(of) else np.zeros(0, np.int64)
                times = np.diff(np.append(head, len(of)))
                cut = np.searchsorted(of[head], np.arange(hi - lo + 1))
                yield pd.DataFrame({
                    "rid": f["rid"].iloc[lo:hi].to_numpy(), "doc_id": f["doc_id"].array[lo:hi], "n_tokens": np.diff(offsets),
                    "n_known": sums(known, offsets).astype(np.int64), "base": sums(base, offsets), "lm": sums(lm, offsets),
                    "rare": [rare[head[a:b]] for a, b in zip(cut[:-1], cut[1:])], "rare_n": [times[a:b] for a, b in zip(cut[:-1], cut[1:])]})

    return run


def scores(docs: DataFrame, folds: int = FOLDS, share: float = SHARE) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    rows = pick(docs, doc_id="long", text="string")
    training = rows.where(~held_out("doc_id", folds))
    counts = training.select("text").mapInPandas(_count, "tok long, n long").groupBy("tok").agg(F.sum("n").alias("n"))
    counts = staged(counts, "lm-counts")
    vocabulary = Vocabulary(counts, share)
    shared = shipped(spark, vocabulary)  # at most 1 / share words
    params = spark.sparkContext.broadcast(train(training, shared, vocabulary))

    n, v = vocabulary.n, vocabulary.v
    schema = "rid long, doc_id long, n_tokens long, n_known long, base double, lm double, rare array<long>, rare_n array<long>"
    got = staged(rows.withColumn("rid", F.monotonically_increasing_id()).mapInPandas(_score(shared, params), schema), "lm-scored")
    # one row per rare word of a text; what the text has of its own goes with the first
    got = got.select("rid", "doc_id", "n_tokens", "n_known", "base", "lm", F.explode_outer(F.arrays_zip("rare", "rare_n")).alias("r"),
                     F.col("rare")[0].alias("head")).select("*", (F.col("r.rare").isNull() | (F.col("r.rare") == F.col("head"))).alias("first"))
    own = [F.when(F.col("first"), F.col(c)).alias(c) for c in ("doc_id", "n_tokens", "n_known", "base", "lm")]
    got = got.select("rid", *own, F.col("r.rare").alias("tok"), F.col("r.rare_n").alias("tf"), F.col("r.rare").bitwiseAND(F.lit(CLASSES - 1)).cast("int").alias("cls"))
    whole = got.where("tok is null").select("rid", "doc_id", "n_tokens", "n_known", "base", "lm")
    rarer = counts.where(F.col("n") < max(1.0, n * share)).select("tok", "n")
    parts = got.where("tok is not null").join(rarer, "tok", "left")
    c = F.coalesce("n", F.lit(0))
    class_total = F.array(*[F.lit(float(a + 0.1 * (b + 1))) for a, b in zip(vocabulary.class_n, vocabulary.class_v)])
    parts = parts.select(
        "rid", "doc_id", "n_tokens", (F.coalesce("n_known", F.lit(0)) + F.when(c > 0, F.col("tf")).otherwise(0)).alias("n_known"),
        (F.coalesce("base", F.lit(0.0)) + F.col("tf") * F.log10((c + 0.1) / F.lit(n + 0.1 * (v + 1)))).alias("base"),
        (F.coalesce("lm", F.lit(0.0)) + F.col("tf") * F.log10((c + 0.1) / class_total[F.col("cls")])).alias("lm"))
    parts = parts.groupBy("rid").agg(F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
                                     F.sum("base").alias("base"), F.sum("lm").alias("lm")).select(whole.columns)
    out = whole.union(parts)
    return out.select("doc_id", held_out("doc_id", folds).alias("held_out"), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
                      F.col("base").alias("base_score"), F.col("lm").alias("score"))
