"""Quality classifier: random Fourier features, ridge, isotonic calibration.

Every document becomes a vector of statistics of its whole text (lengths,
shares of character classes, repetition).  Random Fourier features of the
standardised vector approximate a Gaussian kernel; the normal equations of
ridge regression are summed inside tasks and then by row of the matrix, so the
driver sees one D x (D+1) matrix; isotonic regression (pool adjacent
violators) over a histogram of training scores turns scores into
probabilities.

Defined cases: null or empty text is the zero vector and is scored like any
other; labels that are null or have a null id do not count; a document with
several labels counts with each; without labels of both kinds the score is
the share of label 1 (0.5 without any); repeated rows are scored alike; extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growlytics.llm.common import Tokens, added, by_value, flags, hashed, held_out, pick, slices, staged, sums

by_value(__name__)
FOLDS, WIDTH, RIDGE, SEED, BINS = 5, 256, 1e-3, 11, 1024
#: Character classes of a byte: letters (and all of UTF-8 beyond ASCII), capitals, digits, blanks, line ends, then single marks.
_MARKS = b"!|#%&$*.,\"'-:;?=/@()<>"
_KIND = np.zeros(256, np.int64)
_KIND[[c for c in range(256) if chr(c).isascii() and chr(c).islower() or c >= 128]] = 1
_KIND[[c for c in range(65, 91)]] = 2
_KIND[[c for c in range(48, 58)]] = 3
_KIND[[9, 11, 12, 13, 32]] = 4
_KIND[10] = 5
_KIND[list(_MARKS)] = 6 + np.arange(len(_MARKS))
KINDS = 6 + len(_MARKS)
N_FEATURES = KINDS + 10


_UPPER, _SMALL = flags(bytes(range(65, 91))), flags(bytes(range(97, 123)))
_STOPS = flags(b".!?")


def _within(mask: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask)])
    return total[end] - total[start]


def _distinct(of: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """Number of different hashes of each text."""
    order = np.lexsort((h, of))
    of, h = of[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (of[1:] != of[:-1]) | (h[1:] != h[:-1])
    return np.bincount(of[new], minlength=n)


def features(texts) -> np.ndarray:
    """Statistics of whole texts, one row each."""
    m = len(texts)
    out = np.zeros((m, N_FEATURES))
    t = Tokens(texts)
    size = np.diff(t.begin)  # bytes, and one line end
    text_of = np.repeat(np.arange(m), size)
    kinds = np.bincount(text_of * KINDS + _KIND[t.bytes], minlength=m * KINDS).reshape(m, KINDS)
    kinds[:, 5] -= 1
    size = size - 1
    some = np.maximum(size, 1)
    out[:, :KINDS] = np.sqrt(kinds / some[:, None])
    x = out[:, KINDS:]
    n = t.sizes()
    words_ = np.maximum(n, 1)
    long_ = (t.end - t.start).astype(np.float64)
    x[:, 0], x[:, 1] = np.log1p(size), np.log1p(n)
    x[:, 2] = sums(long_, t.offsets) / words_
    x[:, 3] = np.sqrt(np.maximum(sums(long_ * long_, t.offsets) / words_ - x[:, 2] ** 2, 0))
    x[:, 4] = np.log1p(_distinct(t.of(), t.hashes(), m)) / np.log1p(words_)
    x[:, 5] = sums(long_ <= 3, t.offsets) / words_
    x[:, 6] = sums((_within(_UPPER[t.bytes], t.start, t.end) > 0) & (_within(_SMALL[t.bytes], t.start, t.end) == 0), t.offsets) / words_
    x[:, 7] = sums(_STOPS[t.bytes[t.end - 1]], t.offsets) / words_
    ends = np.flatnonzero(t.bytes == 10)
    starts = np.concatenate([[0], ends + 1])[:-1]
    full = np.searchsorted(t.start, ends) > np.searchsorted(t.start, starts)
    line_of = text_of[ends[full]]
    lines = np.bincount(line_of, minlength=m)
    x[:, 8] = np.log1p(n / np.maximum(lines, 1)) * (lines > 0)
    x[:, 9] = 1 - _distinct(line_of, hashed(t.bytes, starts[full], ends[full]), m) / np.maximum(lines, 1)
    out[size == 0] = 0
    return out


def _features(frames):
    for f in frames:
        texts = f["text"].tolist()
        for lo, hi in slices(texts):
            yield pd.DataFrame({"doc_id": f["doc_id"].array[lo:hi], "x": list(features(texts[lo:hi]))})


def _basis(seed: int = SEED):
    rng = np.random.default_rng(seed)
    return rng.normal(0, 0.6 / np.sqrt(N_FEATURES / 4), (N_FEATURES, WIDTH)), rng.uniform(0, 2 * np.pi, WIDTH)


def fourier(x: np.ndarray, mean: np.ndarray, std: np.ndarray) -> np.ndarray:
    """Random Fourier features, a constant first."""
    w, b = _basis()
    z = np.clip((x - mean) / std, -8, 8)
    return np.hstack([np.ones((len(x), 1)), np.cos(z @ w + b) * np.sqrt(2 / WIDTH)])


def _matrix(f) -> np.ndarray:
    return np.array(f["x"].tolist(), dtype=np.float64).reshape(len(f), N_FEATURES)


def _moments(frames):
    n, s, q = 0, np.zeros(N_FEATURES), np.zeros(N_FEATURES)
    for f in frames:
        x = _matrix(f)
        n, s, q = n + len(x), s + x.sum(axis=0), q + (x * x).sum(axis=0)
    if n:
        yield pd.DataFrame({"i": np.arange(N_FEATURES), "n": float(n), "s": s, "q": q})


def _equations(mean, std):
    def run(frames):
        total = np.zeros((WIDTH + 1, WIDTH + 2))
        for f in frames:
            z = fourier(_matrix(f), mean, std)
            total += z.T @ np.hstack([z, f["y"].to_numpy(np.float64)[:, None]])
        if total[0, 0]:
            yield pd.DataFrame({"i": np.arange(WIDTH + 1), "v": total.tolist()})

    return run


def _bin(raw: np.ndarray) -> np.ndarray:
    return np.clip(((raw + 0.5) / 2 * BINS).astype(np.int64), 0, BINS - 1)


def _bins(mean, std, beta):
    def run(frames):
        n, s = np.zeros(BINS), np.zeros(BINS)
        for f in frames:
            b = _bin(fourier(_matrix(f), mean, std) @ beta)
            n += np.bincount(b, minlength=BINS)
            s += np.bincount(b, weights=f["y"].to_numpy(np.float64), minlength=BINS)
        at = np.flatnonzero(n)
        yield pd.DataFrame({"b": at, "n": n[at], "s": s[at]})

    return run


def isotonic(n: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Non-decreasing fit of s/n by bin: pool adjacent violators; bins
    without rows take the value between their neighbours."""
    at = np.flatnonzero(n)
    stack: list[list[float]] = []
    for i in at:
        stack.append([s[i], n[i], 1])
        while len(stack) > 1 and stack[-2][0] * stack[-1][1] >= stack[-1][0] * stack[-2][1]:
            a, b, c = stack.pop()
            stack[-1] = [stack[-1][0] + a, stack[-1][1] + b, stack[-1][2] + c]
    fit = np.repeat([a / b for a, b, _ in stack], [int(c) for *_, c in stack])
    return np.interp(np.arange(len(n)), at, fit)


def fit(rows: DataFrame):
    """rows: x array, y 0/1.  (mean, std, beta, calibrated value per bin), or
    a number where a fit has nothing to tell apart."""
    got = rows.select("x").mapInPandas(_moments, "i long, n double, s double, q double").groupBy("i").sum().orderBy("i").toPandas()
    share = rows.agg(F.avg("y")).first()[0]
    if share is None or share in (0.0, 1.0):
        return 0.5 if share is None else share
    n, s, q = (got[f"sum({c})"].to_numpy() for c in "nsq")
    mean = s / n
    std = np.sqrt(np.maximum(q / n - mean * mean, 0)) + 1e-6
    parts = added(rows.mapInPandas(_equations(mean, std), "i long, v array<double>"))
    a = np.array(parts.orderBy("i").toPandas()["v"].tolist())
    count = a[0, 0]
    lhs = a[:, :-1] + RIDGE * count * np.diag([0.0] + [1.0] * WIDTH) / WIDTH + 1e-9 * count * np.eye(WIDTH + 1)
    beta = np.linalg.solve(lhs, a[:, -1])
    bins = rows.mapInPandas(_bins(mean, std, beta), "b long, n double, s double").groupBy("b").sum().toPandas()
    n, s = np.zeros(BINS), np.zeros(BINS)
    n[bins["b"]], s[bins["b"]] = bins["sum(n)"], bins["sum(s)"]
    return mean, std, beta, np.clip(isotonic(n, s), 0, 1)


def _scores(model):
    def run(frames):
        for f in frames:
            if isinstance(model, float):
                got = np.full(len(f), model)
            else:
                mean, std, beta, value = model
                raw = fourier(_matrix(f), mean, std) @ beta
                got = np.interp((raw + 0.5) / 2 * BINS - 0.5, np.arange(BINS), value)
                got = 0.999 * got + 0.001 / (1 + np.exp(-4 * np.clip(raw, -50, 50)))  # orders what the steps tie
            yield pd.DataFrame({"doc_id": f["doc_id"], "held_out": f["held_out"], "score": got})

    return run


def score(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    rows = pick(docs, doc_id="long", text="string").mapInPandas(_features, "doc_id long, x array<double>")
    rows = staged(rows, "quality-features")
    marks = pick(labels, doc_id="long", quality="double").where("doc_id is not null and quality is not null")
    marks = marks.where(~held_out("doc_id", folds)).select("doc_id", F.when(F.col("quality") > 0, 1.0).otherwise(0.0).alias("y"))
    train = staged(rows.join(marks, "doc_id").select("x", "y"), "quality-train")
    model = fit(train)
    out = rows.withColumn("held_out", held_out("doc_id", folds)).mapInPandas(_scores(model), "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int"))
