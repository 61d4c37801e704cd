"""Line dedup: postings compared in buckets, words of candidates read once."""

import random

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest

from growlytics.llm import op3_lines
from growlytics.llm.common import row_key
from tests.llm import brute


def near_copies(rng, groups=8, size=12):
    rows = []
    for g in range(groups):
        form = [f"g{g}w{i}" for i in range(rng.choice([1, 4, 9, 20, 40]))]
        for _ in range(size):
            line = list(form)
            for i in rng.sample(range(len(form)), rng.randint(0, len(form) // 6)):
                line[i] = f"x{rng.randrange(9)}"
            line += [f"y{rng.randrange(9)}" for _ in range(rng.randint(0, len(form) // 6))]
            rows.append((len(rows), " ".join(line) + "\n" + " ".join(rng.choices([f"c{i}" for i in range(8)], k=5))))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("crowd, hot", [(2, 1), (16, 8), (16, op3_lines.HOT)])
def test_lists_in_buckets_and_by_join(spark, crowd, hot):
    rows = near_copies(random.Random(hot + crowd))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("rid", row_key("doc_id", "text"))
    left = {(r.rid, r.line) for r in op3_lines.kept_lines(docs, crowd=crowd, hot=hot).collect()}
    ids = {r.doc_id: r.rid for r in docs.collect()}
    for (d, t), kept in zip(rows, brute.lines_kept(rows)):
        assert "\n".join(x for i, x in enumerate(t.split("\n")) if (ids[d], i) in left) == kept


@pytest.mark.parametrize("block", [1, 7, 1 << 18])
def test_no_similar_pair_is_lost(monkeypatch, block):
    """Every pair of sets similar enough comes out once packed and compared,
    whatever the number of buckets and blocks; two settled lines never do."""
    monkeypatch.setattr(op3_lines, "BLOCK", block)
    monkeypatch.setattr(op3_lines, "PACK", 500)
    rng, h = random.Random(5), np.random.default_rng(5).integers(1, 2**63, 4000, np.uint64) * np.uint64(2)
    sets = []
    for _ in range(40):
        form = rng.sample(range(4000), rng.choice([1, 2, 5, 6, 11, 30, 60]))
        sets += [sorted((set(form) - set(rng.sample(form, rng.randint(0, len(form) // 5)))) | set(rng.sample(range(4000), rng.randint(0, len(form) // 5)))) for _ in range(6)]
    sets = list({tuple(sorted(s, key=lambda i: h[i])) for s in sets if s})
    open_ = [rng.random() < 0.7 for _ in sets]

    def bits(s, odd):
        out = 0
        for i in s:
            x = int(h[i])
            out ^= (1 << ((x >> 1) & 63)) if (x & 1) == odd else 0
        return out - (out >> 63 << 64)

    lines = pa.RecordBatch.from_arrays([
        pa.array(range(len(sets)), pa.int64()), pa.array([len(s) if o else -len(s) for s, o in zip(sets, open_)], pa.int32()),
        pa.array([bits(s, 1) for s in sets], pa.int64()), pa.array([bits(s, 0) for s in sets], pa.int64()),
        pa.array([[int(h[i] >> np.uint64(32)) - (1 << 32 if h[i] >> np.uint64(63) else 0) for i in s[:op3_lines._prefix(len(s), 4, 5)]] for s in sets], pa.list_(pa.int32()))],
        ["key", "n", "bm1", "bm2", "prefix"])
    want = {(b, a) for a, s in enumerate(sets) for b, t in enumerate(sets) if a < b and (open_[a] or open_[b]) and 9 * len(set(s) & set(t)) >= 4 * (len(s) + len(t))}
    assert len(want) > 50
    for buckets in (1, 13):
        packed = pa.Table.from_batches(op3_lines._packed(buckets)([lines.slice(0, 30), lines.slice(30)]))
        got = set()
        for k in set(packed["bucket"].to_pylist()):
            out = op3_lines._shared(4, 5, op3_lines.HOT)(packed.filter(pa.compute.equal(packed["bucket"], k)))
            assert out["key_0"].null_count == 0
            got |= set(zip(out["key"].to_pylist(), out["key_0"].to_pylist()))
        assert want <= got and all(a > b and (open_[a] or open_[b]) for a, b in got)


def test_texts_are_read_once_per_verification(spark, monkeypatch):
    """The words of all candidates are written once, not once a turn."""
    seen, staged = [], op3_lines.staged
    monkeypatch.setattr(op3_lines, "staged", lambda df, what: seen.append(what) or staged(df, what))
    docs = spark.createDataFrame(near_copies(random.Random(1)), "doc_id long, text string").withColumn("rid", row_key("doc_id", "text"))
    op3_lines.kept_lines(docs, crowd=2).collect()
    for what in ("lines-settled", "lines-also"):
        assert seen.count(what + "-words") == 1
    assert max(seen.count(what) for what in ("lines-settled", "lines-also")) > 1
