"""Line dedup: the rows of its steps grow with the lines, not with the square of a group of near copies."""

import random

import numpy as np
import pytest

from growlytics.llm import op3_lines
from growlytics.llm.common import row_key
from tests.llm import brute


def kept(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("rid", row_key("doc_id", "text"))
    left = {(r.rid, r.line) for r in op3_lines.kept_lines(docs, **options).collect()}
    ids = {r.doc_id: r.rid for r in docs.collect()}
    return ["\n".join(x for i, x in enumerate(t.split("\n")) if (ids[d], i) in left) for d, t in rows]


@pytest.fixture
def counts(monkeypatch):
    """The most rows of each staged step."""
    seen, staged = {}, op3_lines.staged

    def counted(df, what):
        out = staged(df, what)
        seen[what] = max(seen.get(what, 0), out.count())
        return out

    monkeypatch.setattr(op3_lines, "staged", counted)
    return seen


def test_a_group_without_a_common_head_makes_no_square(spark, counts):
    """All 150 lines are similar, no min-hash crowd settles them: 11175 pairs."""
    form = [f"w{i}" for i in range(20)]
    rows = [(i, " ".join([*form[:i % 20], f"x{i}", *form[i % 20 + 1:]])) for i in range(150)]
    assert kept(spark, rows, crowd=10**6) == brute.lines_kept(rows) == [rows[0][1], *[""] * 149]
    assert max(counts.values()) <= 150 * 5 * op3_lines.FEW, counts  # five words of each line are in its prefix


def near_misses(rng, size=60):
    """Long lines around one form, most just below the threshold to each other; some copies of earlier ones."""
    form, lines = [f"f{i}" for i in range(80)], []
    for k in range(size):
        if lines and rng.random() < 0.2:
            line = list(rng.choice(lines[len(lines) // 2:]))
            line[rng.randrange(80)] = f"c{k}"
        else:
            line = list(form)
            for i in rng.sample(range(80), rng.randint(8, 12)):
                line[i] = f"x{rng.randrange(30)}"
        lines.append(line)
    return [(k, " ".join(x)) for k, x in enumerate(lines)]


@pytest.mark.parametrize("few, hot", [(1, op3_lines.HOT), (1, 3), (4, op3_lines.HOT)])
def test_lines_beyond_the_first_candidates_are_searched_for(spark, counts, few, hot):
    rows = near_misses(random.Random(3))
    want = brute.lines_kept(rows)
    assert 10 < want.count("") < 50
    assert kept(spark, rows, crowd=10**6, few=few, hot=hot) == want
    if few == 1:
        assert counts["lines-searched"] > 0, counts  # matches that are not among the first candidates


@pytest.mark.parametrize("block", [1, 50, 1 << 18])
def test_a_bucket_gives_the_earliest_few_and_says_where_more_are(monkeypatch, block):
    monkeypatch.setattr(op3_lines, "BLOCK", block)
    import pyarrow as pa

    rng = np.random.default_rng(4)
    n = 40
    key = rng.permutation(n)
    open_ = rng.random(n) < 0.7
    toks = [sorted({7, int(t)}) for t in rng.integers(8, 12, n)]
    lines = pa.RecordBatch.from_arrays([
        pa.array(key), pa.array(np.where(open_, 12, -12).astype(np.int32)), pa.array(np.zeros(n, np.int64)), pa.array(np.zeros(n, np.int64)),
        pa.array(toks, pa.list_(pa.int32()))], ["key", "n", "bm1", "bm2", "prefix"])
    packed = pa.Table.from_batches(op3_lines._packed(1)([lines]))
    every = op3_lines._shared(4, 5, 1 << 14)(packed)
    pairs = {}
    for a, b in zip(every["key"].to_pylist(), every["key_0"].to_pylist()):
        if open_[list(key).index(a)]:
            pairs.setdefault(a, set()).add(b)
    for few in (1, 3, 100):
        out = op3_lines._shared(4, 5, 1 << 14, few)(packed).to_pylist()
        assert sorted((r["key"], r["key_0"]) for r in out if r["key_0"] is not None) == sorted((a, b) for a, of in pairs.items() for b in sorted(of)[:few])
        assert sorted((r["key"], r["tok"]) for r in out if r["key_0"] is None) == sorted((a, t) for a, of in pairs.items() if len(of) > few for t in toks[list(key).index(a)])
    out = op3_lines._shared(4, 5, 20, 3)(packed).to_pylist()  # word 7 has 40 postings
    assert {(int(k), 7) for k, o in zip(key, open_) if o} <= {(r["key"], r["tok"]) for r in out if r["key_0"] is None}
