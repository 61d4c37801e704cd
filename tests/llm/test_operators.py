"""The operators against plain versions, on rows that hold the awkward cases:
nulls, blanks, long texts, ties, repeated rows, extra columns, empty tables."""

import math
import random
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from growlytics.llm.common import row_key
from growlytics.llm import (op1_lm, op2_language, op3_lines, op4_quality, op5_mixing, op6_ngram_join, op7_topk, op8_substrings,
                            op9_html, op10_decontaminate)
from tests.conftest import SMOKE
from tests.llm import brute
from tools.oracle_check import rows_of

SCHEMA = "doc_id long, text string, lang string, source string, DOC_ID string, size int, score string"


def corpus():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(4, 60))) + ("\n" + " ".join(rng.choices(vocabulary, k=8))) * rng.randint(0, 2) for _ in range(40)]
    for t in texts[:8]:  # near copies: one word in twenty changed
        texts.append(" ".join(w if i % 20 else "zz" for i, w in enumerate(t.split(" "))))
    texts += [texts[1], texts[1] + "\n" + texts[2], "", " \n ", None, "!!! 123", "the\x0bend \x85 odd", " ".join(rng.choices(vocabulary, k=5000))]
    rows = [(i, t, "en" if i % 3 else "fr", f"s{i % 4}" if i % 7 else None, "x", 1, "y") for i, t in enumerate(texts)]
    return [*rows, rows[5], (None, texts[3], None, None, None, None, None), (None, texts[3], None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    from growlytics.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.caseSensitive", "true")
    df = spark.createDataFrame(corpus(), SCHEMA)
    spark.conf.set("spark.sql.caseSensitive", "false")
    return df


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")


def pairs():
    return [(r[0], r[1]) for r in corpus()]


def test_language_model(docs, empty):
    got = op1_lm.scores(docs).collect()
    tok = [((t or "").encode().lower().split() + [b""], brute.held_out(i, 10)) for i, t in pairs()]
    count = Counter(w for ws, h in tok if not h for w in ws)
    n, v = sum(count.values()), len(count)
    want = sorted((len(ws), sum(count[w] > 0 for w in ws), h, sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)) for ws, h in tok)
    have = sorted((r.n_tokens, r.n_known, r.held_out, r.base_score) for r in got)
    assert [x[:3] for x in have] == [x[:3] for x in want] and all(abs(a[3] - b[3]) < 1e-6 for a, b in zip(have, want))
    assert all(r.train_tokens == n and r.score < 0 for r in got)
    assert op1_lm.scores(empty).count() == 0


def test_language_model_is_normalised():
    import numpy as np

    p = op1_lm.start(np.full(op1_lm.SYMBOLS, 1 / op1_lm.SYMBOLS))
    ctx = np.arange(op1_lm.CONTEXT)[None, :].repeat(op1_lm.SYMBOLS, axis=0)
    assert abs((10 ** op1_lm.log10_softmax(p, ctx, np.arange(op1_lm.SYMBOLS))).sum() - 1) < 1e-5


def test_language(docs, empty):
    got = {r.doc_id: r for r in op2_language.identify(docs).collect()}
    rows = corpus()
    for i, t, *_ in rows:
        if i is not None:
            assert (got[i].lang_pred == "und") == (not any(c.isalpha() for c in t or "")) and 0 <= got[i].score <= 1
    assert op2_language.identify(empty).count() == 0
    assert op2_language.keep_identified(docs).columns == docs.columns


@pytest.mark.parametrize("crowd", [2, 16])
def test_lines_of_one_form(spark, crowd):
    """Groups of near copies, chains of them and lines that are only nearly
    similar enough: every way by which a line is settled."""
    rng = random.Random(9)
    rows = []
    for g in range(12):
        form = [f"g{g}w{i}" for i in range(20)]
        for k in range(25):
            line = list(form)
            for i in rng.sample(range(20), rng.choice([0, 1, 1, 2, 3])):
                line[i] = f"x{rng.randrange(6)}"
            rows.append((len(rows), " ".join(line) + "\n" + " ".join(rng.choices([f"c{i}" for i in range(8)], k=5))))
    rng.shuffle(rows)
    df = spark.createDataFrame([*rows, *rows[:5]], "doc_id long, text string")
    docs = df.withColumn("rid", row_key("doc_id", "text"))
    left = {(r.rid, r.line) for r in op3_lines.kept_lines(docs.select("doc_id", "rid", "text"), crowd=crowd).collect()}
    ids = {r.doc_id: r.rid for r in docs.collect()}
    want = dict(zip(rows, brute.lines_kept(rows)))
    for (d, t), kept in want.items():
        assert "\n".join(x for i, x in enumerate(t.split("\n")) if (ids[d], i) in left) == kept


def test_lines(docs, empty):
    distinct = list(dict.fromkeys(pairs()))
    order = sorted(distinct, key=lambda x: (x[0] is None, x[0] or 0))
    want = dict(zip(order, brute.lines_kept(order)))
    got = op3_lines.deduplicated(docs)
    assert got.columns == [*docs.columns, "dedup_lines", "dedup_removed"]
    assert Counter((r[0], r[1]) for r in got.collect()) == Counter((i, want[i, t]) for i, t in pairs())
    assert op3_lines.deduplicated(empty).count() == 0


def test_quality(spark, docs, empty):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(50)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    got = op4_quality.score(docs, labels).collect()
    assert len(got) == len(corpus()) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert op4_quality.score(empty, labels).count() == 0
    assert {r.score for r in op4_quality.score(docs, labels.limit(0)).collect()} == {0.5}


def test_isotonic():
    import numpy as np

    fit = op4_quality.isotonic(np.array([1, 1, 0, 2, 1.0]), np.array([1, 0, 0, 2, 0.5]))
    assert np.allclose(fit, [0.5, 0.5, 2 / 3, 5 / 6, 5 / 6])


@pytest.mark.parametrize("options", [{}, {"block_words": 50, "shard_words": 200}, {"block_words": 7, "shard_words": 30}])
def test_mixing(docs, empty, options):
    got = op5_mixing.placements(docs, **options).collect()
    size = {s: sum(len(brute.WORD.findall(r[1] or "")) for r in corpus() if r[3] == s) for s in {r[3] for r in corpus()}}
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    budget, open_, target = 1.5 * sum(size.values()), set(order), {}
    while True:  # fill, cap, share again
        level = (budget - sum(target.values())) / sum(weight[s] for s in open_)
        full = [s for s in open_ if level * weight[s] > 2 * size[s]]
        if not full:
            break
        for s in full:
            target[s] = 2.0 * size[s]
            open_.remove(s)
    target |= {s: level * weight[s] for s in open_}
    for s in order:
        own = [r for r in got if r.source == s]
        assert all(abs(r.target - target[s]) < 1e-6 and r.source_size == size[s] and r.taken <= 2 * r.size for r in own)
        assert abs(sum(r.taken for r in own) - target[s]) <= 1.5  # a repeated row in the last block may leave a word
        assert all(sum(p.words for p in r.placed) == r.taken for r in own)
    if options:  # blocks and shards are really many
        assert len({p.shard for r in got for p in r.placed}) > 5
    again = op5_mixing.placements(docs, **options).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    mixed = op5_mixing.mix(docs, **options).collect()
    assert sum(r.mix_words for r in mixed) == sum(r.taken for r in got)
    assert all(len(brute.WORD.findall(r[1])) == r.mix_words for r in mixed)
    assert op5_mixing.placements(empty).count() == 0


def test_splitting_tree_is_exact():
    import numpy as np

    counts = np.array([7, 0, 30])
    leaf = op5_mixing._descend(counts, 5, 1)
    seen = [set(), set(), set()]
    for i in range(5):
        start, n = leaf(i)
        for s in range(3):
            mine = set(range(start[s], start[s] + n[s]))
            assert not mine & seen[s]
            seen[s] |= mine
    assert [len(x) for x in seen] == counts.tolist()


def test_ngram_join(docs, empty):
    got = op6_ngram_join.classes(docs)
    want = brute.jaccard_classes(pairs())
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in got.collect()) == Counter((i, c, n) for (i, _), (c, n) in zip(pairs(), want))
    kept = op6_ngram_join.representatives(docs)
    assert kept.columns == docs.columns and kept.count() == len({c for c, _ in want})
    assert op6_ngram_join.classes(empty).count() == 0


@pytest.mark.parametrize("options", [{}, {"block": 16, "wide": 24}])
def test_ngram_join_in_a_crowd_of_one_form(spark, docs, options):
    """60 texts share 220 words (0.786 similar); partners share 3 more (0.805)."""
    form = [f"t{i}" for i in range(220)]
    rows = [(i, " ".join([*form, *[f"p{i // 2}x{k}" for k in range(3)], *[f"o{i}x{k}" for k in range(27)]])) for i in range(60)]
    got = op6_ngram_join.classes(spark.createDataFrame(rows, "doc_id long, text string"), n=1, **options).collect()
    want = brute.jaccard_classes(rows, n=1)
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in got) == [(i, c, k) for (i, _), (c, k) in zip(rows, want)]
    assert {r.n_links for r in got} == {1}


def test_top_k(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([0.1, -0.2, 0.5, 3.0]) for _ in range(4)]) for i in range(260)]
    rows += [(400, None), (450, [1.0, None, 0.0, 0.0]), (500, [1.0, float("nan"), 0.0, 0.0]), (550, [1.0, 2.0]), (None, [1.0] * 4), (600, []), rows[7]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = Counter(tuple(r) for r in op7_topk.search(df, block=64).collect())
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    want = Counter()
    for i, q in good:
        if i % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(q, p)), j) for j, p in good if j != i and len(p) == len(q))[:5]
            want.update((i, k + 1, j, -s) for k, (s, j) in enumerate(best))
    assert got == want
    assert op7_topk.search(df.limit(0)).count() == 0


def test_substrings(docs, empty):
    got = op8_substrings.deduplicated(docs, shard_words=2000).collect()
    want = brute.windows_removed(pairs())
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == Counter((i, *w) for (i, _), w in zip(pairs(), want))
    assert op8_substrings.deduplicated(empty).count() == 0


def test_fm_index():
    import numpy as np

    text = np.array([1, 2, 1, 2, 3, 0, 2, 1, 2, 0, 0])
    index = op8_substrings.FMIndex(text, 4)
    length, lo, hi = index.statistics(text, np.array([5, 9]), np.array([0, 6]), 3)
    assert length.tolist()[:5] == [3, 3, 3, 2, 1]
    assert sorted(index.sa[lo[0]:hi[0]].tolist()) == [0]  # 1 2 1
    assert sorted(index.sa[lo[6]:hi[6]].tolist()) == [1, 6]  # 2 1 2
    assert sorted(index.sa[lo[7]:hi[7]].tolist()) == [0, 2, 7]  # 1 2


def test_suffixes_are_sorted_once(monkeypatch):
    """Few words are sorted again: only those of suffixes that are alike so far."""
    import numpy as np

    rng = np.random.default_rng(5)
    texts = [rng.integers(0, s, n) for s, n in ((2, 1), (2, 70), (3, 200), (900, 500))] + [np.ones(64, np.int64), np.zeros(9, np.int64)]
    for text in texts:
        want = sorted(range(len(text)), key=lambda i: text[i:].tolist())
        assert op8_substrings.FMIndex(text, int(text.max()) + 1).sa.tolist() == want
    pieces = [rng.integers(1, 3000, 16) for _ in range(300)]
    text = np.concatenate([np.append(p, 0) for p in [*pieces, *[np.append(p[1:], 7) for p in pieces[:100]]]])
    real, lengths = np.argsort, []
    monkeypatch.setattr(np, "argsort", lambda x, *a, **k: lengths.append(len(x)) or real(x, *a, **k))
    op8_substrings.FMIndex(text, 3000)
    assert sum(lengths) < 3 * len(text)


@pytest.mark.parametrize("window", [5, 6, 13])
def test_runs_of_one_anchor(window):
    """A run ends where the first of a window's least 5-word runs is another."""
    from growlytics.llm.common import Tokens, rolled

    rng = random.Random(window)
    for letters in ("ab", "abcdefgh"):
        texts = [" ".join(rng.choices(letters, k=rng.randrange(60))) for _ in range(40)]
        want = []
        for i, t in enumerate(texts):
            g = rolled(Tokens([t]).hashes(), op8_substrings.GRAM).tolist()
            last = None
            for k in range(len(t.split()) - window + 1):
                at = min(range(k, k + window - op8_substrings.GRAM + 1), key=g.__getitem__)
                if at == last:
                    want[-1][2] += 1
                else:
                    want.append([i, k, 1, g[at]])
                last = at
        t = Tokens(texts)
        of, first, n, anchor = op8_substrings._runs(t, window)
        assert [list(x) for x in zip(of.tolist(), (first - t.offsets[of]).tolist(), n.tolist(), anchor.view("uint64").tolist())] == want


def test_lists_as_arrays(spark):
    """Lists of numbers reach a function as arrays, nulls as None."""
    from growlytics.llm.common import appended

    df = spark.createDataFrame([(1, [3, 4]), (2, None), (3, []), (4, [5])], "i long, v array<int>").coalesce(1)

    def fn(lists):
        return [[None if x is None else int(x.sum()) for x in lists]]

    assert {r.i: r.s for r in appended(df, ["v"], fn, {"s": "bigint"}, ("v",), arrays=("v",)).collect()} == {1: 7, 2: None, 3: 0, 4: 5}


PAGE = """<!doctype html><html><head><title>T</title><script>if (a<b) "</p>"</script></head><body><header>Site</header><nav><a>Menu</a></nav>
<div class="cookie-notice">Accept</div><article><h1>Head &amp; line</h1><p><b>Bold<br>two<p>Next&nbsp;  one</p><div class="share">Share me</div>
<ul><li>a<li>b</ul><section id="comments"><p>Nice!</p></section><form><p>x</p></form></article><aside>Side</aside><footer>&copy;</footer></body></html>"""


def test_html(spark):
    text = "Head & line\n\nBold two\n\nNext one\n\na\n\nb"
    rows = [(1, "https://a.example/x", PAGE), (1, "https://a.example/x", PAGE), (2, None, None), (3, "u", ""), (4, "https://b.example", "<p>alone"), (None, "", "<article>")]
    got = op9_html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert Counter((r.page_id, r.text, r.n_chars) for r in got) == Counter([(1, text, len(text))] * 2 + [(2, "", 0), (3, "", 0), (4, "alone", 5), (None, "", 0)])


def test_style_tree_removes_what_repeats(spark):
    page = "<article><p>Text {0} of its own {0}</p><div class='k'>The same box</div></article>"
    rows = [(i, "https://a.example/x", page.format(i)) for i in range(20)]
    got = op9_html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert all(r.text == f"Text {r.page_id} of its own {r.page_id}" for r in got)


def test_words_alone_do_not_drop_article_text(spark):
    pages = ["<main><article class='post category-social has-comments'><p>Whole text</p></article></main>",
             "<body><div class='with-sidebar'><article><p>Whole text</p></article></div><nav>Menu</nav></body>",
             "<div class='alert'>Whole text</div>", "<p>Let <math><mi>x</mi></math> be <object>this</object></p><xmp>a <b> &amp; c</xmp>"]
    want = ["Whole text"] * 3 + ["Let x be this\n\na <b> &amp; c"]
    page = "<article><p>Text {0} of its own, the longer part</p><section id='discussion'><p>Point {0}</p></section><div class='related-work'>Work {0}</div><p class='alert'>Mind {0}</p><div class='share'>Share</div></article>"
    rows = [(i, f"https://h{i}.example", p) for i, p in enumerate(pages)] + [(10 + i, "https://a.example", page.format(i)) for i in range(20)]
    got = {r.page_id: r.text for r in op9_html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in range(4)] == want
    assert all(got[10 + i] == f"Text {i} of its own, the longer part\n\nPoint {i}\n\nWork {i}\n\nMind {i}" for i in range(20))


def test_articles_are_found_by_what_they_hold(spark):
    pages = ["<body><form id='aspnetForm'><header>Site</header><article><p>Whole text</p></article><input value='x'></form></body>",
             "<main><h1>X</h1><p>A long text that is the page</p><article><p>small card</p></article></main>",
             "<body><div><article><p>Whole text of the article</p></article></div><footer>Foot</footer></body>",
             "<body><p>The page has a text of its own here</p><form action='/find'><label>Find</label>words</form></body>",
             "<main><article><p>One whole card</p></article><article><p>Two whole cards</p></article></main>"]
    want = ["Whole text", "X\n\nA long text that is the page\n\nsmall card", "Whole text of the article", "The page has a text of its own here", "One whole card\n\nTwo whole cards"]
    rows = [(i, f"https://h{i}.example", p, "a", "b") for i, p in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, host string")
    got = {r.page_id: r.text for r in op9_html.main_text(df).collect()}
    assert [got[i] for i in range(len(pages))] == want
    assert op9_html.main_text(df.limit(0)).count() == 0


def test_small_hosts_and_depth():
    import time

    deep = "<div>" * 8000 + "core" + "</div>" * 8000
    t = time.process_time()
    assert op9_html.extract(deep) == "core" and len(op9_html.style_nodes(op9_html.parse(deep))) == 8000
    assert time.process_time() - t < 3
    # paths of the same element in the same place are one, whatever the page
    a, b = (op9_html.style_nodes(op9_html.parse(f"<body><div class='k'>{x}</div><div class='k'><p>same</p></div></body>")) for x in "xy")
    assert set(a) == set(b) and len(a) == 1 and a != b


def test_importance_is_smoothed(spark):
    page = "<article><p>Text {0} of its own {0}</p><div class='k'>The same box</div></article>"
    for n, kept in ((2, True), (5, True), (12, False)):
        rows = [(i, "https://a.example/x", page.format(i)) for i in range(n)]
        got = op9_html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
        assert all(("The same box" in r.text) == kept and f"Text {r.page_id} of" in r.text for r in got)


def test_decontamination(spark, docs):
    item = "A train leaves Paris at 9 and Mary waits for 30 minutes until Mary sees the train from Paris arrive"
    other = "so: A train leaves London at 7 and Anna waits for 45 minutes until Anna sees the train from London arrive !"
    bench = spark.createDataFrame([(1, item), (2, None), (3, "too short"), (4, "seven words are fewer than a window"), (5, "we saw Mary near Mary again with Mary today")], "item_id long, text string")
    rows = [(1, "before. " + item + " after"), (2, other), (3, "train leaves at 9"), (4, None), (5, "Seven words are: fewer than a window!"), (None, item), (6, "we saw Anna near Bella again with Anna today"), (7, "we saw Anna near Anna again with Anna today")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for part_words in (op10_decontaminate.PART_WORDS, 5):
        got = {r.doc_id: r.item_ids for r in op10_decontaminate.contamination(df, bench, part_words=part_words).collect()}
        assert got == {1: [1], 2: [1], 3: [], 4: [], 5: [4], None: [1], 6: [], 7: [5]}
    assert op10_decontaminate.clean(docs, bench.limit(0)).count() == len(corpus())


def test_decontamination_needs_most_of_an_item(spark):
    item = "A baker in Lyon sells 240 loaves at the end of the day and keeps one dozen for the children of the village school"
    german = "heute sieht der Hund und die Katze in der Stadt"
    bench = spark.createDataFrame([(1, item), (2, german)], "item_id long, text string")
    clean = ["We walked home at the end of the day and keeps one thing in mind: rest. " + "Nothing else of it is here. " * 40,
             "Oft liegt der Brief und die Karte in der Tasche. Dort stehen der Baum und die Bank in der Sonne.",
             "we said heute sieht der Mann und die Frau in der Kirche nichts"]
    leaks = ["so, " + item.replace("Lyon", "Nice").replace("240", "31"), item.replace("village", "town"), item.replace("end of", "very end of"), "und " + german]
    df = spark.createDataFrame(list(enumerate(clean + leaks)), "doc_id long, text string")
    got = {r.doc_id: (r.contaminated, r.item_ids) for r in op10_decontaminate.contamination(df, bench).collect()}
    assert got == {0: (False, []), 1: (False, []), 2: (False, []), 3: (True, [1]), 4: (True, [1]), 5: (True, [1]), 6: (True, [2])}
    assert {r.doc_id for r in op10_decontaminate.clean(df, bench).collect()} == {0, 1, 2}


def test_queries_agree_with_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    for name in ("op3_line_dedup_setjoin", "op7_topk_norm_buckets"):
        df = E.queries()[name](spark, SMOKE)
        cur = con.execute(E.oracle_sql()[name])
        assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of([d[0] for d in cur.description], cur.fetchall())


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    columns, count = docs.columns, docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMOKE).cache()
        assert docs.columns == columns and 0 < docs.count() <= count
        count = docs.count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMOKE).columns[:5] == columns
