"""Tokenizing, conversation repair and collocations against plain versions."""

import hashlib
import random

import pytest

from growlytics.llm import op11_bpe, op12_conversations, op13_collocations
from growlytics.llm.common import table
from tests.conftest import ORACLE_SF, SMOKE
from tests.llm import brute

P = pytest.importorskip("public_tokenizers")
BPE = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    from growlytics.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)


# ------------------------------------------------------------------ tokens


def odd_texts():
    rng = random.Random(5)
    signs = "ab s'tremdlvLE  \t\n é9½ß!<|>'_ 中１\x85​🙂ǅ٣\r　"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    return [*texts, "", None, "it's we'll I'D 'tis x'ss <|endoftext|> 's <|endoftext|><|endoftext|>", "<|endoftext|>", " " * 700, "a" * 1500 + "b" * 2500,
            "!?" * 900, "x'y" * 300, "\n\n \n", "🙂" * 400, texts[3], texts[3], "no\x00byte", "ᲊ𓑠"]


def test_ids_equal_the_public_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BPE)
    texts = odd_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = op11_bpe.decoded(op11_bpe.encoded(docs, BPE), BPE).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == want and r.decoded == library.decode(want, skip_special_tokens=False), r.doc_id


def test_long_words_by_heap_equal_the_scan():
    v = op11_bpe.Vocabulary(BPE)
    rng = random.Random(2)
    for _ in range(300):
        parts = [v.first[rng.choice(b"ther inga\xc3\xa9")] for _ in range(rng.randint(0, 400))]
        assert v._scanned(list(parts)) == v._queued(list(parts))


def test_decoding_of_any_ids(spark):
    rows = spark.createDataFrame([(1, [50256, 40]), (2, [-1, 99999999]), (3, []), (4, None), (5, [187]), (6, [None, 40])], "k int, ids array<int>")
    got = {r.k: r.decoded for r in op11_bpe.decoded(rows, BPE).collect()}
    assert got[1].startswith("<|endoftext|>") and got[2] == got[3] == "" and got[4] is None and "�" in got[5] and got[6] == got[1][13:]


def test_tokens_extra_columns_and_empty_table(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    docs = spark.createDataFrame([(1, "a b", "x", "y"), (None, None, None, None)], "doc_id long, text string, DOC_ID string, TEXT string")
    spark.conf.set("spark.sql.caseSensitive", "false")
    got = op11_bpe.digests(docs, BPE).collect()
    assert {(r.doc_id, r.n_tokens) for r in got} == {(1, 2), (None, 0)}
    assert {r.decoded_sha256 for r in got} == {hashlib.sha256(x).hexdigest() for x in (b"a b", b"")}
    assert op11_bpe.digests(docs.limit(0), BPE).count() == 0


def test_not_a_byte_level_vocabulary():
    with pytest.raises(ValueError):
        op11_bpe.Vocabulary(P.path("word_bpe_49k.json"))


# ----------------------------------------------------------- conversations


def talks():
    rng = random.Random(11)
    rows = []
    for conv in range(260):
        for turn in range(rng.choice([1, 2, 4, 8, 30])):
            role = rng.choice(["user", "assistant"] * 5 + ["system", "tool", None, "", "Sys", "agent"]) if rng.random() < 0.5 else "ua"[turn % 2] + "x"
            text = rng.choice(["Yes.", "No", "Why?", "ok!", "", " \n", None, "a. \t", "é. ", "x" * rng.randint(1, 50) + "."])
            rows.append((conv, turn * rng.choice([1, 1, 1, 2]) if rng.random() < 0.97 else None, role, text))
    for turn in range(900):  # one long conversation
        rows.append((1000, turn, ["user", "assistant", "user", "system"][rng.randrange(4)], f"t{turn % 300}" + "."[: rng.randrange(2)]))
    rows += [(1001, i, "user", "hello.") for i in range(120)] + [(1002, 5, "user", "same.")] * 50 + [(None, None, "user", "a."), (None, 1, None, None), (None, None, "user", "a.")]
    rows += [(2000 + i, 0, "user", "x.") for i in range(60)] + rows[:40]
    rng.shuffle(rows)
    return rows


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


@pytest.mark.parametrize("chunk", [1, 7, 64, 4096])
def test_conversations_equal_brute_force(spark, chunk):
    rows = talks()
    spark.conf.set("spark.sql.caseSensitive", "true")
    df = spark.createDataFrame([(*r, "z", 1) for r in rows], "conv_id long, turn long, role string, text string, ROLE string, cost int")
    spark.conf.set("spark.sql.caseSensitive", "false")
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in op12_conversations.digests(df, chunk).collect()}
    assert got == brute.conversations(rows)


@pytest.mark.parametrize("case,most", [("mixed", 3), ("alike", op12_conversations.PASSES + 1)])
def test_rank_convergence_takes_few_passes(spark, case, most):
    rng = random.Random(6)
    if case == "mixed":  # system rows and rows without faults in any order: paths meet
        rows = [(1, i, rng.choice(["user", "assistant", "assistant"]), f"t{i}.") for i in range(3000)]
    else:  # two readings that cost alike all the way
        rows = [(1, i, ("user", "assistant", "user")[i % 3], f"t{i}" + "."[: i % 2]) for i in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    from growlytics.llm.common import staged

    cut = staged(op12_conversations.pieces(op12_conversations.facts(op12_conversations.rows_of(df)), 64), "test-pieces")
    state, passes = op12_conversations.stitched(cut)
    assert state.count() >= 40 and passes <= most


def test_given_conversations(spark):
    df = spark.read.parquet(f"{ORACLE_SF}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in op12_conversations.digests(df).collect()}
    assert got == brute.conversations(rows)


def test_no_conversations(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert op12_conversations.digests(df).count() == 0


# ----------------------------------------------------------------- phrases


def sayings():
    rng = random.Random(4)
    words = ["New", "york", "city", "the", "of", "a", "é", "İ", "x"]
    rows = []
    for i in range(300):
        text = " ".join(rng.choices(words, [3, 3, 2, 6, 4, 3, 1, 1, 1], k=rng.randint(0, 30)))
        rows.append((text.replace(" the ", rng.choice([" the ", ", the ", "\tthe. ", "\nthe ", "  the "])), rng.choice(["en", "en", "fr", None, "und", ""])))
    return rows + [(None, "en"), ("", "de"), ("one two three " * 400, "es"), ("!?..", None), rows[0], rows[0]]


@pytest.mark.parametrize("least,top,share", [(10, 2000, 50), (3, 20, 90), (1, 50, 10)])
def test_phrases_equal_brute_force(spark, least, top, share, monkeypatch):
    monkeypatch.setattr(op13_collocations, "PARTS", 50)
    monkeypatch.setattr(op13_collocations, "SAMPLE", 0.5)  # frequent pairs are split
    df = spark.createDataFrame([(t, lg, "q", 1) for t, lg in sayings()], "text string, lang string, phrase string, a int").repartition(5)
    got = {tuple(r) for r in op13_collocations.collocations(df, least, top, share).collect()}
    assert got == set(brute.phrases(sayings(), least, top, share))


def test_given_phrases(spark):
    df = table(spark, SMOKE, "documents")
    got = {tuple(r) for r in op13_collocations.collocations(df).collect()}
    assert got == set(brute.phrases([(r.text, r.lang) for r in df.collect()]))


def test_no_phrases(spark):
    assert op13_collocations.collocations(spark.createDataFrame([], "text string, lang string")).count() == 0
    assert op13_collocations.collocations(spark.createDataFrame([("...", "en")], "text string, lang string")).count() == 0


def test_large_counts_are_exact(spark):
    n = 9_000_000_000_000
    f = spark.createDataFrame([(1, 0, 0, 0, 0, 3 * n), (1, 5, 0, 0, 1, n), (1, 6, 0, 0, 1, n - 7), (1, 5, 6, 0, 2, n - 9)], "lid long, w1 long, w2 long, w3 long, k int, f long")
    from growlytics.llm.common import staged

    r = op13_collocations.scored(staged(f, "test-counts")).first()
    a = n - 9
    assert (r.a, r.l, r.r, r.score) == (a, n, n - 7, 10**6 * a * a // (n * (n - 7)))
