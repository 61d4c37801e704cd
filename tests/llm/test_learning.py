"""What the learned operators learn: held-out accuracy, mixtures, ranking,
gain over the base, and the paths that small corpora seldom take."""

import random

import pytest

from growlytics.llm import op1_lm, op2_language, op4_quality
from growlytics.llm.common import table
from tests.conftest import ORACLE_SF, SMOKE


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    from growlytics.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)


def test_held_out_languages(spark):
    docs = table(spark, ORACLE_SF, "documents")
    truth = {r.doc_id: (r.lang, r.text) for r in docs.collect()}
    rows = [r for r in op2_language.identify(docs).collect() if r.held_out and r.lang_pred != "und"]
    assert len(rows) > 100 and sum(truth[r.doc_id][0] == r.lang_pred for r in rows) / len(rows) > 0.97


def test_document_in_two_languages(spark):
    docs = table(spark, ORACLE_SF, "documents")
    model = op2_language.learn(docs)
    by = {}
    for r in docs.where("length(text) between 800 and 4000").collect():
        by.setdefault(r.lang, r.text[:800])
    a, b = sorted(by)[:2]
    rows = [(1, by[a] + "\n" + by[b]), (2, by[a]), (3, by[b] + " " + by[b] + "\n" + by[a])]
    got = {r.doc_id: r for r in op2_language.identify(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    share = {i: dict(zip(model[0], r.shares)) for i, r in got.items()}
    assert got[2].lang_pred == a and share[2][a] > 0.9
    assert min(share[1][a], share[1][b]) > 0.25 and share[1][a] + share[1][b] > 0.9
    assert got[3].lang_pred == b and share[3][a] > 0.15


def test_equal_texts_get_equal_languages_and_no_training_rows(spark):
    rows = [(i, "la casa de la noche", "es" if i % 2 else "it") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = op2_language.identify(df).collect()
    assert len({(r.lang_pred, r.score) for r in got}) == 1 and got[0].lang_pred in ("es", "it")
    none = op2_language.identify(df.withColumn("lang", df.lang.cast("string")).where("lang is null").unionByName(df.selectExpr("doc_id", "text", "cast(null as string) lang"))).collect()
    assert len(none) == 40 and len({(r.lang_pred, r.score) for r in none}) == 1


def test_quality_ranks_held_out_rows(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    quality = {r.doc_id: r.quality for r in labels.collect()}
    rows = [(r.score, quality[r.doc_id]) for r in op4_quality.score(docs, labels).collect() if r.held_out and quality.get(r.doc_id) is not None]
    good, bad = [s for s, q in rows if q], [s for s, q in rows if not q]
    auc = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert len(rows) > 100 and auc > 0.9


def test_quality_of_repeated_rows_with_unequal_labels(spark):
    rng = random.Random(1)
    rows = [(i, "Same text of every row." if i < 60 else " ".join(rng.choices(["ab", "cd", "ef"], k=9))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)] + [(i, 1) for i in range(10)], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in op4_quality.score(docs, labels).collect()}
    same = {got[i] for i in range(60)}
    assert len(got) == 120 and max(same) - min(same) < 1e-9 and 0.2 < max(same) < 0.8


@pytest.mark.parametrize("share", [op1_lm.SHARE, 0.01])
def test_model_beats_the_base_on_held_out_rows(spark, share):
    """With a large ``share`` most words come by the shuffled join."""
    docs = table(spark, ORACLE_SF, "documents") if share == op1_lm.SHARE else table(spark, SMOKE, "documents")
    rows = op1_lm.scores(docs, share=share).collect()
    held = [r for r in rows if r.held_out and r.n_tokens > 1]
    n = sum(r.n_tokens for r in held)
    assert n > 1000
    if share == op1_lm.SHARE:
        assert sum(r.score - r.base_score for r in held) / n > 0.03
    else:  # the join gives every word the same counts as the table that is sent
        sent = {r.doc_id: r for r in op1_lm.scores(docs).collect()}
        assert all(r.n_known == sent[r.doc_id].n_known and abs(r.base_score - sent[r.doc_id].base_score) < 1e-6 * max(1, abs(r.base_score)) for r in rows)
