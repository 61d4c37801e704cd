"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from growlytics.llm import op1_lm, op2_language, op3_lines, op4_quality, op5_mixing, op6_ngram_join, op7_topk, op8_substrings, op9_html, op10_decontaminate, op11_bpe, op12_conversations, op13_collocations
from growlytics.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def deco(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn

    return deco


@query()
def op1_lm_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document."""
    return op1_lm.scores(table(spark, sf_dir, "documents"))


@query()
def op2_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by mixture inference."""
    return op2_language.identify(table(spark, sf_dir, "documents"))


@query()
def op4_quality_fourier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    return op4_quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op5_mixing_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    placed = op5_mixing.placements(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "source_size", "target", "taken", "source", "placed")


@query(
    """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
               WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
         s AS (SELECT q.vec_id AS query_id, p.vec_id, list_dot_product(q.e, p.e)::BIGINT AS score
               FROM v q JOIN v p ON q.vec_id <> p.vec_id AND len(q.e) = len(p.e) WHERE q.vec_id % 50 = 0),
         r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """
)
def op7_topk_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best neighbours of each query vector."""
    return op7_topk.search(table(spark, sf_dir, "embeddings"))


@query()
def op9_html_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return op9_html.main_text(table(spark, sf_dir, "pages"))


@query()
def op10_decontaminate_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in every document."""
    return op10_decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    r"""
    WITH d AS (SELECT *, row_number() OVER () AS r FROM documents),
         u AS (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL),
         l AS (SELECT doc_id, text, generate_subscripts(string_split(text, chr(10)), 1) AS line, unnest(string_split(text, chr(10))) AS x FROM u),
         w AS (SELECT *, list_sort(list_distinct(list_filter(string_split_regex(x, '[\x20\x09-\x0D]+'), lambda y: y <> ''))) AS s FROM l),
         f AS (SELECT *, len(s) AS n, CASE WHEN len(s) > 0 THEN row_number() OVER (ORDER BY len(s) = 0, doc_id NULLS LAST, hash(text), line) END AS id FROM w),
         g AS (SELECT s, n, min(id) AS id FROM f WHERE n > 0 GROUP BY s, n),
         t AS (SELECT id, n, unnest(s) AS tok FROM g),
         c AS (SELECT tok, count(*) AS c FROM t GROUP BY tok),
         o AS (SELECT id, n, tok, row_number() OVER (PARTITION BY id ORDER BY c, tok) AS pos FROM t JOIN c USING (tok)),
         p AS (SELECT * FROM o WHERE pos <= n - (4 * n + 4) // 5 + 1),
         q AS (SELECT DISTINCT a.id, b.id AS id_0 FROM p a JOIN p b ON a.tok = b.tok AND b.id < a.id AND greatest(a.n, b.n) * 4 <= least(a.n, b.n) * 5),
         m AS (SELECT DISTINCT q.id FROM q JOIN g a ON a.id = q.id JOIN g b ON b.id = q.id_0
               WHERE len(list_intersect(a.s, b.s)) * 9 >= 4 * (a.n + b.n)),
         k AS (SELECT id FROM g WHERE id NOT IN (SELECT id FROM m)),
         j AS (SELECT f.doc_id, f.text, count(f.id) AS n_lines, count(f.id) - count(k.id) AS n_removed,
                      coalesce(string_agg(f.x, chr(10) ORDER BY f.line) FILTER (WHERE f.n = 0 OR k.id IS NOT NULL), '') AS kept
               FROM f LEFT JOIN k ON k.id = f.id GROUP BY f.doc_id, f.text)
    SELECT d.doc_id, coalesce(j.n_lines, 0) AS n_lines, coalesce(j.n_removed, 0) AS n_removed, j.kept AS text
    FROM d LEFT JOIN j ON j.doc_id IS NOT DISTINCT FROM d.doc_id AND j.text = d.text
    """
)
def op3_line_dedup_setjoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that repeat earlier ones."""
    out = op3_lines.deduplicated(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("dedup_lines").alias("n_lines"), F.col("dedup_removed").alias("n_removed"), "text")


@query()
def op6_ngram_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document."""
    return op6_ngram_join.classes(table(spark, sf_dir, "documents"))


@query()
def op8_substring_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated windows."""
    out = op8_substrings.deduplicated(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query()
def op11_bpe_rank_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document to token ids and back."""
    import public_tokenizers

    return op11_bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query()
def op12_conversation_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, least audit and repair of every conversation."""
    return op12_conversations.digests(table(spark, sf_dir, "conversations"))


@query(
    r"""
    WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
         q AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
         o AS (SELECT lang, unnest(list_transform(range(1, len(w) + 1), lambda i: {'a': w[i], 'b': w[i + 1], 'c': w[i + 2]}), recursive := true) FROM q),
         g AS (SELECT lang, a AS phrase, 1 AS k, NULL AS head, NULL AS tail, NULL AS head2, NULL AS tail2 FROM o
               UNION ALL SELECT lang, a || ' ' || b, 2, a, b, NULL, NULL FROM o WHERE b IS NOT NULL
               UNION ALL SELECT lang, a || ' ' || b || ' ' || c, 3, a, b || ' ' || c, a || ' ' || b, c FROM o WHERE c IS NOT NULL),
         f AS (SELECT lang, phrase, k, min(head) AS head, min(tail) AS tail, min(head2) AS head2, min(tail2) AS tail2, count(*) AS a FROM g GROUP BY ALL),
         n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
         c AS (SELECT * FROM f WHERE k > 1 AND a >= 10),
         cuts AS (SELECT c.lang, c.phrase, c.k, c.a, 1 AS cut, l.a AS l, r.a AS r FROM c JOIN f l ON l.lang = c.lang AND l.phrase = c.head JOIN f r ON r.lang = c.lang AND r.phrase = c.tail
                  UNION ALL SELECT c.lang, c.phrase, c.k, c.a, 2, l.a, r.a FROM c JOIN f l ON l.lang = c.lang AND l.phrase = c.head2 JOIN f r ON r.lang = c.lang AND r.phrase = c.tail2 WHERE c.k = 3),
         s AS (SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cuts),
         m AS (SELECT lang, phrase, k, a, min({'score': score, 'cut': cut, 'l': l, 'r': r}) AS low FROM s GROUP BY ALL),
         x AS (SELECT lang, head2 AS phrase, a FROM c WHERE k = 3 UNION ALL SELECT lang, tail, a FROM c WHERE k = 3),
         y AS (SELECT lang, phrase, max(a) AS around FROM x GROUP BY ALL),
         z AS (SELECT m.*, row_number() OVER (PARTITION BY m.lang ORDER BY low.score DESC, m.a DESC, m.phrase) AS rank
               FROM m LEFT JOIN y ON y.lang = m.lang AND y.phrase = m.phrase AND m.k = 2 WHERE y.around IS NULL OR 100 * y.around < 50 * m.a)
    SELECT z.lang, rank, phrase, a, low.l AS l, low.r AS r, n.n, low.score AS score FROM z JOIN n ON n.lang = z.lang WHERE rank <= 2000
    """
)
def op13_collocations_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest phrases of each language."""
    return op13_collocations.collocations(table(spark, sf_dir, "documents"))
