"""One query per operator over its whole table; importing this module registers them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadwitness.llm import (
    attention_mil,
    bestfit_packing,
    bpe_automaton,
    cross_polytope,
    exact_dedup,
    jaccard_join,
    label_propagation,
    line_dedup,
    naive_bayes,
    source_divergence,
    token_files,
    whitening,
    winnowing,
)
from loadwitness.llm.common import ORACLES, QUERIES, query, table

__all__ = ["ORACLES", "QUERIES"]


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query(
    "op1_exact_dedup",
    """
    WITH t AS (
        SELECT doc_id, length(coalesce(text, '')) AS points,
            sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
        FROM documents
    ), g AS (
        SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id,
            count(*) OVER (PARTITION BY text_sha256) AS group_size
        FROM t
    )
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
    """,
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


@query("op2_bestfit_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit_packing.pack(table(spark, sf_dir, "documents"), tokenizer_file(), capacity=2048, end_id=0)


@query(
    "op3_line_dedup",
    """
    WITH l AS (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
            unnest(range(len(string_split(text, chr(10))))) AS pos
        FROM documents
    ), t AS (
        SELECT *, lead(line, 1) OVER w AS second, lead(line, 2) OVER w AS third
        FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
    ), o AS (
        SELECT doc_id, pos, row_number() OVER (PARTITION BY line, second, third ORDER BY doc_id, pos) AS nth
        FROM t WHERE third IS NOT NULL AND line || second || third <> ''
    ), c AS (
        SELECT DISTINCT doc_id, pos + k AS pos FROM o CROSS JOIN (VALUES (0), (1), (2)) AS s(k) WHERE nth > 1
    ), k AS (
        SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text FROM l ANTI JOIN c USING (doc_id, pos) GROUP BY doc_id
    ), r AS (
        SELECT doc_id, count(*)::INT AS lines_removed FROM c GROUP BY doc_id
    )
    SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
        coalesce(r.lines_removed, 0) AS lines_removed
    FROM documents d LEFT JOIN k USING (doc_id) LEFT JOIN r USING (doc_id)
    """,
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op4_bpe_automaton")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_automaton.encoding_digest(table(spark, sf_dir, "documents"), tokenizer_file())


@query("op5_label_propagation")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_propagation.shard_by_text(table(spark, sf_dir, "documents"), shards=8)


@query("op6_jaccard_join")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.jaccard_join(table(spark, sf_dir, "documents"), words=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id", "class_size", "component_size")


@query("op7_cross_polytope")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_polytope.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query("op8_attention_mil")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return attention_mil.score(docs, attention_mil.fit(docs, table(spark, sf_dir, "labels")))


@query("op9_naive_bayes")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return naive_bayes.identify(docs, naive_bayes.fit(docs))


@query("op10_token_files")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), tokenizer_file(), end_id=1)


@query(
    "op11_source_divergence",
    r"""
    WITH d AS (
        SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
            regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
        FROM documents
    ), o AS (
        SELECT lang, source, r, unnest(terms) AS term FROM d
    ), k AS (
        SELECT lang, term, count(*) OVER (PARTITION BY lang) AS v
        FROM (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= 10)
    ), g AS (
        SELECT DISTINCT lang, source FROM d
    ), c AS (
        SELECT lang, source, term, count(*) AS c FROM o GROUP BY lang, source, term
    ), a AS (
        SELECT g.lang, g.source, k.term, k.v, coalesce(c.c, 0) AS c,
            sum(coalesce(c.c, 0)) OVER (PARTITION BY g.lang, g.source) AS n,
            sum(coalesce(c.c, 0)) OVER (PARTITION BY g.lang, k.term) AS lc,
            sum(coalesce(c.c, 0)) OVER (PARTITION BY g.lang) AS ln
        FROM g JOIN k ON g.lang = k.lang
        LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
    ), s AS (
        SELECT lang, source, term, c, 1 + (1000000000::HUGEINT * (c + 2)) // (n + 2 * v) AS p,
            1 + (1000000000::HUGEINT * (lc + 2)) // (ln + 2 * v) AS q
        FROM a
    ), f AS (
        SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
        FROM s x JOIN s y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
    ), u AS (
        SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(f.value, 0)::BIGINT AS value
        FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
        LEFT JOIN f ON f.lang = x.lang AND f.source = x.source AND f.item = y.source
        UNION ALL
        SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM s WHERE c > 0 AND p > q
    ), z AS (
        SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM u
    )
    SELECT * FROM z WHERE part = 'pair' OR rank <= 10
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.divergence(table(spark, sf_dir, "documents"))


@query(
    "op12_winnowing",
    r"""
    WITH d AS (
        SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM documents
    ), b AS (
        SELECT item_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM benchmark
    ), w AS (
        SELECT DISTINCT item_id, least(len(words), 10) AS n, array_to_string(words[i:i + least(len(words), 10) - 1], ' ') AS win
        FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 8, 2))) AS i FROM b WHERE len(words) > 0)
    ), g AS (
        SELECT r, i, n, array_to_string(words[i:i + n - 1], ' ') AS win
        FROM (
            SELECT r, words, n, unnest(range(1, len(words) - n + 2)) AS i
            FROM d CROSS JOIN (SELECT DISTINCT n FROM w) WHERE len(words) >= n
        )
    ), h AS (
        SELECT g.r, g.i, g.n, w.item_id FROM g JOIN w ON g.n = w.n AND g.win = w.win
    ), c AS (
        SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM h) GROUP BY r
    ), t AS (
        SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
        FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY r
    )
    SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(listed, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
    FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


@query("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"), components=4)
    return found.withColumn("deviation", F.col("deviation").cast("bigint"))
