"""The operators of this subpackage over their whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyseq.llm import chat_windows, divergence, html_main, lattice_score, license_scan, mixing, packing, prefix_trie, quality_rules, ranker, simhash, sphere_filters, token_spans

PACK_TOKENIZER = "word_bpe_49k.json"
RANK_TOKENIZER = "byte_bpe_50k.tiktoken"
PIECE_VOCABULARY = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_: Column, folds: int = 5) -> Column:
    """crc32 of an id as text, modulo ``folds``: one fold is held out of every fit."""
    return F.crc32(id_.cast("string").cast("binary")) % folds


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.license_scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", *[F.col(f"licenses.{c}").alias(c) for c in license_scan.FIELDS])


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(PACK_TOKENIZER))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_table(_table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality_rules.fit(docs, _table(spark, sf_dir, "labels"))
    rows = quality_rules.judge(docs, rules)
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    by = F.col("rejected_by")
    return rows.select("doc_id", *[F.col(quality_rules.PREFIX + c).alias(c) for c in counts], (by == -1).alias("base_failed"), (by == 0).alias("kept"), by.alias("rejected_by"))


def op5_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.explode(F.array(F.struct(F.lit(0).cast("long").alias("turn"), F.lit("user").alias("role")), F.struct(F.lit(1).cast("long").alias("turn"), F.lit("assistant").alias("role")))).alias("t"))
    odd = odd.select("conv_id", "t.turn", "t.role", F.lit("</s>[INST] ok [/INST]").alias("text"))
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(odd)
    tokenizer = public_tokenizers.path(RANK_TOKENIZER), public_tokenizers.PATTERN
    return chat_windows.digest_turns(turns, tokenizer)


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_main.extract_pages(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    ranking = ranker.fit(docs, _table(spark, sf_dir, "labels"), keep=fold(F.col("__label_id")) != 0)
    rows = ranker.score(docs, ranking)
    return rows.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= ranker.DECISION).cast("int").alias("predicted"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_spans.token_counts(docs, public_tokenizers.path(RANK_TOKENIZER), public_tokenizers.PATTERN)


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sphere_filters.embedding_duplicates(_table(spark, sf_dir, "embeddings"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op12_lattice_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return lattice_score.score_texts(docs, fold(F.col("doc_id"), 7) == 2, public_tokenizers.path(PIECE_VOCABULARY))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(_table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_license_scan,
        op2_best_fit_packing,
        op3_source_mixing,
        op4_quality_rules,
        op5_chat_windows,
        op6_html_extraction,
        op7_simhash_near_dedup,
        op8_quality_classifier,
        op9_token_counts,
        op10_embedding_near_dedup,
        op11_source_divergence,
        op12_lattice_score,
        op13_prefix_trie,
    )
    return {f.__name__: f for f in own}


OP10_SQL = """
WITH RECURSIVE usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.95
), reach(a, b) AS (
    SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (SELECT a, min(b) AS low FROM reach GROUP BY a), counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(low, vec_id)) AS kept
FROM embeddings LEFT JOIN counts ON counts.a = vec_id LEFT JOIN least ON least.a = vec_id
"""


OP11_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), words AS (SELECT doc, lang, source, unnest(terms) AS term FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM words GROUP BY ALL),
kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 30),
kinds AS (SELECT DISTINCT lang, source FROM docs),
grid AS (SELECT lang, source, term, coalesce(c.n, 0)::HUGEINT AS n, k.n AS lang_n FROM kinds JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
shares AS (
    SELECT lang, source, term, n, 1 + (1000000000 * (n + 5)) // (sum(n) OVER w + 5 * count(*) OVER w)::HUGEINT AS p,
        1 + (1000000000 * (lang_n + 5)) // (sum(lang_n) OVER w + 5 * count(*) OVER w)::HUGEINT AS q
    FROM grid WINDOW w AS (PARTITION BY lang, source)
), sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM kinds a JOIN kinds b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
    UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q
), ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""

OP13_SQL = r"""
WITH RECURSIVE turns AS (
    SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos, {'r': coalesce(role, ''), 't': coalesce(text, '')} AS said
    FROM conversations WHERE conv_id IS NOT NULL
), own AS (SELECT c, list(said ORDER BY pos) AS says FROM turns GROUP BY c),
crc(c, k, v) AS (  -- one bit a step; a byte enters before its first bit
    SELECT c, 0, xor(4294967295, ascii(c::VARCHAR))::BIGINT FROM own
    UNION ALL SELECT c, k + 1, xor(CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, CASE WHEN k % 8 = 7 AND k < 8 * length(c::VARCHAR) - 1 THEN ascii(substr(c::VARCHAR, k // 8 + 2, 1)) ELSE 0 END)::BIGINT
    FROM crc WHERE k < 8 * length(c::VARCHAR)
), shared AS (SELECT c, (4294967295 - v) % 4 AS h FROM crc WHERE k = 8 * length(c::VARCHAR)),
built AS (SELECT o.c, list_concat(coalesce(b.says[:h], []), o.says[h + 1:]) AS says FROM own o JOIN shared USING (c) LEFT JOIN own b ON b.c = o.c - o.c % 20),
member AS (SELECT c, d, says[:d] AS node, d = len(says) AS ends FROM built, unnest(range(len(says) + 1)) AS t(d)),
nodes AS (
    SELECT node, d AS depth, min(c) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256,
        (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(node[d].t, '[^\x20\x09-\x0D]+')) END AS own_saved
    FROM member GROUP BY node, d
), kids AS (SELECT node[:depth - 1] AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
full_nodes AS (SELECT n.*, coalesce(k.n, 0) AS n_children, p.conv_id AS parent_conv_id FROM nodes n LEFT JOIN kids k ON k.node = n.node LEFT JOIN nodes p ON n.depth > 0 AND p.node = n.node[:n.depth - 1]),
above AS (SELECT node[:u] AS node, n_children, own_saved FROM full_nodes, unnest(range(depth + 1)) AS t(u)),
sums AS (SELECT node, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(own_saved)::BIGINT AS saved_tokens FROM above GROUP BY node)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 FROM full_nodes JOIN sums USING (node)
"""


def oracle_sql() -> dict[str, str]:
    return {"op10_embedding_near_dedup": OP10_SQL, "op11_source_divergence": OP11_SQL, "op13_prefix_trie": OP13_SQL}
