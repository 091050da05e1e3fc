"""Registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.llm import (
    alignment,
    chunk_dedup,
    html_main,
    lm,
    near_dups,
    packing,
    pii,
    quality,
    segmentation,
    suffix_dedup,
    topk,
    toxicity,
    whitening,
)
from fareflow.llm.common import read_table

# Folder whose ``public_tokenizers`` package names the vocabulary files.
TOKENIZERS = os.environ.get("PUBLIC_TOKENIZERS", "/opt")


def tokenizer_path(name: str, root: str = TOKENIZERS) -> str:
    """Path of a public tokenizer file; falls back to the folder ``root``."""
    try:
        import public_tokenizers
        return public_tokenizers.path(name)
    except ImportError:
        return os.path.join(root, "tokenizers", name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_removed_words")


def op2_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.dedup(read_table(spark, sf_dir, "documents"))


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.main_text(read_table(spark, sf_dir, "pages"))


def op4_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segmentation.sample(read_table(spark, sf_dir, "documents"),
                               tokenizer_path("piece_bpe_32k.model"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(read_table(spark, sf_dir, "documents"))


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantize(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return topk.top_k(vectors.filter(F.col("vec_id") % 50 == 0), vectors)


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(read_table(spark, sf_dir, "documents")).drop("node")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(read_table(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.col("found")
    count = lambda k: F.size(F.filter(found, lambda s: s["kind"] == k)).cast("long")
    base = pii.joined(F.filter(found, lambda s: s["base"]))
    return pii.find(read_table(spark, sf_dir, "documents")).select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in ("email", "ip", "card", "phone")],
        F.sha2(base, 256).alias("base_sha256"), pii.joined(found).alias("spans"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"),
                                  tokenizer_path("word_bpe_49k.json"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read_table(spark, sf_dir, "documents"),
                           tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_chunk_dedup": op2_chunk_dedup,
    "op3_main_text": op3_main_text,
    "op4_segmentation": op4_segmentation,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_top_k": op6_top_k,
    "op7_ngram_join": op7_ngram_join,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_pii": op9_pii,
    "op10_packing": op10_packing,
    "op11_alignment": op11_alignment,
    "op12_whitening": op12_whitening,
    "op13_toxicity": op13_toxicity,
}

ORACLES = {
    "op1_quality_rules": r"""
        WITH d AS (
          SELECT doc_id, source, row_number() OVER () AS r, coalesce(text, '') AS t, text FROM documents),
        w AS (
          SELECT r, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
                 list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
          FROM d),
        u AS (SELECT r, unnest(ws) AS wd, generate_subscripts(ws, 1) AS i FROM w),
        k AS (
          SELECT r, i, wd || ' ' || lead(wd, 1) OVER o || ' ' || lead(wd, 2) OVER o AS k
          FROM u WINDOW o AS (PARTITION BY r ORDER BY i)),
        c AS (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS n FROM k WHERE k IS NOT NULL),
        rep AS (
          SELECT r, count(DISTINCT i + o) AS n_repeat_words
          FROM c, (VALUES (0), (1), (2)) AS x(o) WHERE n > 1 GROUP BY r),
        base AS (
          SELECT d.r, doc_id, len(ws)::BIGINT AS n_words,
                 coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
                 length(regexp_replace(w.t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                 (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
                 coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
          FROM d JOIN w USING (r) LEFT JOIN rep USING (r)),
        l AS (
          SELECT r, source, text, trim(unnest(string_split(regexp_replace(lower(t),
                 '[\x20\x09\x0B-\x0D]+', ' ', 'g'), chr(10))), ' ') AS line FROM d),
        hosts AS (SELECT source, count(DISTINCT t) AS n FROM d GROUP BY source),
        often AS (
          SELECT source, line, count(DISTINCT text) AS n FROM l WHERE line <> '' GROUP BY source, line),
        f AS (
          SELECT o.source, o.line FROM often o JOIN hosts h ON o.source IS NOT DISTINCT FROM h.source
          WHERE o.n >= 20 AND (100 * o.n > 2 * h.n OR o.n > 100)),
        x AS (
          SELECT l.r, sum(length(l.line) - length(replace(l.line, ' ', '')) + 1)::BIGINT AS lost
          FROM l JOIN f ON l.line = f.line AND l.source IS NOT DISTINCT FROM f.source GROUP BY l.r)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
               n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
               NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
                 AND NOT coalesce(lost, 0) > 0.5 * n_words AS kept,
               coalesce(lost, 0)::BIGINT AS n_removed_words
        FROM base LEFT JOIN x USING (r)""",
    "op6_top_k": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
          FROM embeddings
          WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
          SELECT a.vec_id AS query_id, b.vec_id,
                 CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
          FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
        r AS (
          SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
          FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
}
