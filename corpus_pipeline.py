"""Training-corpus pipeline: STAGES applied to ``documents`` one after another.

Every stage reads what its predecessor kept (written as Parquet and read
again).  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.llm import near_dups, pii, quality, queries, suffix_dedup
from fareflow.llm.common import keep_table, read_table
from fareflow.llm.packing import pack_documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without the lines that are common on their host."""
    return quality.apply_rules(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_dups.keep_one(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without byte strings that a smaller document id has already.

    Characters that lose a byte are dropped; a document of which nothing is
    left stays with an empty text.
    """
    out = suffix_dedup.dedup(docs, with_text=True)
    kept = F.col("kept_text")
    fields = {c: F.col("row")[c] for c in docs.columns if c != "text"}
    fields["text"] = kept
    fields["n_chars"] = F.length(kept).cast(docs.schema["n_chars"].dataType)
    return out.select(*[fields[c].alias(c) for c in docs.columns])


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return pii.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, queries.tokenizer_path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("ngram_join", ngram_join),
    ("suffix_array_dedup", suffix_array_dedup),
    ("redact_pii", redact_pii),
    ("best_fit_packing", best_fit_packing),
]

# Suffix sorting and tokenizing cannot be written in SQL; tests/llm holds a
# brute-force version of the stages.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
