"""Retrieval job (JOB-13 / AGG-16): rebuild the vector store, then search it.

The store is rebuilt with drop semantics (write beside, then swap), laid
out so that scans read only the id and vector columns; the search is the
bounded-query-set top-k of ``operators.aggregates.top_k_similar``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.operators.aggregates import top_k_similar
from fareflow.operators.loads import write_swap


def rebuild_store(vectors: DataFrame, path: str, id_col: str = "vec_id",
                  vec_col: str = "embedding") -> str:
    """Drop and rebuild the store at ``path`` from the given vectors.

    Rows with a NULL or empty vector are not stored (they cannot be scored)."""
    clean = vectors.filter(F.col(vec_col).isNotNull() & (F.size(vec_col) > 0))
    return write_swap(clean, path)


def search(spark: SparkSession, path: str, queries: DataFrame, k: int,
           query_id: str = "query_id", query_vec: str = "qv",
           id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Top-``k`` stored vectors by cosine similarity for each query vector."""
    store = spark.read.parquet(path).select(id_col, vec_col)
    return top_k_similar(store, queries, k, id_col, vec_col, query_id, query_vec)
