"""Exact top-k inner-product search by columnar branch and bound (operator 6).

Vectors are laid out vertically (one row per dimension).  For each query the
dimensions are visited in blocks, largest query weight first; partial scores
are accumulated block by block.  What is left of a score is at most the
product of the two remaining norms (the remaining mass), which gives every
candidate a lower and an upper bound; candidates whose upper bound is below
the k-th best lower bound are dropped and the survivors are compacted before
the next block.  The result is exact.

In Spark the work is a grid: queries in row blocks, vectors in column blocks,
each cell of bounded size; a cell returns at most k rows per query and the
cells' results are merged with a final top-k per query.

Defined results: null vectors and vectors holding null or non-finite
components are left out (as query and as candidate); shorter vectors count as
padded with zeros; rows with the same id are all candidates of other ids, and
no row is a candidate for its own id; a repeated query row is asked once; an
empty table gives an empty result.  Scores are exact 64-bit integers.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

OUT = "query_id long, vec_id long, score long"
DIM_BLOCK = 16
QUERIES_PER_CELL = 1024
VECTORS_PER_CELL = 16_384


def quantize(df: DataFrame, id_col: str, vec_col: str, scale: float = 256.0) -> DataFrame:
    """``vec_id, v array<long>``: floor(scale * x) of every usable vector."""
    v = F.col(vec_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return (df.filter(v.isNotNull() & ~bad & F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("vec_id"),
                    F.transform(v, lambda x: F.floor(x * F.lit(scale))).alias("v")))


def _matrix(col: pd.Series, dims: int) -> np.ndarray:
    m = np.zeros((len(col), dims), np.int64)
    for i, v in enumerate(col):
        m[i, :len(v)] = v
    return m


def branch_and_bound(q: np.ndarray, own: int, columns: np.ndarray, ids: np.ndarray, k: int,
                     block: int = DIM_BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Top-k (positions, scores) for one query over vertical ``columns`` (dims x n).

    Sound for ties: only candidates strictly below the k-th lower bound go.
    """
    alive = np.flatnonzero(ids != own)
    order = np.argsort(-np.abs(q), kind="stable")
    score = np.zeros(len(alive), np.int64)
    # Squared norms fall block by block; they bound what is still to come.
    mass = (columns[:, alive].astype(np.float64) ** 2).sum(axis=0)
    q_mass = float((q.astype(np.float64) ** 2).sum())
    for at in range(0, len(order), block):
        dims = order[at:at + block]
        part = columns[dims][:, alive]
        score += q[dims] @ part
        f = part.astype(np.float64)
        mass = np.maximum(mass - np.einsum("ij,ij->j", f, f), 0.0)
        q_mass = max(q_mass - float((q[dims].astype(np.float64) ** 2).sum()), 0.0)
        if at + block >= len(order) or len(alive) <= k:
            continue
        rest = np.sqrt(mass * q_mass) * (1 + 1e-9) + 1.0
        floor = np.partition(score - rest, len(alive) - k)[len(alive) - k]
        keep = score + rest >= floor
        if not keep.all():
            alive, score, mass = alive[keep], score[keep], mass[keep]
    best = np.lexsort((ids[alive], -score))[:k]
    return alive[best], score[best]


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 5,
          queries_per_cell: int = QUERIES_PER_CELL,
          vectors_per_cell: int = VECTORS_PER_CELL) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best candidates of each query.

    Both inputs are ``vec_id, v array<long>`` (see ``quantize``).
    """
    # Two counts size the grid; nothing else depends on them.
    rows = max(1, -(-queries.count() // queries_per_cell))
    cols = max(1, -(-vectors.count() // vectors_per_cell))
    spread = lambda n, at, of: F.pmod(F.xxhash64(at, F.col("v")), F.lit(n)).cast("int").alias(of)
    q = (queries.select("vec_id", "v").distinct().select("vec_id", "v", spread(rows, F.col("vec_id"), "r"))
         .withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(cols - 1)))))
    c = (vectors.select("vec_id", "v", spread(cols, F.col("vec_id"), "c"))
         .withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(rows - 1)))))

    def cell(qs: pd.DataFrame, vs: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        if qs.empty or vs.empty:
            return empty
        dims = int(max(qs["v"].map(len).max(), vs["v"].map(len).max()))
        columns = np.ascontiguousarray(_matrix(vs["v"], dims).T)
        ids = vs["vec_id"].to_numpy()
        found = []
        for qid, qv in zip(qs["vec_id"].to_numpy(), _matrix(qs["v"], dims), strict=True):
            at, score = branch_and_bound(qv, int(qid), columns, ids, k)
            found.append(pd.DataFrame({"query_id": qid, "vec_id": ids[at], "score": score}))
        return pd.concat(found)

    cells = q.groupBy("r", "c").cogroup(c.groupBy("r", "c")).applyInPandas(cell, OUT)
    best = W.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return (cells.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
