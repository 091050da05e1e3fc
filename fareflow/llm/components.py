"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import keep_table


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` (the smallest node of the component) for edges ``a, b`` (long).

    Alternates two steps until nothing changes: every node's larger neighbours
    are linked to the smallest node it sees, then its smaller ones.  Each round
    is a grouped minimum and a join, so no component is ever held in one task;
    the edge list is written to the shared folder between rounds.
    """
    e = (edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
         .filter("u <> v").distinct())
    e, mark, turn = keep_table(e, "edges"), None, 0
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())
        first = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(first, "u")
                 .select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
                         .alias("x")).select("x.u", "x.v").filter("u <> v").distinct())
        turn += 1
        e = keep_table(small, f"edges{turn}")
        now = e.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("u", "v")),
                                                  F.lit(0).cast("long"))).first()
        if now == mark:
            break
        mark = now
    # Every node but a root is now linked to its root alone.
    return (e.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
