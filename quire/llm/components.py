"""Connected components of an edge table, by rounds of joins.

Alternating large-star and small-star steps (Kiveris et al., "Connected
Components in MapReduce and Beyond"): each keeps components and shortens
paths, until every node points at the smallest node of its component. Each
round is written, so lineage stays short and lost executors cost one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.session import materialize


def _least(pairs: DataFrame) -> DataFrame:
    """(u, v) with, for each u, the least of u and its v."""
    return pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(u, v) edges to (node, root): the smallest node of the component, for
    every node that has an edge to another."""
    now = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Large star: larger neighbours point at the least neighbour.
        large = materialize(both.join(materialize(_least(both)), "u").where("v > u")
                            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        # Small star: a node and its smaller neighbours point at the least.
        small = large.join(materialize(_least(large)), "u")
        now = materialize(small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                          .unionByName(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        after = now.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()
        if after == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = after
