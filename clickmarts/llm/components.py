"""Connected components of an edge table, all in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmarts.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, component): for every end of an edge, the smallest node it is joined to.

    ``edges`` has columns ``a`` and ``b`` of one sortable type; loops, repeated and null
    ends are left out.  Alternates two steps until nothing changes: every node hangs
    its larger neighbours on its smallest neighbour, then its smaller ones.  Each round is
    a partly aggregated minimum and a join by node, written to the shared folder; the
    number of rounds grows with the logarithm of the nodes."""
    edges = edges.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct()
    edges = materialize(edges, "edges")
    state = None
    while True:
        both = edges.union(edges.select("u", "v"))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        large = (both.join(least, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u"))
                 .where("v <> u").distinct())
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        joined = large.join(least, "v")
        small = (joined.where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
                 .union(least.select("v", F.col("m").alias("u"))).distinct())
        edges = materialize(small, "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("v").alias("node"), F.col("u").alias("component")).union(
        edges.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
