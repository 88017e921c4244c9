"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adpulse.llm.common import staged

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long); ``component`` is the least node of a component.

    Alternates large-star and small-star steps (each node's larger neighbours, then its smaller ones, are tied to its
    least neighbour) until nothing changes: logarithmically many rounds, each one aggregation and one join, in which a
    node with many neighbours is combined map-side and split by adaptive execution.
    """
    links = staged(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    before = None
    for _ in range(MAX_ROUNDS):
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.when(F.col("b") == F.col("low"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("low").alias("b"))
        links = staged(small.where("a <> b").distinct(), "edges")
        now = tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
