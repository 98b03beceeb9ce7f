"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatsieve.llm.tables import settled


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
    )


def components(links: DataFrame) -> DataFrame:
    """(node, class_id) for every node of ``links`` (a, b); class_id is the smallest node
    of its component. Each round is two aggregates and two equi joins on the links that
    are left; a hot node is combined before the shuffle. The driver sees a count and a
    checksum per round."""
    a, b = F.col("a").cast("long"), F.col("b").cast("long")
    edges = links.where(a != b).select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).distinct()
    edges = settled(edges, "edges")
    before = _state(edges)
    while True:
        both = edges.select(F.col("v").alias("x"), F.col("u").alias("y")).union(edges.select("u", "v"))
        low = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = both.where("y > x").join(low, "x").select(F.col("y").alias("v"), F.col("m").alias("u"))
        large = large.where("v != u").distinct()
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).where("v != u")
        edges = settled(small.union(low.select("v", F.col("m").alias("u"))).distinct(), "edges")
        now = _state(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("u").alias("node")).distinct()
    return edges.select(F.col("v").alias("node"), F.col("u").alias("class_id")).union(
        roots.select("node", F.col("node").alias("class_id"))
    )
