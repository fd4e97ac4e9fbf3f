"""Connected components by alternating large and small stars; every round is a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from returnsmith.session import settle


def _sign(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) of every node in a link; the label is the smallest node of its component.

    Null ends and links of a node with itself say nothing. Empty in, empty out. A node with many links is one
    side of a join that adaptive execution can split; sums of it are combined before the shuffle.
    """
    edges = settle(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                   .filter("u is not null and v is not null and u <> v").distinct(), "edges")
    before = None
    while (now := _sign(edges)) != before and now[0]:
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        edges = settle(small, "edges")
    return edges.groupBy("u").agg(F.min("v").alias("label")).select(F.col("u").alias("node"), "label").unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
