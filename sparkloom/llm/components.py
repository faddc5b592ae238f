"""Connected components by alternating large-star and small-star.

Every round is two grouped minima and two equi-joins, written to the shared folder. A node with
very many neighbours is a skewed join key, which adaptive execution splits; neighbours are never
gathered into one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import discard, saved


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    rest = e.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionAll(low.select("u", F.col("m").alias("v"))).distinct()


def _print_of(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for each node that has an edge to another; root is its component's smallest node.

    Self-links, null ends and repeated edges are ignored; no edges give an empty result.
    """
    spark = edges.sparkSession
    tidy = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    now, path = saved(tidy, "edges")
    seen = _print_of(now)
    while seen[0]:
        mid, mid_path = saved(_large_star(now), "large")
        new, new_path = saved(_small_star(mid), "small")
        discard(spark, mid_path)
        discard(spark, path)
        now, path, last = new, new_path, seen
        seen = _print_of(now)
        if seen == last:
            break
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
