"""Connected components of an edge table, by alternating stars: no graph, component or list of links leaves the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import delete, staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest of the node and its neighbours."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them. Edges come with u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least.withColumnRenamed("u", "w"), F.col("u") == F.col("w"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, path: str) -> DataFrame:
    """(node, root) for each node of edges (u, v), root being the smallest node of its component and its own root.

    Each round is written below path, so a lost executor costs one round. Rounds grow with the logarithm of a component's size; each round
    brings links nearer to the smallest node, so they end."""
    now = staged(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{path}/0")
    mark, after, k = None, None, 0
    while after is None or mark != after:
        k, mark = k + 1, after
        seen = Observation()
        # Counted and summed by the job that writes the round.
        now = staged(_small_star(_large_star(now)).observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")), f"{path}/{k}")
        after = seen.get
        if k > 1:
            delete(edges.sparkSession, f"{path}/{k - 2}")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionAll(stars.select(F.col("root").alias("node"), "root").distinct())
