"""Connected components of an edge table by alternating large-star and small-star steps.

Each step re-hangs the edges of a node on the smallest neighbour, so edges never
multiply; nodes with very many neighbours are handled by map-side combined minima and
a join whose hot keys Spark can split. Every round is written to the shared
folder, which also cuts the lineage. No part of the graph reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewkit.llm.common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.join(least, "u").filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = down.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` of every node of ``edges`` (long columns ``u, v``); a component's id is its least node."""
    spark = edges.sparkSession
    current = staged(spark, edges.select("u", "v").filter("u <> v").distinct(), "edges")
    state = None
    while True:
        after = staged(spark, _small_star(_large_star(current)), "edges")
        found = after.agg(F.count("*").alias("n"),
                          F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (found["n"], found["h"]) == state:
            break
        state, current = (found["n"], found["h"]), after
    stars = after.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
