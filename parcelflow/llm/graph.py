"""Connected components of a link table, by alternating large and small stars.

Every pass hangs the neighbours of a node under the smallest of them.  Minima are taken
inside each task before the shuffle and are written before they are joined back, so the
join is one of two stored tables whose large partitions Spark can split: a node may have
any number of links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.session import work_dir


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component) for the nodes of ``links`` (columns a, b: long).

    A component is named by its smallest node.  Links of a node to itself and null ends
    are left out; repeated links do not matter.
    """
    spark, folder = links.sparkSession, work_dir(links.sparkSession, "components")
    step = 0

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}-{step}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}-{step}")

    def hung(pairs: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
        """Pairs (u, v) with the least of u and all its v as ``m``, and the table of these."""
        least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        least = stored(least, name)
        return pairs.join(least, "u"), least

    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while True:
        step += 1
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        joined, _ = hung(both, "large")
        edges = stored(joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "middle")
        joined, least = hung(edges, "small")
        moved = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        if moved.isEmpty():  # every node has one link, to a smaller node: stars, unless a centre hangs elsewhere
            chained = edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi")
            if chained.isEmpty():
                break
        edges = stored(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
