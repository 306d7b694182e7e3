"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.common import saved


def _mark(edges: DataFrame):
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], row["h"]


def _star(spark: SparkSession, edges: DataFrame, large: bool) -> DataFrame:
    """One star step on links u > v; returns links u > v again, each once.

    large: every neighbour above a node is linked to the node's least neighbour.
    small: a node and its neighbours below it are linked to the least of them.
    The least neighbour is a partial aggregate, so a hub sends one row per task for it; the join
    back is a plain equi-join of two tables whose hot key Spark's skew handling can split.
    """
    flipped = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    ends = edges.unionByName(flipped) if large else edges
    least = saved(spark, ends.groupBy("u").agg(F.min("v").alias("m")), "least")
    joined = ends.join(least, "u").withColumn("m", F.least("m", "u"))
    if large:
        linked = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        linked = joined.select(F.explode(F.array("v", "u")).alias("u"), F.col("m").alias("v"))
    return linked.filter("u > v").distinct()


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """node, component (the least node reachable) for every node that has a link.

    ``links``: two long columns, either order, repeats and self links allowed. Each round is
    written to the shared folder; the number of rounds grows with the logarithm of the longest
    path, and the loop ends when a round changes nothing. No links give no rows.
    """
    a, b = links.columns[:2]
    edges = saved(
        spark,
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter("u > v")
        .distinct(),
        "links",
    )
    mark = _mark(edges)
    while mark[0]:
        edges = saved(spark, _star(spark, _star(spark, edges, True), False), "links")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
