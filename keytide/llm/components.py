"""Connected components of a table of links, by alternating stars on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from keytide.settings import new_folder, scratch, written_table


def _state(edges: DataFrame) -> tuple:
    # Order-free, so two rounds compare without moving the edges.
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31)))).first())


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b long) to (node, root): root is the smallest node that links lead to.

    Every round joins each node's neighbours to its smallest one, first the larger neighbours, then the
    smaller, until all edges point to a root. Minima are combined before the shuffle; the joins are
    equi-joins of fixed-width rows, which adaptive execution splits at a node with many links. Nodes without links
    have no row.
    """
    spark = links.sparkSession
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    result = new_folder(spark, "components")
    with scratch(spark):
        edges = written_table(edges, "links")
        before = None
        while (now := _state(edges)) != before:
            before = now
            edges = _starred(edges)
        nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        nodes = nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        nodes.write.parquet(result)
    return spark.read.schema("node long, root long").parquet(result)


def _starred(edges: DataFrame) -> DataFrame:
    """One round: edges (a > b) as stars around the smallest neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    larger = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    stars = written_table(larger.where("a <> b").distinct(), "large-star")
    least = stars.groupBy("a").agg(F.min("b").alias("m"))
    smaller = stars.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    found = smaller.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b")
    found = found.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return written_table(found.distinct(), "small-star")
