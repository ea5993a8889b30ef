"""Connected components of a table of links, by joins that turn each component into a star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import written


def connected_components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) of all nodes of ``links`` (a, b) that are not the smallest.

    Alternates two steps until nothing changes: each node hands its larger neighbours, then its
    smaller ones, to the smallest of them. The rounds grow with the logarithm of a component's size.
    Each step is a map-side minimum and a join that Spark may split at a hot node; tables between
    them are written, so a lost executor costs one step.
    """
    edges = written(_down(links.select("a", "b")), "edges")
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "least")
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(_down(large), "large-star")
        least = written(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        pairs = F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
        small = large.join(least, "a").select(pairs.alias("p")).select("p.a", "p.b")
        edges = written(_down(small), "small-star")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _down(links: DataFrame) -> DataFrame:
    """Different links from the larger to the smaller node, without loops."""
    a, b = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    return links.filter("a <> b").select(a, b).distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.lit(0))).first()
    return tuple(row)
