"""Connected components of an edge table by alternating large-star and
small-star steps, each a minimum per node and an equi-join, so a node with
very many edges is pre-aggregated and its join can be split.  Every round is
written to the shared folder; no edge or component reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def _mark(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that has an edge; the component is its
    smallest node.  Loops, repeated and reversed edges are fine."""
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    current = saved(edges.filter(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct(), "edges")
    mark = _mark(current)
    while mark[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Written, so that both sides of the join are dealt anew and a hub's rows can be split.
        low = saved(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "lowest")
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = saved(large.groupBy("u").agg(F.min("v").alias("m")), "lowest")
        near = large.join(low, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = saved(near.unionByName(low.withColumnRenamed("m", "v")).distinct(), "edges")
        mark, before = _mark(after), mark
        current = after
        if mark == before:
            break
    roots = current.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
