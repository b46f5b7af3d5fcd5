"""Connected components of an edge table, without bringing it to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.common import saved


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a, b``, both long); the component is its smallest node.

    Alternating large and small stars: a node links its larger neighbours, then its smaller ones, to its smallest
    neighbour, until nothing changes.  Edges never grow in number, and the number of rounds grows with the logarithm of
    the longest path.  Smallest neighbours are found with a partial aggregate, so a node of very many edges costs its
    task one row per map task.  Self-loops are ignored; an empty table gives an empty one.
    """
    edges = saved(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), name)
    number = 0
    while True:
        around = _both_ways(edges)
        least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = around.join(least, "a").where("b > a").select(F.col("least").alias("a"), "b").where("a <> b").distinct()
        # now every edge goes from a larger to a smaller node; the larger one links its smaller neighbours
        smallest = large.groupBy("b").agg(F.min("a").alias("least"))
        small = large.join(smallest, "b").select(
            F.explode(F.array(F.struct(F.col("least").alias("a"), F.col("a").alias("b")), F.struct(F.col("least").alias("a"), "b"))).alias("e")
        ).select("e.a", "e.b").where("a <> b").distinct()
        number += 1
        after = saved(small, f"{name}-{number}")
        total = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if total(after) == total(edges):
            break
        edges = after
    star = edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return star.unionByName(star.select(F.col("component").alias("node"), "component")).distinct()
