"""Connected components of an edge table, by repeated joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewarden.session import written


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(id, component) for every id in ``edges`` (a, b); component is the smallest id reachable.

    Each round hangs the larger neighbours of every id on its smallest neighbour, then does
    the same among the smaller neighbours, until every edge ends in a root. A hub's
    neighbours are joined, never gathered, so one component may hold any share of the rows.
    Rounds are written to the shared folder. Null ends and loops link nothing; an empty
    table has no components.
    """
    tree = edges.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")
    )
    tree = written(tree.distinct(), label)
    while True:
        both = tree.union(tree.select("m", "v")).toDF("u", "w")
        low = both.groupBy("u").agg(F.least(F.min("w"), F.col("u")).alias("low"))
        large = both.join(low, "u").where("w > u").select(F.col("w").alias("v"), F.col("low").alias("m"))
        low = large.groupBy("v").agg(F.min("m").alias("low"))
        small = large.join(low, "v").select("v", "m", "low")
        hung = small.select("v", F.col("low").alias("m")).union(
            small.where("m <> low").select(F.col("m").alias("v"), F.col("low").alias("m"))
        )
        tree = written(hung.distinct(), label)
        inner = tree.select("m").distinct().join(tree.select(F.col("v").alias("m")), "m", "left_semi")
        several = tree.groupBy("v").count().where("count > 1").select("v")
        if inner.isEmpty() and several.isEmpty():
            break
    return tree.select(F.col("v").alias("id"), F.col("m").alias("component")).union(
        tree.select("m", "m").distinct()
    )
