"""Connected components of a large graph, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adsift.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """``edges`` has ``u, v`` (bigint). Returns ``node, component`` (the smallest
    node reached) for every node of an edge.

    Each round, every node hooks onto its smallest neighbour if that is smaller, the hooks are
    followed to their roots by pointer doubling, and the edges are contracted onto the
    roots; a star of any size is gone after one round. Each round's tables are written to the
    shared folder. Only the counts that end the loops reach the driver.
    """
    own = edges.select(F.col("u").cast("bigint"), F.col("v").cast("bigint"))
    rest = written(own.filter("u != v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(),
                   "graph-edges")
    found = written(own.select(F.explode(F.array("u", "v")).alias("node")).distinct()
                    .select("node", F.col("node").alias("component")), "graph-nodes")
    while not rest.isEmpty():
        both = rest.unionByName(rest.select(F.col("v").alias("u"), F.col("u").alias("v")))
        parent = written(both.groupBy("u").agg(F.min("v").alias("low"))
                         .select(F.col("u").alias("node"), F.least("u", "low").alias("parent")), "graph-hooks")
        while True:
            up = parent.select(F.col("node").alias("parent"), F.col("parent").alias("higher"))
            jumped = written(parent.join(up.hint("merge"), "parent").select(
                "node", F.col("higher").alias("parent"), (F.col("higher") != F.col("parent")).alias("moved")), "graph-jump")
            parent = jumped.select("node", "parent")
            if jumped.filter("moved").isEmpty():
                break
        root = lambda c, to: parent.select(F.col("node").alias(c), F.col("parent").alias(to)).hint("merge")
        found = written(found.join(root("component", "root"), "component", "left")
                        .select("node", F.coalesce("root", "component").alias("component")), "graph-nodes")
        moved = (rest.join(root("u", "ru"), "u").select("v", "ru").join(root("v", "rv"), "v").filter("ru != rv")
                 .select(F.least("ru", "rv").alias("u"), F.greatest("ru", "rv").alias("v")).distinct())
        rest = written(moved, "graph-edges")
    return found
