"""Connected components of a graph given as edges, by alternating large and small stars.

Every round replaces edges by edges to smaller nodes, with two aggregations and joins on the node;
the graph is never gathered. Rounds are written to the shared folder, so that the lineage stays
short and a lost executor costs one round; a round has as many files as its edges fill. Repeated edges, loops and nulls in edges do no harm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import checkpointed, files_for


def large_star(edges: DataFrame) -> DataFrame:
    """Each neighbour above a node is tied to the smallest of the node's neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    tied = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return tied.unionByName(own).where("u <> v").distinct()


def roots(edges: DataFrame, about: int | None = None) -> DataFrame:
    """node, root: the smallest node that each node of `edges` (u, v) can reach, itself left out.

    `about` is how many edges there may be, if that is known; it decides the number of files alone.
    """
    now = checkpointed(edges.where("u <> v").select("u", "v").distinct(), None if about is None else files_for(about))
    mark = None
    while True:
        row = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if row[0] == 0 or tuple(row) == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = tuple(row)
        now = checkpointed(small_star(large_star(now)), files_for(row[0]))  # a round adds no edges
