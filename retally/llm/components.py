"""Connected components of a link table, by alternating star operations.

Large-star ties every larger neighbour of a node to the smallest node around
it, small-star does the same with the smaller ones; a few rounds turn every
component into a star around its smallest node (Kiveris et al., "Connected
components in MapReduce and beyond", 2014).  Each round is two aggregations
and two joins over the links, written to the shared folder, so nothing grows
on the driver and a lost executor costs one stage.  A hub with very many links
is a skewed join key there; joins are plain inner joins that Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retally.llm.shared import materialise


def _star(links: DataFrame, grouped: DataFrame) -> DataFrame:
    """Tie each neighbour in ``links(node, other)`` to the smallest node around ``node``."""
    low = materialise(grouped.groupBy("node").agg(F.min("other").alias("least")), "star-least")
    return links.join(low, "node")


def components(links: DataFrame) -> DataFrame:
    """``links`` has two columns ``a`` and ``b`` of one ordered type.

    Returns (node, component): every node of a link with the smallest node
    reachable from it.  Links from a node to itself and repeated links are
    allowed; an empty table gives an empty result.
    """
    kind = links.schema["a"].dataType
    ordered = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    stars = materialise(ordered.distinct(), "star-links")
    before = None
    while True:
        state = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == before:
            break
        before = state
        # large-star: larger neighbours of a node go to the least of the node and all its neighbours
        both = stars.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            stars.select(F.col("b").alias("node"), F.col("a").alias("other")))
        reach = _star(both, both)
        large = reach.where(F.col("other") > F.col("node")).select(
            F.col("other").alias("a"), F.least("node", "least").alias("b"))
        large = materialise(large.where("a <> b").distinct(), "star-large")
        # small-star: a node and its smaller neighbours go to the least of them
        down = large.select(F.col("a").alias("node"), F.col("b").alias("other"))
        reach = _star(down, down)
        small = reach.select(F.col("other").alias("a"), F.col("least").alias("b")).unionByName(
            reach.select(F.col("node").alias("a"), F.col("least").alias("b")))
        stars = materialise(small.where("a <> b").distinct(), "star-links")
    roots = stars.select(F.col("b").cast(kind).alias("node"), F.col("b").alias("component")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
