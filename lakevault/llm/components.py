"""Connected components of a link table, as Spark joins over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakevault.llm.common import compacted


def _jumped(parents: DataFrame) -> DataFrame:
    """Follow parents to the root: the depth halves each time."""
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("next"))
        far = compacted(parents.join(up, "parent", "left").select("node", F.coalesce("next", "parent").alias("parent"), F.coalesce(F.col("next") != F.col("parent"), F.lit(False)).alias("moved")), "parents")
        parents = far.select("node", "parent")
        if not far.filter("moved").limit(1).count():
            return parents


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; the root is the smallest node reached.

    Every round hooks each node below its smallest neighbour, flattens the trees and contracts the
    links to roots; links between different roots at least halve the roots per round.
    """
    links = compacted(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    found = None
    while True:
        both = links.union(links.select("b", "a"))
        parents = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("node", "near").alias("parent"))
        parents = _jumped(compacted(parents, "parents"))
        if found is None:
            found = parents.select("node", F.col("parent").alias("root"))
        else:
            up = parents.select(F.col("node").alias("root"), "parent")
            found = compacted(found.join(up, "root", "left").select("node", F.coalesce("parent", "root").alias("root")), "roots")
        left = parents.select(F.col("node").alias("a"), F.col("parent").alias("ra"))
        right = parents.select(F.col("node").alias("b"), F.col("parent").alias("rb"))
        contracted = links.join(left, "a").join(right, "b").filter("ra <> rb")
        links = compacted(contracted.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "links")
        if not links.limit(1).count():
            return found
