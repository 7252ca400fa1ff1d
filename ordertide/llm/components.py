"""Connected components by contraction, with nothing but joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.session import settle


def components(links: DataFrame) -> DataFrame:
    """uid, root for every end of ``links`` (a long, b long); root is one uid of the component.

    Each round points every node to its least neighbour, follows that pointer once more, and contracts
    the links to what is left between different roots. Nodes with a lesser neighbour disappear, so the
    rounds are logarithmic in practice. Each round is written to the shared folder.
    """
    edges = settle(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    ends = edges.select(F.col("a").alias("uid")).union(edges.select(F.col("b").alias("uid"))).distinct()
    roots = ends.select("uid", F.col("uid").alias("root"))
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a")).toDF("v", "u")
        least = both.groupBy("v").agg(F.min("u").alias("u")).select("v", F.least("v", "u").alias("p"))
        least = settle(least, "pointers")
        twice = least.alias("x").join(least.alias("y"), F.col("x.p") == F.col("y.v"), "left")
        jump = settle(twice.select(F.col("x.v").alias("v"), F.coalesce("y.p", "x.p").alias("p")), "jumps")
        moved = roots.join(jump, roots["root"] == jump["v"], "left")
        roots = settle(moved.select("uid", F.coalesce("p", "root").alias("root")), "roots")
        left = edges.join(jump.toDF("a", "pa"), "a").join(jump.toDF("b", "pb"), "b")
        left = left.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
        edges = settle(left.filter("a <> b").distinct(), "links")
    return roots
