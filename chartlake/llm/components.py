"""Connected components of a table of links, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartlake.llm.shared import staged


def both_ends(rows: DataFrame, *ends: Column) -> DataFrame:
    """The structs of ``ends``, a row for each, from one scan of ``rows``."""
    return rows.select(F.explode(F.array(*ends)).alias("end")).select("end.*")


def unsettled(edges: DataFrame) -> DataFrame:
    """Nodes that hang on several others, or on one while others hang on them."""
    one, none = F.lit(1), F.lit(0)
    ends = both_ends(
        edges,
        F.struct(F.col("u").alias("node"), one.alias("over"), none.alias("under")),
        F.struct(F.col("v").alias("node"), none.alias("over"), one.alias("under")),
    )
    counts = ends.groupBy("node").agg(F.sum("over").alias("over"), F.max("under").alias("under"))
    return counts.filter("over > 0 and over + under > 1")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is the smallest node.

    Alternates between hanging the larger neighbours of a node on its smallest one and
    hanging the node itself there, until all links point at roots. The number of rounds
    grows with the logarithm of the longest chain. Every round is a written table, so a
    lost executor costs one round at most. Loops and repeated links are allowed. A round reads
    its links in few scans and shuffles: the driver keeps some memory for every stage and task.
    """
    edges = staged(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    while True:
        # Links lead from a larger node to a smaller one, so the smallest neighbour of either
        # end, itself included, is the smallest of the lower ends of its links.
        lowest = (
            edges.select(F.explode(F.array("u", "v")).alias("node"), F.col("v").alias("m"))
            .groupBy("node").agg(F.min("m").alias("m"))
        )
        large = edges.join(lowest, F.col("v") == F.col("node")).select("u", F.col("m").alias("v"))
        joined = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        edges = staged(
            both_ends(joined, F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
            .filter("u <> v")
            .distinct(),
            "links",
        )
        if unsettled(edges).isEmpty():
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
