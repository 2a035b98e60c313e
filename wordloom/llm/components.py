"""Connected components of a large set of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.plans.stages import stage


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in links (a, b): root is the same for all nodes that links join.

    In each round a node goes to its smallest neighbour or itself, and on to where that one goes; links
    inside one root vanish. The number of links falls by a constant factor a round or more, the longest chain
    takes as many rounds as its length has bits. Every round is stored, so a lost executor costs one round.
    """
    link = stage(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "links", n=F.count("*"))
    ends = link.table.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    roots = stage(ends.withColumn("root", F.col("node")), "roots").table
    while link.measured["n"]:
        both = link.table.select("a", "b").unionByName(link.table.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = stage(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("p")).select(F.col("a").alias("node"), "p"), "parents").table
        onward = parent.select(F.col("node").alias("p"), F.col("p").alias("pp"))
        jump = stage(parent.join(onward, "p").select("node", F.col("pp").alias("to")), "jumps").table
        roots = stage(
            roots.join(jump.withColumnRenamed("node", "root"), "root", "left").select("node", F.coalesce("to", "root").alias("root")), "roots"
        ).table
        moved = (
            link.table.join(jump.select(F.col("node").alias("a"), F.col("to").alias("_a")), "a")
            .join(jump.select(F.col("node").alias("b"), F.col("to").alias("_b")), "b")
            .where("_a <> _b")
            .select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))
        )
        link = stage(moved.distinct(), "links", n=F.count("*"))
    return roots
