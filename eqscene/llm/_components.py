"""Connected components by alternating large and small stars, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eqscene.llm._common import staged


def _downward(pairs: DataFrame) -> DataFrame:
    """Each pair of unlike nodes, the greater node first."""
    return pairs.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one other at most, and none on a node that hangs itself."""
    ends = edges.select(F.inline(F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")),
        F.struct(F.col("v").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")),
    )))
    each = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return each.agg(F.max((F.col("hangs") > 1) | (F.col("hangs") * F.col("holds") > 0))).first()[0] is not True


def components(pairs: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``pairs`` (u, v) that is not the least of its component.

    Large stars tie the greater neighbours of a node to its least one, small stars the
    others; no node's neighbours are gathered, only their minimum. Edges are dealt out by
    a node once for its minimum and for the join with it. Each round is written to the
    shared folder. It ends when all that is left are stars, after a number of rounds that
    grows as the logarithm of the longest path.
    """
    edges = staged(_downward(pairs).distinct(), "edges")
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).repartition("u")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # as m <= u this is v > u, but it stays above the join, so that both sides read one exchange
        greater = both.join(least, "u").filter(F.greatest("v", "m") > F.col("u"))
        large = _downward(greater.select(F.col("v").alias("u"), F.col("m").alias("v"))).repartition("u")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.inline(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
        )))
        edges = staged(_downward(small).distinct(), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
