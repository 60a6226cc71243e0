"""Connected components by alternating large and small star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitloom.llm.common import join_dealt, stored


def _state(edges: DataFrame) -> tuple:
    mix = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mix)).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that is not its component's smallest, from pairs (a, b) of longs.

    Each round links the neighbours above a node, then those below it, to the smallest one around; the
    number of rounds grows with the logarithm of the component's size. Each round is written to the
    shared folder. The neighbours of a hub are dealt to salts. Null ends and pairs of a node with itself
    are ignored, repeated pairs count once.
    """
    edges = stored(edges.where("a <> b").distinct(), "edges")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lows = both.groupBy("a").agg(F.least("a", F.min("b")).alias("low"))
        large = (join_dealt(both.where("b > a"), lows, "a", "b")
                 .select(F.col("b").alias("a"), F.col("low").alias("b")))
        lows = large.groupBy("a").agg(F.min("b").alias("low"))
        small = join_dealt(large, lows, "a", "b").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b")
        edges = stored(small.unionByName(lows.select("a", F.col("low").alias("b"))).distinct(), "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
