"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from memberfold.llm.common import written

MAX_STEPS = 100


def _edges(df: DataFrame) -> DataFrame:
    return df.where("hi <> lo").distinct()


def _kept(edges: DataFrame) -> tuple[DataFrame, dict]:
    """The edges, written, and their number and a checksum, told by the write itself."""
    state = Observation()
    sums = F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("hi", "lo")).alias("sum")
    edges = written(edges.observe(state, *sums), "edges")
    return edges, state.get


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every end of ``a, b``; a component goes by its least node.

    A link of a node to itself names the node.
    """
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    return nodes.join(joined_nodes(links), "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def joined_nodes(links: DataFrame) -> DataFrame:
    """As ``components``, without the nodes that a component goes by.

    Each step joins edges only with the least neighbour of their ends, so that no
    node's edges have to be in one place.
    """
    pair = links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    edges, before = _kept(_edges(pair))
    for _ in range(MAX_STEPS):
        if not before["n"]:
            break
        both = edges.select("hi", "lo").unionAll(edges.select(F.col("lo"), F.col("hi")))
        both = both.toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = _edges(large)
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        pulled = large.join(least, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        edges, after = _kept(_edges(pulled.unionAll(least.toDF("hi", "lo"))))
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {MAX_STEPS} steps")
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
