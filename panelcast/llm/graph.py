"""Connected components of a large edge table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import Scratch


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, component)`` of every node in ``links`` (``u``, ``v`` longs); a component is its smallest node.

    Alternating large and small stars: every round links each node's larger neighbours to its smallest
    one, then its smaller neighbours likewise, until each component is one star. Rounds grow with the
    logarithm of the longest chain; each one is written, so lost executors cost one round at most.
    Self-links and repeated links do no harm; no links give no rows.
    """
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct()
    scratch = Scratch(links.sparkSession)
    edges = scratch.stage(edges, "links")
    before = _state(edges)
    while before[0]:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        stars = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = stars.groupBy("u").agg(F.min("v").alias("m"))
        joined = stars.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v")))
        last, edges = edges, scratch.stage(small.filter("u > v").distinct(), "links")
        scratch.drop(last)
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
