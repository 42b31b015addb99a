"""Connected components by alternating star contractions.

Every round is two grouped minima and two joins over the remaining edges, and
is written to the shared folder, so lost executors cost a round at most. The
edges never pass through the driver; only a count and a checksum do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tezgah.sources.shared import stored


def _towards_least(pairs: DataFrame) -> DataFrame:
    """Large star: every greater neighbour of a node is tied to the node's least neighbour."""
    both = pairs.union(pairs.select(F.col("lo").alias("hi"), F.col("hi").alias("lo"))).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    tied = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.least("u", "m").alias("lo"))
    return tied.distinct()


def _below_least(pairs: DataFrame) -> DataFrame:
    """Small star: a node and its smaller neighbours are tied to the least of them."""
    least = pairs.groupBy("hi").agg(F.min("lo").alias("m"))
    tied = pairs.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return tied.union(least.select("hi", F.col("m").alias("lo"))).distinct()


def _state(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node but the least of its component.

    ``edges`` has two BIGINT columns in any order of ends; repeated edges, loops
    and rows with a NULL end are allowed and tie nothing further. The component
    is its least node. No edges give no rows.
    """
    a, b = edges.columns
    pairs = stored(
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull())
        .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .where("hi > lo")
        .distinct(),
        "edges",
    )
    before = _state(pairs)
    while before[0]:
        pairs = stored(_below_least(_towards_least(pairs)), "stars")
        after = _state(pairs)
        if after == before:
            break
        before = after
    return pairs.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
