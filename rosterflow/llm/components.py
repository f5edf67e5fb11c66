"""Connected components by alternating stars, as joins and aggregates over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.session import materialise


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``(node, component)`` for every node of an edge but the smallest of its component, which is its ``component``.

    ``edges`` has ``src`` and ``dst``. Every round first ties a node's larger neighbours to
    its smallest one, then its smaller neighbours; trees get flat in few rounds. Rounds are
    written to the shared folder, so a lost executor costs its own tasks. A node with very
    many edges only meets aggregates that combine before the shuffle and joins whose large
    partitions can be split. Loops and null ends are left out; an empty table has no components.
    """
    tied = edges.filter(F.col("src") != F.col("dst")).select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct()
    tied = materialise(tied, label)
    while not _flat(tied):
        both = tied.unionByName(tied.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialise(large, label)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        tied = materialise(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), label)
    return tied.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _flat(tied: DataFrame) -> bool:
    """Whether every node hangs on one other node that itself hangs on none."""
    ends = tied.select(F.col("u").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds"))
    ends = ends.unionByName(tied.select(F.col("v").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
    per_node = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return per_node.filter((F.col("hangs") > 1) | ((F.col("hangs") > 0) & (F.col("holds") > 0))).isEmpty()
