"""Connected components of a table of links, by alternating stars on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), root its component's least node.

    Alternates the large-star and small-star steps on written tables until
    the edges stop changing, in about log n rounds.
    """
    state, cur = None, edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v")
    while True:
        both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u").select("u", "v", "m")
        small = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", "m")).distinct()
        after = scratch.write(small, "edges")
        seen = after.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state is not None:
            scratch.drop(cur)
        cur = after
        if seen == state:
            roots = cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
        state = seen
