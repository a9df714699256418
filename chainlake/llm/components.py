"""Connected components of a link table by alternating large-star and small-star rounds.

Every round is a grouped minimum (combined before the shuffle) and a join back; no group is
gathered anywhere and nothing but one pair of numbers a round reaches the driver. Rounds
end when a round changes nothing, after O(log n) of them in practice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import delete, store


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each node of ``links`` (a, b); a component is named by its smallest node.

    Self-links, repeated and reversed links are allowed; rows with a null end are ignored.
    """
    edges = links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = store(edges, "links")
    state = _state(edges)
    while state[0]:
        # large star: the larger neighbours of a node move to its smallest neighbour
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        # small star: the smaller neighbours of a node, and the node, move to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        before, edges = edges, store(small.filter("u != v").distinct(), "links")
        delete(before)
        after = _state(edges)
        if after == state:
            break
        state = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 31)))).first())
