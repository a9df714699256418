"""Header graph: first copies, heights, accumulated work, best tip, stale branches, fork points."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import written


def first_seen(records: DataFrame, key: str, *order: str) -> DataFrame:
    """The first record of each key; by a minimum, so no key is sorted."""
    rest = [c for c in records.columns if c not in (key, *order)]
    return records.groupBy(key).agg(F.min(F.struct(*order, *rest)).alias("r")).select(key, "r.*")


def _lifted(headers: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(hash, height, cum_work) of the nodes that reach a root, and each round's pointers (hash, far).

    Each round doubles how far back a node knows its sums; only nodes that have not reached a
    root yet take part in the join, settled ones are looked up. Rounds end when no row moves;
    rows that still move after log2(n) + 1 rounds are on or behind a cycle.
    """
    rounds = max(1, headers.count()).bit_length() + 1
    state = headers.select("hash", F.col("prev").alias("far"), F.lit(0).cast("long").alias("height"), F.col("work").alias("cum_work"))
    state = written(state, "headers")
    pointers = []
    for _ in range(rounds):
        back = state.select(F.col("hash").alias("far"), F.col("far").alias("farther"), F.col("height").alias("h"), F.col("cum_work").alias("w"))
        open_ = state.filter("far is not null").join(back, "far", "left")
        moved = open_.select(
            "hash", F.when(F.col("h").isNull(), F.col("far")).otherwise(F.col("farther")).alias("far"), (F.col("height") + F.coalesce(F.col("h") + 1, F.lit(0))).alias("height"),
            (F.col("cum_work") + F.coalesce("w", F.lit(0))).alias("cum_work"), F.col("h").isNotNull().alias("moved"),
        )
        after = written(moved.unionByName(state.filter("far is null").select(*state.columns, F.lit(False).alias("moved"))), "headers")
        pointers.append(state.filter("far is not null").select("hash", "far"))
        state = after.drop("moved")
        if after.filter("moved").isEmpty():
            break
    else:
        raise ValueError("the headers' prev pointers have a cycle")
    return state.filter("far is null").select("hash", "height", "cum_work"), pointers


def rooted(headers: DataFrame) -> DataFrame:
    """(hash, height, cum_work) of the nodes of headers(hash, prev, work) that reach a root (prev null), by pointer doubling."""
    return _lifted(headers)[0]


def main_chain(headers: DataFrame) -> DataFrame:
    """(hash, height, cum_work) of the best tip and its ancestors, by the rounds' pointers: the largest steps back first."""
    nodes, pointers = _lifted(headers)
    path = written(best_tip(nodes).select("hash"), "main-chain")
    for step in reversed(pointers):
        back = path.join(step, "hash").select(F.col("far").alias("hash"))
        path = written(path.union(back).distinct(), "main-chain")
    return nodes.join(path, "hash", "left_semi")


def header_stats(records: DataFrame, headers: DataFrame, main: DataFrame) -> DataFrame:
    """One row: all records, different blocks, and blocks off the main chain."""
    total = records.agg(F.count(F.lit(1)).alias("total_records"))
    unique = headers.agg(F.countDistinct("hash").alias("unique_blocks"))
    length = main.agg(F.count(F.lit(1)).alias("main_chain"))
    return total.crossJoin(unique).crossJoin(length).withColumn("orphans", F.col("unique_blocks") - F.col("main_chain"))  # one row each


def stale_tips(tips: DataFrame) -> DataFrame:
    """Of tips(hash, branch_length, status) the ones that were left behind."""
    return tips.filter(~F.col("status").isin("active", "headers-only"))


def branch_blocks(headers: DataFrame, tips: DataFrame) -> DataFrame:
    """(hash): the blocks of all branches tips(hash, branch_length), each walked back from its tip by its length.

    A round a step; branches are as short as reorganisations are deep.
    """
    step = headers.select("hash", "prev")
    here = written(tips.filter("branch_length > 0").select("hash", F.col("branch_length").alias("left")), "branch")
    found = here.select("hash")
    while not here.isEmpty():
        back = here.filter("left > 1").join(step, "hash").filter("prev is not null").groupBy(F.col("prev").alias("hash")).agg((F.max("left") - 1).alias("left"))
        here = written(back, "branch")
        found = found.union(here.select("hash"))
    return found.distinct()


def without(blocks: DataFrame, orphans: DataFrame, sent: int = 100_000) -> DataFrame:
    """The blocks whose hash is no orphan's; few orphans (counted) go by broadcast."""
    side = orphans.select("hash").distinct()
    return blocks.join(F.broadcast(side) if side.limit(sent + 1).count() <= sent else side, "hash", "left_anti")


class EmptyRange(ValueError):
    """No block of the chain lies in the wanted heights."""


def clamped(low: int, high: int | None, tip: int) -> tuple[int, int]:
    """Heights low to below high within a chain that ends at ``tip``."""
    low, high = min(low, tip), min(tip + 1 if high is None else high, tip + 1)
    if low >= high:
        raise EmptyRange(f"{low} to {high}")
    return low, high


def best_tip(nodes: DataFrame) -> DataFrame:
    """The node of most work; equal work goes to the smallest hash."""
    return nodes.orderBy(F.desc("cum_work"), "hash").limit(1)


def fork_point(local: DataFrame, node: DataFrame) -> DataFrame:
    """The highest height at which both have the same hash."""
    return local.join(node, ["height", "hash"]).agg(F.max("height").alias("fork_height"))


def ordinals(rows: DataFrame, within: str, *order: str) -> DataFrame:
    return rows.withColumn("ordinal", F.row_number().over(Window.partitionBy(within).orderBy(*order)) - 1)
