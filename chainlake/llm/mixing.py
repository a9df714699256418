"""Mixing sources to target weights (operator 7), with DataFrame functions only.

Tokens are summed per source, targets come from the weights by water filling, and each
document is emitted floor(rate) times plus once more when a hash-seeded coin with
probability rate - floor(rate) says so. The coin depends on the id and the seed alone.

Only sums per source are gathered; the documents are never grouped, so a source that holds
a third of all rows costs nothing extra. The table of sources joins by broadcast up to
``broadcast_sources`` rows (checked by a count), above that by a salted shuffle join.

Edge cases: a null text has size 0; null is a source of its own, last in order; a source
without words has target 0 and contributes no words; repeated rows share a coin and are
counted each; an empty table gives an empty table; a null id is hashed as an empty text;
further columns may have any names: the row travels as one column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .text import WORD

_SALTS = 64


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def coin(id: str, seed: str) -> Column:
    """A number in [0, 1) with 32 bits from the id and the seed."""
    word = F.substring(F.md5(F.concat_ws(":", F.coalesce(F.col(id).cast("string"), F.lit("")), F.lit(seed)).cast("binary")), 1, 8)
    return F.conv(word, 16, 10).cast("long") / F.lit(4294967296.0)


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: tuple[int, int] = (3, 2), most: int = 2) -> DataFrame:
    """``sizes`` (source, source_size), one row a source, with each one's ``target``.

    Weights go to the sources in code-point order (null last), repeating. All targets sum to
    ``share`` (a ratio) of all sizes, none is above ``most`` times its size. The sources are
    walked by cap / weight; the ones below the water level are at their cap, and the rest
    share what is left by weight. This works on one row a source, never on documents.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    cycle = F.array(*map(F.lit, weights))
    ranked = sizes.withColumn("weight", F.element_at(cycle, (F.row_number().over(order) - 1).cast("int") % len(weights) + 1).cast("long"))
    ranked = ranked.withColumn("cap", F.col("source_size") * most)
    whole = Window.partitionBy()
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("cap"), F.col("weight")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    up, down = share
    ranked = ranked.withColumns({
        "all_size": F.sum("source_size").over(whole),
        "all_weight": F.sum("weight").over(whole),
        "cap_so_far": F.sum("cap").over(by_level),
        "weight_so_far": F.sum("weight").over(by_level),
    })
    # a source is at its cap when the level that the others would then share reaches it
    left = up * F.col("all_size") - down * (F.col("cap_so_far") - F.col("cap"))
    rest = F.col("all_weight") - (F.col("weight_so_far") - F.col("weight"))
    full = down * F.col("cap") * rest <= F.col("weight") * left
    ranked = ranked.withColumn("full", full)
    ranked = ranked.withColumns({
        "cap_full": F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(whole), F.lit(0)),
        "weight_full": F.coalesce(F.sum(F.when(F.col("full"), F.col("weight"))).over(whole), F.lit(0)),
    })
    room = (down * (F.col("all_weight") - F.col("weight_full"))).cast("double")
    shared = F.try_divide((F.col("weight") * (up * F.col("all_size") - down * F.col("cap_full"))).cast("double"), room)
    return ranked.select("source", "source_size", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(shared).alias("target"))


MADE = ("size", "source_size", "target", "copies")


def _rated(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", seed: str = "mix", broadcast_sources: int = 100_000, **how) -> DataFrame:
    """(row, size, source_size, target, copies): the given row is one column, so no name of its own can clash."""
    sized = docs.select(F.struct(*docs.columns).alias("row"), F.col(source).alias("source"), n_words(text).alias("size"), coin(id, seed).alias("coin"))
    goal = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), **how).withColumnRenamed("source", "of")
    if docs.select(source).distinct().limit(broadcast_sources + 1).count() <= broadcast_sources:
        joined = sized.join(F.broadcast(goal), F.col("source").eqNullSafe(F.col("of")))
    else:
        goal = goal.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
        sized = sized.withColumn("own_salt", F.floor(F.col("coin") * 4294967296).bitwiseAND(_SALTS - 1).cast("int"))
        joined = sized.join(goal, F.col("source").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("own_salt")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    copies = F.floor(rate) + (F.col("coin") < rate - F.floor(rate)).cast("long")
    return joined.select("row", "size", "source_size", "target", copies.cast("long").alias("copies"))


def rates(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with ``MADE``: size, source_size, target and copies, the number of times the mix takes the row.

    Columns of ``docs`` that have these names give way here; :func:`mixed` keeps them as they are.
    """
    return _rated(docs, **how).select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in MADE], *MADE)


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as its rate says, with the same columns."""
    taken = _rated(docs, **how).filter("copies > 0").select("row", "copies")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")
