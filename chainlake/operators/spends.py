"""Spend linking and what follows from it: fees, unspent outputs, undo, balances, flows.

Frames: outs(txid, vout, height, tx_index, value_sat, address), ins(txid, height, tx_index,
input_index, prev_txid, prev_vout; prev_txid null for a coinbase).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

OUTPOINT = ["spent_txid", "spent_vout"]


def candidates(ins: DataFrame, outs: DataFrame, how: str = "left") -> DataFrame:
    """Every non-coinbase input with the latest output of its outpoint at or before its height, if any.

    The windows here and in :func:`link_spends` divide by the outpoint first, so the join's exchange serves them too.
    """
    made = outs.select(F.col("txid").alias("spent_txid"), F.col("vout").alias("spent_vout"), F.col("height").alias("spent_height"), F.col("tx_index").alias("spent_tx_index"), F.col("value_sat").alias("spent_value_sat"), F.col("address").alias("spent_address"))
    real = ins.filter("prev_txid is not null")
    on = (real.prev_txid == made.spent_txid) & (real.prev_vout == made.spent_vout) & (made.spent_height <= real.height)
    latest = Window.partitionBy("prev_txid", "prev_vout", "height", "tx_index", "input_index").orderBy(F.desc("spent_height"), F.desc("spent_tx_index"))
    return real.join(made, on, how).withColumn("_n", F.row_number().over(latest)).filter("_n = 1").drop("_n")


def link_spends(ins: DataFrame, outs: DataFrame) -> DataFrame:
    """Inputs with the outputs they consume; an outpoint is consumed once, by the first input in chain order."""
    once = Window.partitionBy("prev_txid", "prev_vout", "spent_height").orderBy("height", "tx_index", "input_index")
    return candidates(ins, outs, "inner").withColumn("_n", F.row_number().over(once)).filter("_n = 1").drop("_n")


def tx_fees(ins: DataFrame, outs: DataFrame, spends: DataFrame) -> DataFrame:
    """(txid, height, tx_index, fee, coinbase): what the linked inputs hold more than the outputs, at least 0; 0 for a coinbase.

    A transaction is its height and index; a txid may occur at two heights. One without outputs is all fee.
    """
    one = F.lit(None)
    parts = [
        spends.select("txid", "height", "tx_index", F.col("spent_value_sat").alias("paid"), one.cast("long").alias("made"), F.lit(False).alias("coinbase")),
        outs.select("txid", "height", "tx_index", one.cast("long").alias("paid"), F.col("value_sat").alias("made"), F.lit(False).alias("coinbase")),
        ins.select("txid", "height", "tx_index", one.cast("long").alias("paid"), one.cast("long").alias("made"), F.col("prev_txid").isNull().alias("coinbase")),
    ]
    sums = parts[0].union(parts[1]).union(parts[2]).groupBy("height", "tx_index", "txid").agg(F.sum("paid").alias("paid"), F.sum("made").alias("made"), F.bool_or("coinbase").alias("coinbase"))
    fee = F.greatest(F.coalesce("paid", F.lit(0)) - F.coalesce("made", F.lit(0)), F.lit(0))
    return sums.select("txid", "height", "tx_index", F.when(F.col("coinbase"), 0).otherwise(fee).cast("long").alias("fee"), "coinbase")


def block_fees(fees: DataFrame) -> DataFrame:
    return fees.groupBy("height").agg(F.sum(F.when(~F.col("coinbase"), F.col("fee")).otherwise(0)).alias("total_fee"), F.count(F.lit(1)).alias("tx_count"))


def utxo_at(outs: DataFrame, spends: DataFrame, height: int) -> DataFrame:
    """Outputs made and not spent up to a height."""
    gone = spends.filter(F.col("height") <= height).select(F.col("spent_txid").alias("txid"), F.col("spent_vout").alias("vout"), F.col("spent_height").alias("height"))
    return outs.filter(F.col("height") <= height).join(gone, ["txid", "vout", "height"], "left_anti")


def balances(outs: DataFrame, spends: DataFrame, height: int) -> DataFrame:
    signed = outs.filter(F.col("height") <= height).select("address", F.col("value_sat").alias("v")).unionByName(spends.filter(F.col("height") <= height).select(F.col("spent_address").alias("address"), (-F.col("spent_value_sat")).alias("v")))
    return signed.groupBy("address").agg(F.sum("v").alias("balance_sat"))


def undo(outs: DataFrame, spends: DataFrame) -> DataFrame:
    """Per height: older outputs it spent, and outputs it made that it did not spend itself."""
    spent = spends.filter("spent_height < height").groupBy("height").agg(F.count(F.lit(1)).alias("spent"))
    own = spends.filter("spent_height = height").select(F.col("spent_txid").alias("txid"), F.col("spent_vout").alias("vout"), "height")
    created = outs.join(own, ["txid", "vout", "height"], "left_anti").groupBy("height").agg(F.count(F.lit(1)).alias("created"))
    return created.join(spent, "height", "full").select("height", F.coalesce("spent", F.lit(0)).alias("spent"), F.coalesce("created", F.lit(0)).alias("created"))


def counters(ins: DataFrame, outs: DataFrame, recent: int = 100) -> DataFrame:
    """One row: inputs, coinbase, linked, missing; the linked ones by the age of what they spend: same block, recent, old."""
    age = F.col("height") - F.col("spent_height")
    links = link_spends(ins, outs).agg(F.count(F.lit(1)).alias("linked"), F.count_if(age == 0).alias("same_block"), F.count_if(age.between(1, recent)).alias("recent"), F.count_if(age > recent).alias("old"))
    whole = ins.agg(F.count(F.lit(1)).alias("inputs"), F.count_if(F.col("prev_txid").isNull()).alias("coinbase"))
    return whole.crossJoin(links).withColumn("missing", F.col("inputs") - F.col("coinbase") - F.col("linked"))  # one row each


class MissingOutputs(RuntimeError):
    """Inputs whose outputs are not known."""


def require_all(found: DataFrame) -> None:
    """Raise if :func:`counters` found an input without an output."""
    row = found.first()
    if row["missing"]:
        raise MissingOutputs(f"{row['missing']} of {row['inputs']} inputs")


def undo_rows(outs: DataFrame, spends: DataFrame) -> DataFrame:
    """What taking back a height restores and removes: (height, kind, txid, vout); kind is spent or created."""
    spent = spends.filter("spent_height < height").select("height", F.lit("spent").alias("kind"), F.col("spent_txid").alias("txid"), F.col("spent_vout").alias("vout"))
    own = spends.filter("spent_height = height").select(F.col("spent_txid").alias("txid"), F.col("spent_vout").alias("vout"), "height")
    made = outs.join(own, ["txid", "vout", "height"], "left_anti").select("height", F.lit("created").alias("kind"), "txid", "vout")
    return spent.unionByName(made)


def disconnected(unspent: DataFrame, undo: DataFrame, outs: DataFrame, fork: int) -> DataFrame:
    """The unspent outputs after taking back all heights above ``fork``: without what these made, with what they spent of older ones."""
    back = undo.filter(F.col("height") > fork)
    rest = unspent.filter(F.col("height") <= fork)
    again = outs.filter(F.col("height") <= fork).join(back.filter("kind = 'spent'").select("txid", "vout").distinct(), ["txid", "vout"], "left_semi")
    return rest.unionByName(again.select(rest.columns)).distinct()


def coin_flow(outs: DataFrame, spends: DataFrame) -> DataFrame:
    """Value by (spent address, receiving address) over all transactions; both sides are summed by address before they meet."""
    given = spends.select("height", "tx_index", F.col("spent_address").alias("from_address")).distinct()
    got = outs.groupBy("height", "tx_index", F.col("address").alias("to_address")).agg(F.sum("value_sat").alias("value_sat"))
    return given.join(got, ["height", "tx_index"]).groupBy("from_address", "to_address").agg(F.sum("value_sat").alias("value_sat"))
