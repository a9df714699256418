"""Chain-shaped frames over the order tables, and the same views as DuckDB SQL.

A transaction is an order, a block is a day; an order's lines are its outputs, and inputs
that spend the same lines of the customer's previous order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LINE = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def txs(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, own = Window.partitionBy("o_orderdate").orderBy("o_orderkey"), Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("txid"), F.datediff("o_orderdate", F.lit("1995-01-01")).cast("long").alias("height"),
        (F.row_number().over(day) - 1).cast("long").alias("tx_index"), F.lag("o_orderkey").over(own).alias("prev_txid"), F.col("o_custkey").alias("custkey"),
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("l_orderkey").orderBy(*LINE)
    return table(spark, sf_dir, "lineitem").withColumn("vout", (F.row_number().over(order) - 1).cast("long"))


def outs(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir).select(F.col("l_orderkey").alias("txid"), "vout", F.round(F.col("l_extendedprice") * 100).cast("long").alias("value_sat"), F.col("l_suppkey").alias("address"))
    return lines.join(txs(spark, sf_dir).select("txid", "height", "tx_index"), "txid")


def ins(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir).select(F.col("l_orderkey").alias("txid"), F.col("vout").alias("input_index"))
    joined = lines.join(txs(spark, sf_dir), "txid")
    return joined.select("txid", "height", "tx_index", "input_index", "prev_txid", F.col("input_index").alias("prev_vout"))


SQL = """
tx AS (SELECT o_orderkey AS txid, date_diff('day', TIMESTAMP '1995-01-01', o_orderdate) AS height, row_number() OVER (PARTITION BY o_orderdate ORDER BY o_orderkey) - 1 AS tx_index,
       lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev_txid, o_custkey AS custkey FROM orders),
line AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 AS vout FROM lineitem),
outs AS (SELECT l_orderkey AS txid, vout, CAST(round(l_extendedprice * 100) AS BIGINT) AS value_sat, l_suppkey AS address, height, tx_index FROM line JOIN tx ON l_orderkey = txid),
ins AS (SELECT txid, height, tx_index, vout AS input_index, prev_txid, vout AS prev_vout FROM line JOIN tx ON l_orderkey = txid),
spends AS (SELECT i.*, o.txid AS spent_txid, o.vout AS spent_vout, o.height AS spent_height, o.value_sat AS spent_value_sat, o.address AS spent_address
           FROM ins i JOIN outs o ON i.prev_txid = o.txid AND i.prev_vout = o.vout AND o.height <= i.height
           QUALIFY row_number() OVER (PARTITION BY o.txid, o.vout ORDER BY i.height, i.tx_index, i.input_index) = 1)
"""
