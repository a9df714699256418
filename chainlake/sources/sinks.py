"""Chain tables as Parquet by height range, with pruned scans, retraction, and tables of a catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import part_id
from .shared import forget, written

#: Sort keys of the entity tables and of the lookup tables.
KEYS = {
    "blocks": ["height"], "transactions": ["height", "tx_index"], "inputs": ["height", "tx_index", "input_index"], "outputs": ["height", "tx_index", "output_index"],
    "spends": ["height", "spending_tx_index", "spending_input_index"], "transactions_by_txid": ["txid"], "inputs_by_prev_output": ["prev_txid", "prev_vout"], "outputs_by_address": ["address_hash", "height", "tx_index", "output_index"],
}
ENTITIES = ("blocks", "transactions", "inputs", "outputs", "spends")


def write(df: DataFrame, root: str, entity: str, blocks_per_part: int = 10_000) -> None:
    """Replace the height ranges that df has; other ranges stay. Rerunning a range is harmless.

    Rows are dealt by range of the sort key, so each file covers a narrow range of keys and
    its statistics let scans pass it over.
    """
    parts = df.withColumn("part", part_id(F.col("height"), blocks_per_part))
    parts = parts.repartitionByRange("part", *KEYS[entity]).sortWithinPartitions("part", *KEYS[entity])
    parts.write.partitionBy("part").mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").parquet(f"{root}/{entity}")


def scan(spark: SparkSession, root: str, entity: str, low: int, high: int, blocks_per_part: int = 10_000) -> DataFrame:
    """Heights low to high, both included; only their folders are listed and read."""
    rows = spark.read.parquet(f"{root}/{entity}")
    return rows.filter(F.col("part").between(low // blocks_per_part, high // blocks_per_part) & F.col("height").between(low, high)).drop("part")


def read(spark: SparkSession, root: str, entity: str, shape: DataFrame) -> DataFrame:
    """A whole table; without any rows so far, an empty one with the columns of ``shape``."""
    return spark.read.parquet(f"{root}/{entity}").drop("part") if exists(spark, f"{root}/{entity}") else shape.limit(0)


def merge(df: DataFrame, root: str, entity: str, blocks_per_part: int = 1000) -> None:
    """Put the heights of df into ranges that may hold others already; heights that df has are replaced."""
    spark = df.sparkSession
    fresh = written(df, entity)
    if exists(spark, f"{root}/{entity}"):
        heights = fresh.select("height").distinct()
        parts = heights.select(part_id(F.col("height"), blocks_per_part).alias("part")).distinct()
        older = spark.read.parquet(f"{root}/{entity}").join(F.broadcast(parts), "part", "left_semi").drop("part").join(heights, "height", "left_anti")  # parts: heights / blocks_per_part
        whole = written(fresh.unionByName(older.select(fresh.columns)), entity)
        forget(fresh)
        fresh = whole
    write(fresh, root, entity, blocks_per_part)
    forget(fresh)


def retract(spark: SparkSession, root: str, entity: str, fork: int, blocks_per_part: int = 10_000) -> None:
    """Remove heights above fork: higher ranges are dropped, the range of fork is rewritten."""
    kept = written(scan(spark, root, entity, fork // blocks_per_part * blocks_per_part, fork, blocks_per_part), entity)
    first = fork // blocks_per_part + (0 if kept.isEmpty() else 1)
    if first > fork // blocks_per_part:
        write(kept, root, entity, blocks_per_part)
    base, fs = _path(spark, f"{root}/{entity}")
    for status in fs.listStatus(base):
        name = status.getPath().getName()
        if name.startswith("part=") and int(name[5:]) >= first:
            fs.delete(status.getPath(), True)
    forget(kept)


def exists(spark: SparkSession, folder: str) -> bool:
    """Has the folder any height range?"""
    path, fs = _path(spark, folder)
    return fs.exists(path) and any(x.getPath().getName().startswith("part=") for x in fs.listStatus(path))


def _path(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def create_tables(spark: SparkSession, database: str, shapes: dict[str, DataFrame]) -> None:
    """A database and its tables, where they are missing, with the columns of ``shapes``; all are partitioned by height range."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, df in shapes.items():
        columns = ", ".join(f"{c} {kind}" for c, kind in df.dtypes)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}, part BIGINT) USING parquet PARTITIONED BY (part)")


def load(spark: SparkSession, database: str, entity: str, df: DataFrame, blocks_per_part: int = 10_000) -> None:
    """Fill a table of the catalog, columns by name; its height ranges that df has are replaced."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        parts = df.withColumn("part", part_id(F.col("height"), blocks_per_part))
        wanted = spark.table(f"{database}.{entity}").columns
        parts.repartitionByRange("part", *KEYS[entity]).sortWithinPartitions("part", *KEYS[entity]).select(wanted).write.insertInto(f"{database}.{entity}", overwrite=True)
    finally:
        spark.conf.set(key, before)
