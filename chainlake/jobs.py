"""Whole runs: index block files into the entity tables, print one block, time the stages."""

from __future__ import annotations

import json
import statistics
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import columns as C
from .operators import chain, spends
from .sources import blk, process, sinks
from .sources.shared import written

MODES = ("headers", "parse", "drain", "utxo", "sink", "full")
ZERO = "00" * 32


def header_index(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(all records, the first record of each header with prev and work, the main chain with places)."""
    records = written(blk.headers(spark, folder), "records")
    first = written(chain.first_seen(records.select("hash", "file_id", "offset", "record_len", "prev_hash", "bits"), "hash", "file_id", "offset"), "headers")
    nodes = first.select("hash", F.when(F.col("prev_hash") != F.unhex(F.lit(ZERO)), F.col("prev_hash")).alias("prev"), C.work_from_bits(F.col("bits")).alias("work"))
    main = chain.main_chain(nodes).join(first.select("hash", "file_id", "offset", "record_len"), "hash")
    return records, nodes, written(main, "chain")


def decode(spark: SparkSession, folder: str, main: DataFrame, low: int, high: int) -> DataFrame:
    """The main chain's blocks of heights low to below high; only these are decoded, each file is opened once."""
    wanted = main.filter((F.col("height") >= low) & (F.col("height") < high))
    raw = blk.payloads(blk.files(spark, folder), blk.xor_key(spark, folder), wanted)
    return blk.decoded(raw.join(wanted.select("file_id", "offset", "height"), ["file_id", "offset"]).select("height", "payload"))


def index(spark: SparkSession, folder: str, out: str, start: int = 0, end: int | None = None, orphans: set[bytes] = frozenset(), blocks_per_part: int = 10_000) -> dict:
    """Headers, chain, blocks, spends, fees, and the five entity and three lookup tables below ``out``.

    Outputs that a range spends from before it come from what ``out`` holds of lower heights.
    Returns the header counts and the rows of each table.
    """
    records, nodes, main = header_index(spark, folder)
    low, high = chain.clamped(start, end, main.agg(F.max("height")).first()[0])
    blocks = written(decode(spark, folder, main, low, high), "blocks")
    if orphans:
        blocks = chain.without(blocks, spark.createDataFrame([(bytearray(h),) for h in orphans], "hash binary"))
    older = None
    if low:
        shapes = blk.empty(spark)
        before = lambda name: sinks.read(spark, out, name, shapes[name]).filter(F.col("height") < low)
        older = spends.utxo_at(before("outputs").withColumnRenamed("output_index", "vout"), before("spends"), low - 1).withColumnRenamed("vout", "output_index")
    found = blk.linked(blk.tables(blocks), older)
    for name, df in (found | blk.serving(found)).items():
        sinks.write(df, out, name, blocks_per_part)
    counts = {name: sinks.read(spark, out, name, df).filter(F.col("height").between(low, high - 1)).count() for name, df in found.items()}
    return chain.header_stats(records, nodes, main).first().asDict() | {"low": low, "high": high} | counts


def inspect(spark: SparkSession, folder: str, height: int) -> str:
    """One block of the main chain as text: its header, its counts, its first three transactions."""
    main = header_index(spark, folder)[2]
    found = decode(spark, folder, main, height, height + 1)
    row = found.filter("tx_count is not null").first()
    if row is None:
        raise chain.EmptyRange(str(height))
    first = found.select(F.inline("transactions")).filter("tx_index < 3").orderBy("tx_index").collect()
    lines = [f"height {height} hash {bytes(row['hash'])[::-1].hex()}", f"prev {bytes(row['prev_hash'])[::-1].hex()} time {row['time']} bits {row['bits']:08x} nonce {row['nonce']}", f"transactions {row['tx_count']} size {row['size']} weight {row['weight']} coinbase {row['coinbase_value']}"]
    lines += [f"  {bytes(t['txid'])[::-1].hex()} inputs {t['input_count']} outputs {t['output_count']} size {t['size']}" for t in first]
    return "\n".join(lines)


def bench(spark: SparkSession, folder: str, mode: str = "full", repeat: int = 1, out: str | None = None, allow_missing: bool = False) -> list[dict]:
    """A report of each trial: seconds by stage up to the one that ``mode`` names, blocks and blocks a second.

    parse decodes and throws away, drain also deals the blocks by height, utxo links spends and
    needs all of them to be found, sink writes what was decoded, full does it all.
    """
    if mode not in MODES:
        raise ValueError(f"{mode}: one of {', '.join(MODES)}")
    noop = lambda df: df.write.format("noop").mode("overwrite").save()
    trials = []
    for _ in range(repeat):
        before = process.sample()
        stages: dict[str, float] = {}

        def timed(name: str, run):
            began = time.perf_counter()
            found = run()
            stages[name] = round(time.perf_counter() - began, 4)  # noqa: B023
            return found

        main = timed("headers", lambda: header_index(spark, folder)[2])
        n = main.count()
        if mode != "headers":
            blocks = timed("parse", lambda: written(decode(spark, folder, main, 0, n), "blocks"))  # noqa: B023
            if mode == "drain":
                timed("drain", lambda: noop(blocks.repartitionByRange("height").sortWithinPartitions("height")))
            tables = blk.tables(blocks)
            if mode in ("utxo", "full"):
                tables = blk.linked(tables)
                timed("utxo", lambda: noop(tables["spends"]))
                ins = tables["inputs"].withColumn("prev_txid", F.when(~F.col("is_coinbase"), F.col("prev_txid")))
                outs = tables["outputs"].select("txid", F.col("output_index").alias("vout"), "height", "tx_index", "value_sat", F.col("address_hash").alias("address"))
                if not allow_missing:
                    spends.require_all(spends.counters(ins, outs))
            if mode in ("sink", "full"):
                timed("sink", lambda: [sinks.write(df, out, name) if out else noop(df) for name, df in tables.items()])
        total = sum(stages.values())
        trials.append({"mode": mode, "blocks": n, "stages": stages, "seconds": round(total, 4), "blocks_per_second": round(n / total, 2) if total else None, "driver_cpu_share": process.cpu_share(before, process.sample()), "driver_peak_rss_kb": process.sample()["peak_rss_kb"]})
    return trials


def matrix(spark: SparkSession, folder: str, shuffles: tuple[int, ...] = (8, 64, 256), repeat: int = 1) -> list[dict]:
    """Every mode with the session's partitions, and the full run at several numbers of shuffle partitions."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    found = [t | {"partitions": int(before)} for mode in MODES for t in bench(spark, folder, mode, repeat, allow_missing=True)]
    try:
        for n in shuffles:
            spark.conf.set(key, n)
            found += [t | {"partitions": n} for t in bench(spark, folder, "full", repeat, allow_missing=True)]
    finally:
        spark.conf.set(key, before)
    return found


def report(trials: list[dict]) -> str:
    """JSON of the trials, with the least, the median and the largest seconds of each stage."""
    stages = {k: [t["stages"][k] for t in trials if k in t["stages"]] for t in trials for k in t["stages"]}
    return json.dumps({"trials": trials, "stages": {k: {"low": min(x), "median": statistics.median(x), "high": max(x)} for k, x in stages.items()}}, indent=1)
