"""Sharding by proportional stratified interleaving (operator 10), with DataFrame functions only.

Rows are shuffled within each source by a seeded hash; a row's fractional rank is
(rank + u) / (rows of its source), with an offset u in [0, 1) that the seed and the source
give, so that many small sources do not all fall into the same shards. Sorting all rows by it interleaves the sources in
proportion, and cutting the order into equal runs gives shards that all match the mixture
and differ by at most one row.

Neither a source nor the whole table is ever ranked in one task. Ranks are a prefix sum of
bucket counts plus a rank within the bucket: buckets of the hash within a source, then
buckets of the fractional rank, both sized to about ``bucket_rows`` rows. Only the counts
per bucket (rows / bucket_rows of them) meet in one place.

Edge cases: null is a source; a null text has size 1 and the crc of no bytes; rows with
equal ids and texts are interchangeable and each gets a slot; an empty table gives an empty
table; columns other than id, text and source are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import store


def _rank(df: DataFrame, within: list[str], bucket: str, order: list[Column], name: str) -> DataFrame:
    """``name``: each row's rank from 0 within the group ``within``, ordered by bucket, then ``order``."""
    keys = [*within, bucket]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*within).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    local = df.withColumn("_local", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)
    return local.join(counts, keys).withColumn(name, F.col("_before") + F.col("_local")).drop("_before", "_local")


def interleave(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", shards: int = 8, seed: str = "shard", bucket_rows: int = 5_000) -> DataFrame:
    """id, size, text_crc32, shard and slot of each row."""
    rows = docs.select(
        F.col(id).alias("id"),
        F.concat(F.when(F.col(source).isNull(), F.lit("n")).otherwise(F.lit("s")), F.coalesce(F.col(source), F.lit(""))).alias("stratum"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    rows = rows.withColumn("draw", F.xxhash64(F.lit(seed), "id", "text_crc32", "size"))
    rows = store(rows, "shard-rows")
    total = rows.count()
    parts = max(1, -(-total // bucket_rows))
    tie = [F.col("draw"), F.col("id"), F.col("text_crc32"), F.col("size")]
    # the hash is uniform, so equal ranges of it hold about equal numbers of a source's rows
    rows = rows.withColumn("bucket", F.floor((F.col("draw") / F.lit(2.0**64) + 0.5) * parts))
    ranked = _rank(rows, ["stratum"], "bucket", tie, "rank")
    sizes = rows.groupBy("stratum").agg(F.count(F.lit(1)).alias("in_stratum"))
    ranked = _with_sizes(ranked, sizes)
    offset = F.xxhash64(F.lit(seed), "stratum", F.lit("offset")).bitwiseAND((1 << 30) - 1) / F.lit(float(1 << 30))
    ranked = ranked.withColumn("part", (F.col("rank") + offset) / F.col("in_stratum"))
    ranked = ranked.withColumn("slice", F.least(F.floor(F.col("part") * parts), F.lit(parts - 1))).withColumn("_all", F.lit(0))
    placed = _rank(ranked, ["_all"], "slice", [F.col("part"), F.col("stratum"), F.col("rank")], "place")
    # shard s holds the places from ceil(s * total / shards) on
    shard = F.expr(f"(place * {shards}) div {max(total, 1)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard.cast("int")).select(
        F.col("id").alias(id), "size", "text_crc32", "shard", (F.col("place") - first).cast("long").alias("slot")
    )


def _with_sizes(ranked: DataFrame, sizes: DataFrame, broadcast_sources: int = 100_000, salts: int = 64) -> DataFrame:
    """Joined by broadcast when the strata are few, which a count checks, else by a salted shuffle."""
    if sizes.limit(broadcast_sources + 1).count() <= broadcast_sources:
        return ranked.join(F.broadcast(sizes), "stratum")
    sizes = sizes.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return ranked.withColumn("_salt", F.pmod(F.col("draw"), F.lit(salts)).cast("int")).join(sizes, ["stratum", "_salt"]).drop("_salt")
