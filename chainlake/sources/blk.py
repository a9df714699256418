"""Block files (blk00000.dat ...) as DataFrames: nested rows of some transactions of a block each; then five flat tables and three for lookups.

The content of files is (file_id, content), whole files, or (file_id, start, content): pieces
of whole records, or of padding, from place ``start`` on. No file need fit in memory then.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import spends
from . import codec
from .shared import written

_IN = "input_index long, prev_txid binary, prev_vout long, script_sig_len long, sequence long, witness_items long, witness_bytes long, is_coinbase boolean"
_OUT = "output_index long, value_sat long, script_pubkey_len long, script_type int, address_hash binary"
_TX = f"txid binary, version int, locktime long, size long, weight long, fee long, input_count long, output_count long, has_witness boolean, inputs array<struct<{_IN.replace(' ', ':').replace(',:', ',')}>>, outputs array<struct<{_OUT.replace(' ', ':').replace(',:', ',')}>>, tx_index long"
HEADER = "hash binary, prev_hash binary, merkle_root binary, version int, time long, bits long, nonce long"
WHERE = "file_id int, offset long, record_len long"
#: Most transactions of a row, and about as many rows, inputs and outputs of a batch.
PART, BATCH = 16, 10_000


class NoFiles(FileNotFoundError):
    """A folder without any block file."""


def files(spark: SparkSession, folder: str) -> DataFrame:
    """(file_id, content) of the block files, one task a file; these have at most 128 MB. Other names are passed over."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "blk[0-9][0-9][0-9][0-9][0-9].dat").load(folder)
    if raw.select("path").isEmpty():
        raise NoFiles(folder)
    return raw.select(F.regexp_extract("path", r"blk(\d{5})\.dat$", 1).cast("int").alias("file_id"), "content")


def xor_key(spark: SparkSession, folder: str) -> bytes | None:
    found = spark.read.format("binaryFile").option("pathGlobFilter", "xor.dat").load(folder).select("content").head(1)
    return bytes(found[0][0]) if found else None


def network(content: DataFrame, key: bytes | None) -> str | None:
    """The network of the first file."""
    head = _placed(content).orderBy("file_id", "start").select(F.substring("content", 1, 8)).head(1)
    return codec.network_of(bytes(head[0][0]), key) if head else None


def _placed(content: DataFrame) -> DataFrame:
    start = "start" if "start" in content.columns else F.lit(0).cast("long").alias("start")
    return content.select("file_id", start, "content")


def _batched(rows: Iterator[dict], kinds: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows in batches that end after a row if they hold BATCH rows, inputs and outputs or more."""
    found, n = [], 0
    for row in rows:
        found.append(row)
        n += 1 + sum(t["input_count"] + t["output_count"] for t in row.get("transactions", ()))
        if n >= BATCH:
            yield pa.RecordBatch.from_pylist(found, kinds)
            found, n = [], 0
    if found:
        yield pa.RecordBatch.from_pylist(found, kinds)


def _scan(content: DataFrame, key: bytes | None, schema: str, decode) -> DataFrame:
    """The rows ``decode(payload)`` of each record of the content, with its place; a bad one fails with file and offset."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for file_id, start, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                data, offset = codec.unmask(content.as_buffer().to_pybytes(), key, start), 0
                try:
                    for offset, payload in codec.records(data):
                        place = {"file_id": file_id, "offset": start + offset, "record_len": len(payload)}
                        for row in decode(payload):
                            yield place | row
                except codec.BadBlock as e:
                    raise codec.BadBlock(f"file {file_id}, record at {start + offset}: {e}") from e

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    shape = StructType.fromDDL(schema)
    kinds = to_arrow_schema(shape)
    return _placed(content).mapInArrow(lambda batches: _batched(rows(batches), kinds), shape)


def headers_of(content: DataFrame, key: bytes | None = None) -> DataFrame:
    """The header pass: 80 bytes a record are decoded, payloads never leave the reader."""
    return _scan(content, key, f"{WHERE}, {HEADER}", lambda payload: [codec.header(payload)])


def blocks_of(content: DataFrame, key: bytes | None = None) -> DataFrame:
    """Blocks in parts of at most PART transactions; the last part of each has the block's sums (tx_count and so on), which are null in the others."""
    return _scan(content, key, f"{WHERE}, {_BLOCK}", lambda payload: codec.parts(payload, PART))


def sums_of(content: DataFrame, key: bytes | None = None) -> DataFrame:
    """A row a block: place, header and sums. Every transaction is decoded, and a bad one fails, but none leaves the reader."""

    def last(payload: bytes) -> Iterator[dict]:
        for row in codec.parts(payload, PART):
            del row["transactions"]
            if row["tx_count"] is not None:
                yield row

    return _scan(content, key, f"{WHERE}, {HEADER}, {_SUMS}", last)


def headers(spark: SparkSession, folder: str) -> DataFrame:
    return headers_of(files(spark, folder), xor_key(spark, folder))


def blocks(spark: SparkSession, folder: str) -> DataFrame:
    return blocks_of(files(spark, folder), xor_key(spark, folder))


def decoded(payloads: DataFrame) -> DataFrame:
    """Blocks of (height, payload) rows, as from a node, in parts as from :func:`blocks_of`."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for height, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                for row in codec.parts(payload.as_buffer().to_pybytes(), PART):
                    yield {"height": height} | row

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    shape = StructType.fromDDL(f"height long, {_BLOCK}")
    kinds = to_arrow_schema(shape)
    return payloads.select("height", "payload").mapInArrow(lambda batches: _batched(rows(batches), kinds), shape)


def as_frame(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Blocks decoded on the driver (a tip follower's few) as a DataFrame."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    shape = StructType.fromDDL(f"height long, {_BLOCK}")
    return spark.createDataFrame(pa.Table.from_pylist(rows, to_arrow_schema(shape)), shape)


def empty(spark: SparkSession) -> dict[str, DataFrame]:
    """All entity and lookup tables without rows."""
    found = linked(tables(as_frame(spark, [])))
    return found | serving(found)


def payloads(content: DataFrame, key: bytes | None, where: DataFrame, sent: int = 100_000) -> DataFrame:
    """(file_id, offset, payload) of the records that ``where`` (file_id, offset, record_len) names; each file or piece is opened once.

    A place outside its file, or over the end of a piece, fails. Few places (counted) go by broadcast, so the content is not shuffled.
    """
    where = where.select("file_id", "offset", "record_len")
    few = where.limit(sent + 1).count() <= sent
    if "start" in content.columns:  # the last piece that starts at the place or before it
        marks = where.unionByName(content.select("file_id", "start", F.col("start").alias("offset")), allowMissingColumns=True)
        so_far = Window.partitionBy("file_id").orderBy("offset", F.col("start").isNull())
        where = marks.withColumn("start", F.last("start", ignorenulls=True).over(so_far)).filter("record_len is not null")
    else:
        where = where.withColumn("start", F.lit(0).cast("long"))
    wanted = where.groupBy("file_id", "start").agg(F.sort_array(F.collect_list(F.struct("offset", "record_len"))).alias("places"))  # as many as a file or piece has records
    if few:
        wanted = F.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file_id, start, content, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist()):
                data = codec.unmask(content.as_buffer().to_pybytes(), key, start)
                for x in places:
                    begin = x["offset"] + 8 - start
                    end = begin + x["record_len"]
                    if end > len(data):
                        raise codec.BadBlock(f"file {file_id}: {start + end} is beyond its {start + len(data)} bytes")
                    yield pa.RecordBatch.from_pydict({"file_id": pa.array([file_id], pa.int32()), "offset": [x["offset"]], "payload": pa.array([data[begin:end]], pa.binary())})

    return _placed(content).join(wanted, ["file_id", "start"]).select("file_id", "start", "content", "places").mapInArrow(run, "file_id int, offset long, payload binary")


def _split(text: str) -> list[str]:
    out, depth = [""], 0
    for ch in text:
        depth += (ch == "<") - (ch == ">")
        if ch == "," and not depth:
            out.append("")
        else:
            out[-1] += ch
    return out


_SUMS = "tx_count long, size long, weight long, total_fee long, coinbase_value long"
_BLOCK = f"{HEADER}, {_SUMS}, transactions array<struct<{','.join(x.strip().replace(' ', ':', 1) for x in _split(_TX))}>>"


def tables(decoded: DataFrame) -> dict[str, DataFrame]:
    """blocks, transactions, inputs and outputs of decoded blocks, whole or in parts, that have a ``height`` column; fees are 0 so far."""
    tx = decoded.select("height", F.inline("transactions"))
    return {
        "blocks": decoded.filter("tx_count is not null").select("height", *[x.split()[0] for x in HEADER.split(", ")], "tx_count", "size", "weight", "total_fee", "coinbase_value"),
        "transactions": tx.select("height", "tx_index", "txid", "version", "locktime", "size", "weight", "fee", "input_count", "output_count", "has_witness"),
        "inputs": tx.select("height", "tx_index", "txid", F.inline("inputs")),
        "outputs": tx.select("height", "tx_index", "txid", F.inline("outputs")),
    }


def linked(found: dict[str, DataFrame], older: DataFrame | None = None, keep: bool = False) -> dict[str, DataFrame]:
    """The five entity tables: ``tables`` with the spends, and with fees in transactions and blocks.

    older: unspent outputs (columns of ``outputs``) from before these blocks, for blocks that come later.
    keep: the links are written, for callers that use several of the tables.
    """
    made = found["outputs"] if older is None else found["outputs"].unionByName(older.select(found["outputs"].columns))
    outs = made.select("txid", F.col("output_index").alias("vout"), "height", "tx_index", "value_sat", F.struct("address_hash", "script_type").alias("address"))
    ins = found["inputs"].withColumn("prev_txid", F.when(~F.col("is_coinbase"), F.col("prev_txid")))
    links = spends.link_spends(ins, outs)
    if keep:
        links = written(links, "links")
    fees = spends.tx_fees(ins, outs if older is None else outs.join(found["blocks"].select("height"), "height", "left_semi"), links)
    paid = fees.select("height", "tx_index", F.col("fee").alias("paid"))
    total = spends.block_fees(fees).select("height", F.col("total_fee").alias("paid"))
    own = found["transactions"].join(paid, ["height", "tx_index"], "left").withColumn("fee", F.coalesce("paid", "fee"))
    whole = found["blocks"].join(total, "height", "left").withColumn("total_fee", F.coalesce("paid", "total_fee"))
    return found | {
        "blocks": whole.select(found["blocks"].columns), "transactions": own.select(found["transactions"].columns),
        "spends": links.select(
            "height", F.col("tx_index").alias("spending_tx_index"), F.col("input_index").alias("spending_input_index"), F.col("txid").alias("spending_txid"), "spent_txid", "spent_vout",
            "spent_value_sat", F.col("spent_address.script_type").alias("spent_script_type"), F.col("spent_address.address_hash").alias("spent_address_hash"), "spent_height",
        ),
    }


def serving(found: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables for lookups by txid, by outpoint and by address."""
    return {
        "transactions_by_txid": found["transactions"].select("txid", "height", "tx_index"),
        "inputs_by_prev_output": found["inputs"].filter(~F.col("is_coinbase")).select("prev_txid", "prev_vout", "height", "tx_index", "input_index", "txid"),
        "outputs_by_address": found["outputs"].select("address_hash", "script_type", "height", "tx_index", "output_index", "txid", "value_sat"),
    }
