"""Queries over block files that are built, byte by byte, from the order tables: the decoder, the spend link, the sinks and the tip follower.

An order is a transaction, a day a block, 400 days a file. Each second order of a customer
spends the outputs of the one before it; the others bring new coins. The same bytes are
written out in SQL, so every decoded field has its SQL.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import chain, spends
from ..sources import blk, codec, shared, sinks
from ..streaming import live
from .adapter import LINE, table
from .register import query

KEY = bytes.fromhex("1122334455667788")
FILE_BLOCKS, ZEROS = 400, "00" * 32


def _le(value: Column, width: int) -> Column:
    return F.lower(C.reversed_hex(F.lpad(F.hex(value.cast("long")), 2 * width, "0")))


def _joined(order: str, text: Column) -> Column:
    return F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), text.alias("text")))), lambda x: x["text"]))


def _dsha(text: Column) -> Column:
    return F.sha2(F.unhex(F.sha2(F.unhex(text), 256)), 256)


def _payloads(s: SparkSession, d: str) -> DataFrame:
    """(height, payload): the blocks' bytes. The orders with their outputs are written on the way."""
    own, day = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"), Window.partitionBy("o_orderdate").orderBy("o_orderkey")
    orders = table(s, d, "orders").select(
        F.col("o_orderkey").alias("k"), F.datediff("o_orderdate", F.lit("1995-01-01")).cast("long").alias("height"), (F.row_number().over(day) - 1).alias("tx_index"),
        ((F.row_number().over(own) - 1) % 2 == 0).alias("fresh"), F.lag("o_orderkey").over(own).alias("before"),
    )
    seed = F.sha2(F.col("l_suppkey").cast("string"), 256)
    short = F.substring(seed, 1, 40)
    script = F.element_at(F.array(F.concat(F.lit("76a914"), short, F.lit("88ac")), F.concat(F.lit("a914"), short, F.lit("87")), F.concat(F.lit("0014"), short), F.concat(F.lit("0020"), seed), F.concat(F.lit("5120"), seed), F.lit("6a04deadbeef"), F.lit("ff")), F.col("l_linenumber").cast("int"))
    lines = table(s, d, "lineitem").select(F.col("l_orderkey").alias("k"), (F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*LINE)) - 1).alias("i"), F.round(F.col("l_extendedprice") * 100).cast("long").alias("value"), script.alias("script"))
    coin = F.concat(_le(F.col("value"), 8), _le(F.length("script") / 2, 1), "script")
    outs = lines.groupBy("k").agg(F.count(F.lit(1)).alias("n"), _joined("i", coin).alias("outs"))
    orders = shared.written(orders.join(outs, "k", "left").select(*orders.columns, F.coalesce("n", F.lit(0)).alias("n"), F.unhex(F.coalesce("outs", F.lit(""))).alias("outs")), "orders")
    orders = orders.withColumn("outs", F.hex("outs"))
    tail = F.concat(_le(F.col("n"), 1), "outs", _le(F.col("height"), 4))
    fresh = orders.filter("fresh").withColumn("plain", F.concat(F.lit(f"0200000001{ZEROS}ffffffff04"), _le(F.col("k"), 4), F.lit("ffffffff"), tail))
    known = fresh.select(F.col("k").alias("before"), _dsha(F.col("plain")).alias("txid"))
    late = orders.filter("not fresh").join(known, "before").withColumn("ins", F.sequence(F.lit(0), F.greatest("n", F.lit(1)) - 1))
    body = F.concat(_le(F.size("ins"), 1), F.concat_ws("", F.transform("ins", lambda i: F.concat("txid", _le(i, 4), F.lit("00ffffffff")))), _le(F.col("n"), 1), "outs")
    witness = F.concat_ws("", F.transform("ins", lambda i: F.when(i % 2 == 0, F.lit("0101aa")).otherwise(F.lit("0201aa02aaaa"))))
    segwit = F.col("k") % 3 == 0
    late = late.withColumn("plain", F.concat(F.lit("02000000"), F.when(segwit, F.lit("0001")).otherwise(F.lit("")), body, F.when(segwit, witness).otherwise(F.lit("")), _le(F.col("height"), 4)))
    whole = fresh.select("height", "tx_index", F.unhex("plain").alias("plain")).union(late.select("height", "tx_index", F.unhex("plain")))

    def join(batches):
        """One block at a time of rows in the order of height and tx_index."""
        at, txs = None, []
        for batch in batches:
            for height, plain in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if txs and height != at:
                    yield one(at, txs)
                    txs = []
                at = height
                txs.append(plain)
        if txs:
            yield one(at, txs)

    def one(height, txs):
        return pa.RecordBatch.from_pydict({"height": pa.array([height], pa.int64()), "n": pa.array([len(txs)], pa.int64()), "txs": pa.array([b"".join(txs)], pa.binary())})

    blocks = whole.repartition("height").sortWithinPartitions("height", "tx_index").select("height", "plain").mapInArrow(join, "height long, n long, txs binary")
    head = F.concat(F.lit("01000000"), F.sha2((F.col("height") - 1).cast("string"), 256), F.sha2(F.concat(F.lit("m"), F.col("height").cast("string")), 256), _le(1_000_000_000 + 600 * F.col("height"), 4), F.lit("ffff001d"), _le(F.col("height"), 4))
    return blocks.select("height", F.concat(F.unhex(F.concat(head, F.lower(C.varint_hex(F.col("n"))))), "txs").alias("payload"))


def _files(s: SparkSession, d: str) -> DataFrame:
    """(file_id, start, content): masked files with zero padding at the end, a piece for each block, so no row holds a file."""
    raw = _payloads(s, d)
    blocks = shared.written(raw.withColumn("size", F.octet_length("payload")), "payloads", shared.LARGE)
    shared.forget(raw)
    file = Window.partitionBy("file_id").orderBy("height")
    own = blocks.select("height", "size", F.floor(F.col("height") / FILE_BLOCKS).cast("int").alias("file_id"))
    places = own.select("height", "file_id", (F.sum(F.col("size") + 8).over(file) - F.col("size") - 8).alias("start"), F.lead("height").over(file).isNull().alias("last"))
    record = F.concat(F.unhex(F.lit("f9beb4d9")), F.unhex(_le(F.col("size"), 4)), "payload", F.when(F.col("last"), F.unhex(F.lit("00" * 64))).otherwise(F.unhex(F.lit(""))))
    plain = blocks.join(F.broadcast(places), "height").select("file_id", "start", record.alias("content"))  # one row a day on the right

    def mask(batches):
        for batch in batches:
            for i, start, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                yield pa.RecordBatch.from_pydict({"file_id": pa.array([i], pa.int32()), "start": pa.array([start], pa.int64()), "content": pa.array([codec.unmask(content.as_buffer().to_pybytes(), KEY, start)], pa.binary())})

    return plain.mapInArrow(mask, "file_id int, start long, content binary")


def _tables(s: SparkSession, d: str) -> dict[str, DataFrame]:
    content = _files(s, d)
    blocks = shared.written(blk.blocks_of(content, KEY).withColumn("height", F.col("nonce")), "decoded", shared.LARGE)
    shared.forget(content)
    return blk.tables(blocks)


def _le_sql(value: str, width: int) -> str:
    return "(" + " || ".join(f"printf('%02x', (({value})::BIGINT >> {8 * i}) & 255)" for i in range(width)) + ")"


_TYPES = "[2, 3, 4, 5, 6, 8, 0]"
#: The same blocks, transactions, inputs, outputs and spends.
SQL = f"""
o AS (SELECT o_orderkey AS k, date_diff('day', TIMESTAMP '1995-01-01', o_orderdate)::BIGINT AS height, row_number() OVER (PARTITION BY o_orderdate ORDER BY o_orderkey) - 1 AS tx_index,
      (row_number() OVER own - 1) % 2 = 0 AS fresh, lag(o_orderkey) OVER own AS before FROM orders WINDOW own AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
l0 AS (SELECT l_orderkey AS k, row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(LINE)}) - 1 AS i, round(l_extendedprice * 100)::BIGINT AS value, l_linenumber AS kind, sha256(l_suppkey::VARCHAR) AS seed FROM lineitem),
l AS (SELECT *, ['76a914' || seed[:40] || '88ac', 'a914' || seed[:40] || '87', '0014' || seed[:40], '0020' || seed, '5120' || seed, '6a04deadbeef', 'ff'][kind] AS script, {_TYPES}[kind]::BIGINT AS script_type,
      CASE WHEN kind <= 3 THEN seed[:40] || repeat('0', 24) WHEN kind <= 5 THEN seed ELSE repeat('0', 64) END AS address_hash FROM l0),
og AS (SELECT k, count(*) AS n, string_agg({_le_sql('value', 8)} || {_le_sql('length(script) // 2', 1)} || script, '' ORDER BY i) AS outs FROM l GROUP BY 1),
t0 AS (SELECT o.*, coalesce(n, 0) AS n, coalesce(outs, '') AS outs FROM o LEFT JOIN og USING (k)),
fr AS (SELECT *, '0200000001{ZEROS}ffffffff04' || {_le_sql('k', 4)} || 'ffffffff' || {_le_sql('n', 1)} || outs || {_le_sql('height', 4)} AS plain FROM t0 WHERE fresh),
fx AS (SELECT *, plain AS whole, sha256(unhex(sha256(unhex(plain)))) AS txid FROM fr),
la AS (SELECT t0.*, fx.txid AS spent, greatest(t0.n, 1) AS n_in FROM t0 JOIN fx ON t0.before = fx.k WHERE NOT t0.fresh),
lb AS (SELECT *, {_le_sql('n_in', 1)} || (SELECT string_agg(spent || {_le_sql('i', 4)} || '00ffffffff', '' ORDER BY i) FROM range(n_in) r(i)) || {_le_sql('n', 1)} || outs AS body,
       (SELECT string_agg(CASE WHEN i % 2 = 0 THEN '0101aa' ELSE '0201aa02aaaa' END, '' ORDER BY i) FROM range(n_in) r(i)) AS witness, k % 3 = 0 AS segwit FROM la),
lx AS (SELECT *, sha256(unhex(sha256(unhex('02000000' || body || {_le_sql('height', 4)})))) AS txid, CASE WHEN segwit THEN '020000000001' || body || witness ELSE '02000000' || body END || {_le_sql('height', 4)} AS whole,
       length(body) // 2 + 8 AS stripped FROM lb),
tx AS (SELECT height, tx_index, txid, whole, length(whole) // 2 AS size, 4 * (length(whole) // 2) AS weight, 1::BIGINT AS n_in, n, false AS segwit, fresh, NULL::VARCHAR AS spent, k FROM fx
       UNION ALL SELECT height, tx_index, txid, whole, length(whole) // 2, 3 * stripped + length(whole) // 2, n_in, n, segwit, fresh, spent, k FROM lx),
b0 AS (SELECT height, count(*) AS tx_count, sum(weight) AS weights, string_agg(whole, '' ORDER BY tx_index) AS txs FROM tx GROUP BY 1),
b AS (SELECT *, '01000000' || sha256((height - 1)::VARCHAR) || sha256('m' || height) || {_le_sql('1000000000 + 600 * height', 4)} || 'ffff001d' || {_le_sql('height', 4)} AS head,
      80 + CASE WHEN tx_count < 253 THEN 1 ELSE 3 END + length(txs) // 2 AS size FROM b0),
outs AS (SELECT height, tx_index, i AS output_index, txid, value AS value_sat, length(script) // 2 AS script_pubkey_len, script_type, address_hash FROM l JOIN tx USING (k)),
ins AS (SELECT height, tx_index, i AS input_index, txid, CASE WHEN fresh THEN '{ZEROS}' ELSE spent END AS prev_txid, CASE WHEN fresh THEN 4294967295 ELSE i END AS prev_vout, CASE WHEN fresh THEN 4 ELSE 0 END::BIGINT AS script_sig_len,
        4294967295 AS sequence, CASE WHEN segwit THEN 1 + i % 2 ELSE 0 END AS witness_items, CASE WHEN segwit THEN 1 + 2 * (i % 2) ELSE 0 END AS witness_bytes, fresh AS is_coinbase FROM tx, range(n_in) r(i)),
spends AS (SELECT i.height, i.tx_index AS spending_tx_index, input_index AS spending_input_index, i.txid AS spending_txid, o.txid AS spent_txid, output_index AS spent_vout, value_sat AS spent_value_sat,
           script_type AS spent_script_type, address_hash AS spent_address_hash, o.height AS spent_height FROM ins i JOIN outs o ON prev_txid = o.txid AND prev_vout = output_index WHERE NOT is_coinbase AND o.height <= i.height),
made AS (SELECT height, tx_index, sum(value_sat) AS made FROM outs GROUP BY 1, 2), paid AS (SELECT height, spending_tx_index AS tx_index, sum(spent_value_sat) AS paid FROM spends GROUP BY 1, 2),
fees AS (SELECT height, tx_index, CASE WHEN fresh THEN 0 ELSE greatest(coalesce(paid, 0) - coalesce(made, 0), 0) END::BIGINT AS fee FROM tx LEFT JOIN made USING (height, tx_index) LEFT JOIN paid USING (height, tx_index))
"""


def _shown(df: DataFrame) -> DataFrame:
    """Binary columns as lower-case hex in stored order."""
    return df.select(*[F.lower(F.hex(c)).alias(c) if kind == "binary" else F.col(c).cast("long").alias(c) if kind in ("int", "bigint") else F.col(c) for c, kind in df.dtypes])


@query("SELECT (height // 400)::BIGINT AS file_id, (sum(8 + size) OVER (PARTITION BY height // 400 ORDER BY height) - 8 - size)::BIGINT AS offset, size AS record_len, sha256(unhex(sha256(unhex(head)))) AS hash, head[9:72] AS prev_hash, head[73:136] AS merkle_root, 1::BIGINT AS version, 1000000000 + 600 * height AS time, 486604799::BIGINT AS bits, height AS nonce FROM b", SQL)
def blk_headers(s, d):
    return _shown(blk.headers_of(_files(s, d), KEY))


@query("SELECT height, sha256(unhex(sha256(unhex(head)))) AS hash, head[9:72] AS prev_hash, head[73:136] AS merkle_root, 1::BIGINT AS version, 1000000000 + 600 * height AS time, 486604799::BIGINT AS bits, height AS nonce, tx_count, size, (weights + 320)::BIGINT AS weight, (SELECT sum(fee) FROM fees WHERE fees.height = b.height)::BIGINT AS total_fee, (SELECT coalesce(sum(value_sat), 0) FROM outs WHERE outs.height = b.height AND tx_index = 0)::BIGINT AS coinbase_value FROM b", SQL)
def blk_blocks(s, d):
    return _shown(blk.linked(_tables(s, d))["blocks"])


@query("SELECT height, tx_index, txid, 2::BIGINT AS version, height AS locktime, size, weight, fee, n_in AS input_count, n AS output_count, segwit AS has_witness FROM tx JOIN fees USING (height, tx_index)", SQL)
def blk_transactions(s, d):
    return _shown(blk.linked(_tables(s, d))["transactions"])


@query("SELECT * FROM ins", SQL)
def blk_inputs(s, d):
    return _shown(_tables(s, d)["inputs"])


@query("SELECT * FROM outs", SQL)
def blk_outputs(s, d):
    return _shown(_tables(s, d)["outputs"])


@query("SELECT * FROM spends", SQL)
def blk_spends(s, d):
    return _shown(blk.linked(_tables(s, d))["spends"])


@query("SELECT height, sha256(unhex(head || CASE WHEN tx_count < 253 THEN printf('%02x', tx_count) ELSE 'fd' || printf('%02x%02x', tx_count % 256, tx_count // 256) END || txs)) AS sha FROM b WHERE tx_count % 2 = 0", SQL)
def blk_payloads(s, d):
    """Records read by their place: the blocks with an even number of transactions, whose payloads the first pass did not keep."""
    files = _files(s, d)
    content = shared.written(files, "files", shared.LARGE)  # read three times, once for the places of its pieces alone
    shared.forget(files)
    where = shared.written(blk.sums_of(content, KEY).filter("tx_count % 2 = 0").select("file_id", "offset", "record_len", F.col("nonce").alias("height")), "places")
    found = blk.payloads(content, KEY, where).select("file_id", "offset", F.sha2("payload", 256).alias("sha"))  # before the join, which may deal out its rows
    return found.join(where, ["file_id", "offset"]).select("height", "sha")


@query("SELECT 'mainnet' AS network", SQL)
def blk_network(s, d):
    """Of the whole folder: the files' first magic names it."""
    return s.createDataFrame([(blk.network(_files(s, d), KEY),)], "network string")


def _root(s: SparkSession) -> str:
    return f"{shared.checkpoint_dir(s).rstrip('/')}/chain-{uuid.uuid4().hex}"


@query("SELECT height, spending_tx_index, spending_input_index, spent_txid, spent_vout, spent_value_sat FROM spends WHERE height BETWEEN 350 AND 1449", SQL)
def sink_range_scan(s, d):
    """All five tables are written by height range, then a range is read back."""
    root = _root(s)
    for name, df in blk.linked(_tables(s, d), keep=True).items():
        sinks.write(df, root, name, 100)
    return _shown(sinks.scan(s, root, "spends", 350, 1449, 100)).select("height", "spending_tx_index", "spending_input_index", "spent_txid", "spent_vout", "spent_value_sat")


@query("SELECT height, tx_index, output_index, value_sat FROM outs WHERE height <= 1234", SQL)
def sink_retract(s, d):
    """Heights above 1234 are written and taken back."""
    root = _root(s)
    sinks.write(_tables(s, d)["outputs"], root, "outputs", 100)
    sinks.retract(s, root, "outputs", 1234, 100)
    return _shown(s.read.parquet(f"{root}/outputs").select("height", "tx_index", "output_index", "value_sat"))


def _serving(s: SparkSession, d: str, name: str) -> DataFrame:
    root = _root(s)
    sinks.write(blk.serving(_tables(s, d))[name], root, name, 500)
    return s.read.parquet(f"{root}/{name}")


@query("SELECT height, tx_index, array_to_string(list_reverse(regexp_extract_all(txid, '..')), '') AS txid FROM tx WHERE height = 777", SQL)
def txs_of_height(s, d):
    root = _root(s)
    sinks.write(_tables(s, d)["transactions"], root, "transactions", 100)
    return sinks.scan(s, root, "transactions", 777, 777, 100).select("height", F.col("tx_index").cast("long"), C.display_hex(F.col("txid")).alias("txid"))


@query("SELECT height, tx_index, txid FROM tx WHERE txid = (SELECT min(txid) FROM tx)", SQL)
def lookup_by_txid(s, d):
    found = _serving(s, d, "transactions_by_txid")
    least = found.agg(F.min("txid").alias("txid"))
    return _shown(found.join(F.broadcast(least), "txid").select("height", "tx_index", "txid"))  # one row on the right


@query("SELECT prev_txid, prev_vout, height, tx_index, input_index, txid FROM ins WHERE NOT is_coinbase AND prev_vout = 0 AND prev_txid < '10'", SQL)
def lookup_spender(s, d):
    found = _serving(s, d, "inputs_by_prev_output")
    return _shown(found.filter((F.col("prev_vout") == 0) & (F.col("prev_txid") < F.unhex(F.lit("10")))).select("prev_txid", "prev_vout", "height", "tx_index", "input_index", "txid"))


@query("SELECT height, tx_index, output_index, txid, value_sat FROM outs WHERE address_hash = sha256('7')", SQL)
def lookup_by_address(s, d):
    found = _serving(s, d, "outputs_by_address")
    return _shown(found.filter(F.col("address_hash") == F.unhex(F.sha2(F.lit("7"), 256))).select("height", "tx_index", "output_index", "txid", "value_sat"))


def _outs(found: dict[str, DataFrame]) -> DataFrame:
    return found["outputs"].select("txid", F.col("output_index").alias("vout"), "height", "tx_index", "value_sat")


@query("SELECT txid, output_index AS vout, height, value_sat FROM outs o WHERE height <= 1500 AND NOT EXISTS (SELECT 1 FROM spends s WHERE s.spent_txid = o.txid AND s.spent_vout = output_index AND s.height <= 1500)", SQL)
def disconnect_to_fork(s, d):
    """The unspent outputs of the tip, taken back to height 1500 by the undo rows of each height above it."""
    found = blk.linked(_tables(s, d))
    outs = _outs(found)
    unspent = spends.utxo_at(outs, found["spends"], 1 << 40)
    back = spends.disconnected(unspent, spends.undo_rows(outs, found["spends"]), outs, 1500)
    return _shown(back.select("txid", "vout", "height", "value_sat"))


@query("SELECT count(*) AS inputs, count(*) FILTER (is_coinbase) AS coinbase, (SELECT count(*) FROM spends) AS linked, (SELECT count(*) FROM spends WHERE height = spent_height) AS same_block, (SELECT count(*) FROM spends WHERE height - spent_height BETWEEN 1 AND 100) AS recent, (SELECT count(*) FROM spends WHERE height - spent_height > 100) AS old, count(*) FILTER (NOT is_coinbase) - (SELECT count(*) FROM spends) AS missing FROM ins", SQL)
def link_counters(s, d):
    found = _tables(s, d)
    outs = found["outputs"].select("txid", F.col("output_index").alias("vout"), "height", "tx_index", "value_sat", F.col("address_hash").alias("address"))
    return spends.counters(found["inputs"].withColumn("prev_txid", F.when(~F.col("is_coinbase"), F.col("prev_txid"))), outs)


@query("SELECT height, tx_count, size FROM b WHERE height % 7 <> 3 AND height >= 300 AND height < 2000", SQL)
def orphan_filter(s, d):
    """A height range without the blocks whose hashes a set of orphans holds."""
    blocks = _tables(s, d)["blocks"]
    orphans = blocks.filter("height % 7 = 3").select("hash")
    tip = blocks.agg(F.max("height")).first()[0]
    low, high = chain.clamped(300, 2000, tip)
    return _shown(chain.without(blocks.filter((F.col("height") >= low) & (F.col("height") < high)), orphans).select("height", "tx_count", "size"))


@query("SELECT height, count(*) AS outputs, sum(value_sat)::BIGINT AS value_sat, (SELECT count(*) FROM spends s WHERE s.height = o.height) AS spends FROM outs o WHERE height <= (SELECT max(height) FROM b) GROUP BY 1", SQL)
def live_reorganised(s, d):
    """The tip follower over a store of tables: the node first serves other blocks above height 2000, then the real ones."""
    store = live.TableStore(s, _root(s))
    raw = _payloads(s, d)
    real = shared.written(raw, "payloads", shared.LARGE)
    shared.forget(raw)
    # the other branch: the same blocks with another nonce, so other hashes
    other = real.withColumn("payload", F.when(F.col("height") > 2000, F.concat(F.substring("payload", 1, 79), F.unhex(F.lit("7f")), F.expr("substring(payload, 81)"))).otherwise(F.col("payload")))
    for branch in (other, real):
        for _ in live.catch_up_table(branch, store, most_depth=500):
            pass
    outs, gone = store.table("outputs"), store.table("spends").groupBy("height").agg(F.count(F.lit(1)).alias("spends"))
    sums = outs.groupBy("height").agg(F.count(F.lit(1)).alias("outputs"), F.sum("value_sat").alias("value_sat"))
    return sums.join(gone, "height", "left").select("height", "outputs", "value_sat", F.coalesce("spends", F.lit(0)).cast("long").alias("spends"))
