import struct

import pytest
from chainlake.functions import columns as C
from chainlake.operators import chain, measures, spends
from chainlake.sources import blk, codec, sinks
from chainlake.sources.shared import checkpoint_dir
from chainlake.streaming import live
from pyspark.sql import functions as F


def make_tx(prev=b"\0" * 32, vout=0xFFFFFFFF, value=100, script=b"", lock=0, witness=None):
    body = codec.varint(1) + prev + struct.pack("<I", vout) + b"\0" + b"\xff" * 4 + codec.varint(1) + struct.pack("<Q", value) + codec.varint(len(script)) + script
    tail = b"" if witness is None else codec.varint(len(witness)) + b"".join(codec.varint(len(w)) + w for w in witness)
    return struct.pack("<i", 1) + (b"" if witness is None else b"\0\1") + body + tail + struct.pack("<I", lock)


def make_block(prev=b"\0" * 32, time=1000, txs=None, nonce=0):
    txs = txs or [make_tx(lock=time)]
    return struct.pack("<i32s32sIII", 1, prev, b"\1" * 32, time, 0x1D00FFFF, nonce) + codec.varint(len(txs)) + b"".join(txs)


def make_chain(n):
    out, prev = [], b"\0" * 32
    for i in range(n):
        out.append(make_block(prev, 1000 + i))
        prev = codec.dsha256(out[-1][:80])
    return out


def frame(raw, magic=0xD9B4BEF9):
    return struct.pack("<II", magic, len(raw)) + raw


def test_transaction_sizes_and_witness():
    tx = codec.transaction(codec.Reader(make_tx(b"\xab" * 32, 0)))
    assert tx["weight"] == 4 * tx["size"] and not tx["has_witness"]
    tx = codec.transaction(codec.Reader(make_tx(b"\xab" * 32, 0, witness=[b"\xaa\xbb"])))
    assert (tx["inputs"][0]["witness_items"], tx["inputs"][0]["witness_bytes"]) == (1, 2)
    assert tx["weight"] == 3 * (tx["size"] - 2 - 4) + tx["size"]
    for bad in (make_tx(value=2_100_000_100_000_000), make_tx()[:-2], struct.pack("<i", 1) + b"\0\0"):
        with pytest.raises(codec.BadBlock):
            codec.transaction(codec.Reader(bad))


@pytest.mark.parametrize("n,form", [(0, "00"), (252, "fc"), (253, "fdfd00"), (65535, "fdffff"), (65536, "fe00000100"), (2**64 - 1, "ff" + "ff" * 8)])
def test_varint(n, form):
    assert codec.varint(n).hex() == form and codec.Reader(bytes.fromhex(form)).varint() == n


def test_scripts():
    kind = lambda h: codec.classify(bytes.fromhex(h))[0]
    assert [kind(x) for x in ("76a914" + "ab" * 20 + "88ac", "a914" + "cd" * 20 + "87", "0014" + "11" * 20, "0020" + "22" * 32, "5120" + "33" * 32, "6a0400", "5121" + "02" * 33 + "21" + "03" * 33 + "52ae", "")] == [2, 3, 4, 5, 6, 8, 7, 0]
    assert codec.hash160(b"").hex() == "b472a266d0bd89c13706a4132ccfb16f7c3b9fcb"
    assert codec.classify(bytes.fromhex("0014" + "11" * 20))[1] == b"\x11" * 20 + b"\0" * 12


def test_records_padding_and_errors():
    raw = make_block()
    assert [o for o, _ in codec.records(frame(raw) + frame(raw) + b"\0" * 128)] == [0, 8 + len(raw)]
    assert len(list(codec.records(frame(raw) + frame(raw)[:50]))) == 1
    with pytest.raises(codec.BadBlock):
        list(codec.records(b"garbage!" * 4))
    key = bytes.fromhex("1122334455667788")
    assert codec.unmask(codec.unmask(raw, key), key) == raw and codec.unmask(raw, b"\0" * 8) == raw


def test_blk_files_to_tables(spark, tmp_path):
    key, raws = bytes.fromhex("1122334455667788"), make_chain(4)
    (tmp_path / "xor.dat").write_bytes(key)
    (tmp_path / "blk00000.dat").write_bytes(codec.unmask(b"".join(map(frame, raws[:2])) + b"\0" * 64, key))
    (tmp_path / "blk00001.dat").write_bytes(codec.unmask(b"".join(map(frame, raws[2:])) + b"\0" * 64, key))
    (tmp_path / "blkx.dat").write_bytes(b"no")
    heads = blk.headers(spark, str(tmp_path))
    assert heads.count() == 4
    checkpoint_dir(spark)
    zero = F.unhex(F.lit("00" * 32))
    placed = chain.rooted(heads.select("hash", F.when(F.col("prev_hash") != zero, F.col("prev_hash")).alias("prev"), F.lit(1).cast("long").alias("work")))
    decoded = blk.blocks(spark, str(tmp_path)).join(placed.select("hash", "height"), "hash")
    tables = blk.tables(decoded)
    assert {k: v.count() for k, v in tables.items()} == {"blocks": 4, "transactions": 4, "inputs": 4, "outputs": 4}
    assert [r[0] for r in tables["blocks"].orderBy("height").select("time").collect()] == [1000, 1001, 1002, 1003]
    root = str(tmp_path / "out")
    sinks.write(tables["outputs"], root, "outputs", 2)
    assert sinks.scan(spark, root, "outputs", 1, 2, 2).count() == 2
    sinks.retract(spark, root, "outputs", 2, 2)
    assert sorted(r[0] for r in sinks.scan(spark, root, "outputs", 0, 9, 2).select("height").collect()) == [0, 1, 2]
    assert "PartitionFilters: [isnotnull(part" in sinks.scan(spark, root, "outputs", 0, 1, 2)._jdf.queryExecution().toString()


class Node:
    def __init__(self, raws):
        self.raws = raws

    def tip(self):
        return len(self.raws) - 1

    def hash_at(self, h):
        return codec.dsha256(self.raws[h][:80]) if h < len(self.raws) else None

    def raw_at(self, h):
        return self.raws[h]


def test_live_reorg():
    raws = make_chain(4)
    node, store = Node(raws[:1]), live.MemoryStore()
    assert list(live.catch_up(node, store)) == [("applied", 0), ("caught_up", 0)]
    node.raws = raws
    assert [k for k, _ in live.catch_up(node, store)] == ["applied"] * 3 + ["caught_up"]
    assert list(live.catch_up(node, store)) == [("caught_up", 3)]
    b2 = make_block(codec.dsha256(raws[1][:80]), 1002, nonce=7)
    node.raws = [*raws[:2], b2, make_block(codec.dsha256(b2[:80]), 1003)]
    assert list(live.catch_up(node, store)) == [("reorg_start", 2), ("disconnected", 3), ("disconnected", 2), ("applied", 2), ("applied", 3), ("caught_up", 3)]
    node.raws = make_chain(1) + [make_block(nonce=n) for n in (1, 2, 3)]
    with pytest.raises(live.ReorgTooDeep):
        list(live.catch_up(node, store, most_depth=0))
    assert live.hash_notice([b"hashblock", b"x" * 32, b"1234"]) == b"x" * 32
    with pytest.raises(ValueError):
        live.hash_notice([b"hashblock", b"x" * 31])


def test_spends_fees_and_latest_creation(spark):
    outs = spark.createDataFrame([(1, 0, 1, 0, 50, 7), (2, 0, 2, 0, 40, 8), (1, 0, 3, 0, 30, 9)], "txid long, vout long, height long, tx_index long, value_sat long, address long")
    ins = spark.createDataFrame([(1, 1, 0, 0, None, None), (2, 2, 0, 0, 1, 0), (5, 4, 0, 0, 1, 0), (6, 5, 0, 0, 1, 0)], "txid long, height long, tx_index long, input_index long, prev_txid long, prev_vout long")
    linked = spends.link_spends(ins, outs)
    assert sorted((r.txid, r.spent_height, r.spent_value_sat) for r in linked.collect()) == [(2, 1, 50), (5, 3, 30)]
    assert {r.txid: r.fee for r in spends.tx_fees(ins, outs, linked).collect() if r.height < 3} == {1: 0, 2: 10}


def test_columns(spark):
    row = spark.range(1).select(
        F.hex(C.dsha256(F.lit(b""))).alias("d"), C.display_hex(C.dsha256(F.lit(b""))).alias("s"), C.work_from_bits(F.lit(0x1D00FFFF).cast("long")).alias("w"), C.from_display_hex(F.lit("zz")).alias("n"), C.le_uint(F.unhex(F.lit("F9BEB4D9"))).alias("m")
    ).first()
    assert row.d.lower() == "5df6e0e2761359d30a8275058e299fcc0381534545f55cf43e41983f5d4c9456" and row.s == "56944c5d3f98413ef45cf54545538103cc9f298e0575820ad3591376e2e0f65d"
    assert abs(row.w / 4295032833 - 1) < 1e-9 and row.n is None and row.m == 0xD9B4BEF9 and codec.exact_work(0x1D00FFFF) == 4295032833


def test_growth_edges(spark):
    line = lambda rows: measures.growth_line(spark.createDataFrame(rows, "h long, b long"), "h", "b").first()
    two = line([(100000, 1000), (200000, 2000)])
    assert abs(two.intercept) < 1e-6 and abs(two.slope - 0.01) < 1e-12
    assert (line([(100, 50)]).slope, line([]).slope, line([(1, 9), (2, 1)]).slope) == (0.5, 0.0, 0.0)


def test_rooted_goes_on_until_no_row_moves(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    schema = "hash long, prev long, work long"
    for n in (1, 2, 3, 64, 65):
        got = chain.rooted(spark.createDataFrame([(i, i - 1 if i else None, 2) for i in range(n)], schema)).collect()
        assert sorted(map(tuple, got)) == [(i, i, 2 * i + 2) for i in range(n)]
    with pytest.raises(ValueError):
        chain.rooted(spark.createDataFrame([(0, None, 1), (1, 3, 1), (2, 1, 1), (3, 2, 1)], schema))


def test_columns_over_arrow_and_wide_numbers(spark):
    from chainlake.functions import arrow
    from chainlake.sources import process

    scripts = ["76a914" + "ab" * 20 + "88ac", "0014" + "11" * 20, ""]
    rows = spark.createDataFrame([(bytearray.fromhex(x),) for x in scripts] + [(None,)], "s binary").select(arrow.hash160(F.col("s")).alias("h"), arrow.script_kind(F.col("s")).alias("k")).collect()
    assert [r.h and bytes(r.h) for r in rows] == [*(codec.hash160(bytes.fromhex(x)) for x in scripts), None]
    assert [(r.k.script_type, r.k.address_hash and bytes(r.k.address_hash)) for r in rows[:3]] == [codec.classify(bytes.fromhex(x)) for x in scripts]
    numbers = {"00": 0, "fc": 252, "fdfd00": 253, "fdffff": 65535, "fe00000100": 65536, "ff" + "00" * 7 + "01": 1 << 56, "fd01": None, "": None, "ff" + "ff" * 8: None}
    got = spark.createDataFrame([(bytearray.fromhex(x),) for x in numbers], "b binary").select(C.varint_value(F.col("b")).alias("n")).collect()
    assert [r.n for r in got] == list(numbers.values())
    a, b = process.sample(), process.sample()
    assert a["peak_rss_kb"] > 0 and b["cpu_s"] >= a["cpu_s"] and (process.cpu_share(a, b) is None or process.cpu_share(a, b) >= 0)
