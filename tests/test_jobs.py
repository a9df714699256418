"""Real blocks end to end: the first block's known values, spends and fees, the persistent tip follower, storage guard, RPC, whole runs."""

import json
import struct

import pytest
from chainlake import __main__ as cli
from chainlake import jobs
from chainlake.operators import chain, guard, measures, ordered, spends
from chainlake.sources import blk, codec, rpc, sinks
from chainlake.streaming import live
from pyspark.sql import functions as F
from test_chain import Node, frame, make_block, make_chain, make_tx

#: Fixed value: the first block of the main network.
COINBASE = (
    "01000000010000000000000000000000000000000000000000000000000000000000000000ffffffff4d04ffff001d0104455468652054696d65732030332f4a616e2f32303039204368616e63656c6c6f72206f6e206272696e6b206f66207365636f6e64206261696c6f757420666f722062616e6b73"
    "ffffffff0100f2052a01000000434104678afdb0fe5548271967f1a67130b7105cd6a828e03909a67962e0ea1f61deb649f6bc3f4cef38c4f35504e51ec112de5c384df7ba0b8d578a4c702b6bf11d5fac00000000"
)
FIRST = bytes.fromhex("01000000" + "00" * 32 + "3ba3edfd7a7b12b27ac72c3e67768f617fc81bc3888a51323a9fb8aa4b1e5e4a" + "29ab5f49" + "ffff001d" + "1dac2b7c" + "01" + COINBASE)


def linked_blocks(values):
    """Block 0 makes two coins; each later block spends the coin before it and makes a smaller one. -> (raw blocks, txids)."""
    raws, ids, prev = [], [], b"\0" * 32
    for i, value in enumerate(values):
        txs = [make_tx(lock=i, value=50)]
        if i:
            txs.append(make_tx(ids[-1], 0, value, lock=100 + i, witness=[b"\x01" * i] if i % 2 else None))
        raws.append(make_block(prev, 1000 + i, txs))
        ids.append(codec.block(raws[-1])["transactions"][-1]["txid"])
        prev = codec.dsha256(raws[-1][:80])
    return raws, ids


def write_files(folder, raws, per_file=3, key=None):
    for n, i in enumerate(range(0, len(raws), per_file)):
        (folder / f"blk{n:05d}.dat").write_bytes(codec.unmask(b"".join(map(frame, raws[i : i + per_file])) + b"\0" * 64, key))
    if key:
        (folder / "xor.dat").write_bytes(key)


def test_first_block():
    b = codec.block(FIRST)
    assert (len(FIRST), b["size"], b["weight"], b["time"], b["bits"], b["nonce"]) == (285, 285, 1136, 1231006505, 0x1D00FFFF, 2083236893)
    assert b["hash"][::-1].hex() == "000000000019d6689c085ae165831e934ff763ae46a2a6c172b3f1b60a8ce26f"
    t = b["transactions"][0]
    assert t["txid"][::-1].hex() == "4a5e1e4baab89f3a32518a88c31bc87f618f76673e2cc77ab2127b7afdeda33b" == b["merkle_root"][::-1].hex()
    assert (t["size"], t["weight"], t["inputs"][0]["script_sig_len"], t["inputs"][0]["is_coinbase"]) == (204, 816, 77, True)
    o = t["outputs"][0]
    assert (o["value_sat"], o["script_type"], o["script_pubkey_len"], o["address_hash"].hex()) == (5_000_000_000, 1, 67, "62e907b15cbf27d5425399ebf6f0fb50ebb88f18" + "00" * 12)
    with pytest.raises(codec.BadBlock):
        codec.block(FIRST + b"\0")
    assert codec.network_of(frame(FIRST)) == "mainnet" and codec.network_of(b"abcdefgh") is None and codec.network_of(b"") is None


def test_state_codecs():
    state = codec.output_state(5_000_000_000, 4, 70_000, b"\x07" * 32)
    assert codec.read_output_state(state) == (5_000_000_000, 4, 70_000, b"\x07" * 32)
    undo = codec.undo_record([(b"a" * 32, 3, state)], [(b"b" * 32, 0), (b"c" * 32, 9)])
    assert codec.read_undo_record(undo) == ([(b"a" * 32, 3, state)], [(b"b" * 32, 0), (b"c" * 32, 9)])
    for bad in (state + b"\0", state[:-1]):
        with pytest.raises(codec.BadBlock):
            codec.read_output_state(bad)


def test_index_links_spends_and_fees(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    with pytest.raises(blk.NoFiles):
        blk.files(spark, str(folder))
    raws, ids = linked_blocks([50, 40, 33, 33, 20, 11, 5])
    side = make_block(codec.dsha256(raws[1][:80]), 7777)  # a branch of one block
    key = bytes.fromhex("1122334455667788")
    write_files(folder, [*raws[:3], side, raws[1], *raws[3:]], key=key)
    found = jobs.index(spark, str(folder), out, blocks_per_part=2)
    assert (found["total_records"], found["unique_blocks"], found["orphans"]) == (9, 8, 1)
    assert {k: found[k] for k in sinks.ENTITIES} == {"blocks": 7, "transactions": 13, "inputs": 13, "outputs": 13, "spends": 6}
    rows = {r.height: r for r in spark.read.parquet(f"{out}/spends").collect()}
    assert {h: (r.spent_value_sat, r.spent_height, bytes(r.spent_txid)) for h, r in rows.items()} == {h: (v, h - 1, ids[h - 1]) for h, v in enumerate([50, 50, 40, 33, 33, 20, 11][:7]) if h}
    fees = {r.height: r.total_fee for r in spark.read.parquet(f"{out}/blocks").collect()}
    assert fees == {0: 0, 1: 10, 2: 7, 3: 0, 4: 13, 5: 9, 6: 6}
    assert {(r.height, r.tx_index): r.fee for r in spark.read.parquet(f"{out}/transactions").collect() if r.fee} == {(h, 1): f for h, f in fees.items() if f}
    assert spark.read.parquet(f"{out}/inputs_by_prev_output").count() == 6 and spark.read.parquet(f"{out}/transactions_by_txid").count() == 13
    # in two runs, the second of which spends what the first wrote
    again = str(tmp_path / "again")
    jobs.index(spark, str(folder), again, end=4, blocks_per_part=2)
    jobs.index(spark, str(folder), again, start=4, blocks_per_part=2)
    for name in sinks.ENTITIES:
        a, b = (spark.read.parquet(f"{x}/{name}").drop("part") for x in (out, again))
        assert a.count() == b.count() and a.exceptAll(b.select(a.columns)).isEmpty()
    with pytest.raises(chain.EmptyRange):
        jobs.index(spark, str(folder), again, start=9, end=3)
    assert "height 2 hash" in jobs.inspect(spark, str(folder), 2) and jobs.inspect(spark, str(folder), 2).count("inputs") == 2
    assert blk.network(blk.files(spark, str(folder)), key) == "mainnet"
    first = blk.headers(spark, str(folder)).filter("file_id = 1").orderBy("offset").first()
    where = spark.createDataFrame([(1, first.offset, first.record_len)], "file_id int, offset long, record_len long")
    assert bytes(blk.payloads(blk.files(spark, str(folder)), key, where).first().payload) == side
    with pytest.raises(Exception, match="beyond"):
        blk.payloads(blk.files(spark, str(folder)), key, where.withColumn("offset", F.lit(10**6).cast("long"))).collect()
    trials = jobs.bench(spark, str(folder), "full", 2)
    assert [t["blocks"] for t in trials] == [7, 7] and set(json.loads(jobs.report(trials))["stages"]) == {"headers", "parse", "utxo", "sink"}
    assert cli.main(["inspect", str(folder), "1"]) == 0


def test_a_bad_record_names_its_file_and_offset(spark, tmp_path):
    raw = make_chain(1)[0]
    (tmp_path / "blk00003.dat").write_bytes(frame(raw) + frame(raw + b"xx"))
    with pytest.raises(Exception, match=f"file 3, record at {len(raw) + 8}"):
        blk.blocks(spark, str(tmp_path)).collect()


def test_missing_outputs_and_counters(spark):
    outs = spark.createDataFrame([(1, 0, 1, 0, 50, 7), (2, 0, 2, 0, 40, 8)], "txid long, vout long, height long, tx_index long, value_sat long, address long")
    ins = spark.createDataFrame([(1, 1, 0, 0, None, None), (2, 2, 0, 0, 1, 0), (3, 2, 1, 0, 2, 0), (4, 300, 0, 0, 9, 9)], "txid long, height long, tx_index long, input_index long, prev_txid long, prev_vout long")
    row = spends.counters(ins, outs)
    assert row.first().asDict() == {"inputs": 4, "coinbase": 1, "linked": 2, "same_block": 1, "recent": 1, "old": 0, "missing": 1}
    with pytest.raises(spends.MissingOutputs):
        spends.require_all(row)


def test_follower_over_tables(spark, tmp_path):
    raws, ids = linked_blocks([50, 40, 30, 20])
    root = str(tmp_path / "live")
    node, store = Node(raws), live.TableStore(spark, root, 2)
    store.apply_all(spark.createDataFrame([(0, bytearray(raws[0]))], "height long, payload binary"))
    assert [k for k, _ in live.catch_up(node, store)] == ["applied"] * 3 + ["caught_up"]
    assert store.tip() == (3, codec.dsha256(raws[3][:80])) and store.table("spends").count() == 3
    assert sorted((r.kind, bytes(r.txid)) for r in store.undo(2).collect()) == sorted([("spent", ids[1]), ("created", ids[2]), ("created", codec.block(raws[2])["transactions"][0]["txid"])])
    # another branch from height 1 on, and a new store on the same folder in between
    two = make_block(codec.dsha256(raws[1][:80]), 2002, [make_tx(lock=2, value=50), make_tx(ids[1], 0, 25, lock=999)])
    node.raws = [*raws[:2], two]
    store = live.TableStore(spark, root, 2)
    with pytest.raises(live.ReorgTooDeep):
        list(live.catch_up(node, store, most_depth=1))
    assert list(live.catch_up(node, store)) == [("reorg_start", 2), ("disconnected", 3), ("disconnected", 2), ("applied", 2), ("caught_up", 2)]
    assert {r.height: r.spent_value_sat for r in store.table("spends").collect()} == {1: 50, 2: 40}
    assert {r.height: r.total_fee for r in store.table("blocks").collect()} == {0: 0, 1: 10, 2: 15}
    assert store.unspent().agg(F.sum("value_sat")).first()[0] == 50 + 50 + 25
    # rows beyond the tip that a crash left go when the store is opened
    sinks.write(store.table("outputs").limit(1).withColumn("height", F.lit(8).cast("long")), root, "outputs", 2)
    assert live.TableStore(spark, root, 2).table("outputs").agg(F.max("height")).first()[0] == 2
    for gone in (lambda: store.undo(3), lambda: store.retract(2)):
        with pytest.raises(live.NoUndo):
            gone()


def test_follow_survives_lost_connections():
    raws = make_chain(3)
    seen, slept = [], []

    class Flaky(Node):
        calls = 0

        def tip(self):
            Flaky.calls += 1
            if Flaky.calls == 2:
                raise ConnectionError("gone")
            return super().tip()

    notices = [[b"hashblock", b"x" * 32, b"1"], None, [b"other", b"x" * 31]]
    live.follow(Flaky(raws), live.MemoryStore(), notices, seen.append, sleep=slept.append)
    assert slept == [1.0] and seen[-1] == ("caught_up", 2)
    waits = []
    poll = live.polled(2.0, waits.append)
    assert [next(poll), next(poll)] == [None, None] and waits == [2.0]


def test_rpc():
    raws = make_chain(3)
    hashes = [codec.dsha256(r[:80])[::-1].hex() for r in raws]
    stale = "ab" * 32

    def answer(method, params):
        result = {
            "getblockcount": lambda: 2, "getblockhash": lambda: hashes[params[0]], "getblock": lambda: raws[hashes.index(params[0])].hex(),
            "getblockheader": lambda: {"previousblockhash": hashes[0]} if params[0] != hashes[0] else {},
            "getchaintips": lambda: [{"hash": hashes[2], "branchlen": 0, "status": "active"}, {"hash": stale, "branchlen": 2, "status": "valid-fork"}, {"hash": "cd" * 32, "branchlen": 1, "status": "headers-only"}],
        }[method]()
        return json.dumps({"result": result, "error": None})

    node = rpc.Node(answer)
    assert node.raw_at(1) == raws[1] and node.hash_at(2)[::-1].hex() == hashes[2] and node.hash_at(3) is None
    assert node.stale_hashes() == {bytes.fromhex(stale)[::-1], bytes.fromhex(hashes[0])[::-1]}
    assert [k for k, _ in live.catch_up(node, live.MemoryStore())] == ["applied", "caught_up"]
    assert rpc.result_of('{"result": 42}') == 42
    for bad in ('{"error": {"code": -5, "message": "x"}}', '{"result": null, "error": null}', "[1]"):
        with pytest.raises(rpc.RpcError):
            rpc.result_of(bad)
    with pytest.raises(rpc.RpcError):
        rpc.Node(lambda m, p: '{"result": "zz"}').raw_at(0)


def test_storage_guard(spark, tmp_path):
    file = str(tmp_path / "points" / "disk.txt")
    assert guard.append_point(file, "signet", 200_000, 2000) and guard.append_point(file, "mainnet", 5, 9) and guard.append_point(file, "signet", 100_000, 1000)
    assert not guard.append_point(file, "signet", 100_000, 1)
    with open(file, "a") as f:
        f.write("# note\n\nbad line\n")
    points = guard.history(spark, file, "signet")
    assert [tuple(r) for r in points.collect()] == [(100_000, 1000), (200_000, 2000)] and guard.history(spark, file, "regtest").isEmpty()
    found = guard.preflight(points, 300_000, 500, 20 * guard.GIB)
    assert (found.projected, found.additional, found.missing_gib) == (3000, 2500, 0)
    with pytest.raises(guard.NoSpace):
        guard.preflight(points, 300_000, 500, guard.GIB)
    assert guard.preflight(points.limit(0), 300_000, 500, 0).projected == 0
    (tmp_path / "x").write_bytes(b"12345")
    (tmp_path / "link").symlink_to(tmp_path / "x")
    size = guard.folder_bytes(str(tmp_path))
    assert size == 5 + len(open(file).read()) and guard.folder_bytes(str(tmp_path / "none")) == 0 and guard.free_bytes(str(tmp_path / "a/b")) > 0
    recorder = guard.Recorder(file, "regtest", [str(tmp_path)], 5)
    heights = [0, 1, 2, 3, 4, 6, 5, 10, 5]
    assert [h for h in heights if recorder.on_block(h)] == [5, 10] and guard.history(spark, file, "regtest").count() == 2
    due = guard.due(spark.createDataFrame(list(enumerate(heights)), "at long, height long"), 5)
    assert sorted(r.height for r in due.collect()) == [5, 10]


def test_latency_of_none_one_and_many(spark):
    rows = lambda x: spark.createDataFrame([(float(v),) for v in x], "v double")
    assert measures.latency(rows([]), "v") == {"n": 0, "p50": 0, "p99": 0, "largest": 0, "total": 0}
    assert measures.latency(rows([7]), "v") == {"n": 1, "p50": 7, "p99": 7, "largest": 7, "total": 7}
    values = [(i * 7919) % 1000 // 3 for i in range(1, 5000)]
    got, s = measures.latency(rows(values), "v"), sorted(values)
    assert got == {"n": 4999, "p50": s[int(4998 * 0.5 + 0.5)], "p99": s[int(4998 * 0.99 + 0.5)], "largest": s[-1], "total": sum(s)}


def test_running_values_over_slices(spark):
    rows = [(i, (i * 37) % 101, None if i % 3 else f"n{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "at long, v long, name string").repartition(5)
    sums = {r.at: (r.s, r.high, r.last) for r in ordered.last_known(ordered.highest_before(ordered.running_sum(df, F.col("v"), "s", F.col("at")), "v", "high", F.col("at")), F.col("name"), "last", F.col("at")).collect()}
    for i in range(200):
        assert sums[i] == (sum(r[1] for r in rows[: i + 1]), max((r[1] for r in rows[:i]), default=None), f"n{i - i % 3}")
    assert measures.within_budget(df, F.lit(10), 50, F.desc("at")).count() == 5


def test_catalog_tables(spark, tmp_path):
    raws, _ = linked_blocks([50, 40])
    found = blk.linked(blk.tables(blk.decoded(spark.createDataFrame([(i, bytearray(r)) for i, r in enumerate(raws)], "height long, payload binary"))))
    found |= blk.serving(found)
    for _ in range(2):
        sinks.create_tables(spark, "chainlake_test", found)
    for name, df in found.items():
        sinks.load(spark, "chainlake_test", name, df)
        assert spark.table(f"chainlake_test.{name}").count() == df.count()
    spark.sql("DROP DATABASE chainlake_test CASCADE")


def test_main_chain_with_forks_ties_and_orphans(spark):
    headers = spark.createDataFrame([(1, None, 1.0), (2, 1, 1.0), (3, 1, 1.0), (4, 2, 1.0), (5, 3, 1.0), (6, 99, 9.0), (7, None, 2.0)], "hash long, prev long, work double")
    assert sorted(map(tuple, chain.main_chain(headers).collect())) == [(1, 0, 1.0), (2, 1, 2.0), (4, 2, 3.0)]
    tips = spark.createDataFrame([(5, 2, "valid-fork"), (4, 0, "active"), (6, 5, "headers-only"), (6, 3, "invalid")], "hash long, branch_length long, status string")
    assert sorted(r[0] for r in chain.branch_blocks(headers, chain.stale_tips(tips)).collect()) == [3, 5, 6, 99]
    assert struct.calcsize("<II") == 8 and chain.clamped(5, None, 9) == (5, 10) and chain.clamped(0, 100, 9) == (0, 10)
