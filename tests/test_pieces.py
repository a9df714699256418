"""Block files in pieces and blocks in parts: no row holds a file, and none a whole block of many transactions."""

import os

import pytest
from chainlake.plans import blocks
from chainlake.sources import blk, codec, shared
from chainlake.streaming import live
from pyspark.sql import functions as F
from test_chain import frame, make_block, make_tx

DATA = "/root/testdata/sf0.001"
KEY = bytes.fromhex("1122334455667788")


@pytest.fixture(scope="module")
def both(spark):
    """The same file whole and in pieces, one of them padding, and its blocks."""
    raws = [make_block(bytes(32), n) for n in range(3)]
    plain = [*map(frame, raws), b"\0" * 64]
    starts = [sum(map(len, plain[:i])) for i in range(len(plain))]
    whole = spark.createDataFrame([(0, bytearray(codec.unmask(b"".join(plain), KEY)))], "file_id int, content binary")
    pieces = spark.createDataFrame([(0, at, bytearray(codec.unmask(x, KEY, at))) for at, x in zip(starts, plain)], "file_id int, start long, content binary")
    return raws, whole, pieces


def test_pieces_read_as_their_file(both):
    raws, whole, pieces = both
    for read in (blk.headers_of, blk.blocks_of):
        a, b = (sorted(map(repr, read(x, KEY).collect())) for x in (whole, pieces))
        assert a == b and len(a) == 3
    assert blk.network(pieces, KEY) == "mainnet"
    where = blk.headers_of(whole, KEY).select("file_id", "offset", "record_len")
    assert sorted(bytes(r.payload) for r in blk.payloads(pieces, KEY, where).collect()) == sorted(raws)


def test_a_place_outside_the_pieces_fails(both):
    _, whole, pieces = both
    where = blk.headers_of(whole, KEY).select("file_id", "offset", "record_len")
    with pytest.raises(Exception, match="beyond"):
        blk.payloads(pieces, KEY, where.withColumn("offset", F.lit(10**6).cast("long"))).collect()


def test_a_block_of_many_transactions_comes_in_parts(spark):
    n = 2 * blk.PART + 3
    raw = make_block(txs=[make_tx(lock=i) for i in range(n)])
    found = blk.decoded(spark.createDataFrame([(5, bytearray(raw))], "height long, payload binary"))
    assert sorted(found.select(F.size("transactions")).collect()) == [(3,), (blk.PART,), (blk.PART,)]
    tables, whole = blk.tables(found), codec.block(raw)
    assert [{k: r[k] for k in codec.SUMS} for r in tables["blocks"].collect()] == [{k: whole[k] for k in codec.SUMS}]
    assert sorted((r.tx_index, bytes(r.txid)) for r in tables["transactions"].collect()) == [(t["tx_index"], t["txid"]) for t in whole["transactions"]]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_no_row_of_the_files_holds_two_blocks(spark):
    content = blocks._files(spark, DATA)
    n = blk.headers_of(content, blocks.KEY).count()
    assert content.count() == n and blk.headers_of(content, blocks.KEY).select("file_id").distinct().count() < n / 100


def test_the_tip_followers_blocks_have_small_row_groups(spark, tmp_path, monkeypatch):
    told = {}

    def spy(df, name, options={}):  # noqa: B006
        told[name] = options
        return shared.written(df, name, options)

    monkeypatch.setattr(live, "written", spy)
    live.TableStore(spark, f"file://{tmp_path}/chain").apply_all(spark.createDataFrame([(0, bytearray(make_block()))], "height long, payload binary"))
    assert told["decoded"] == shared.LARGE


def test_the_sums_of_blocks_come_without_their_transactions(spark, both):
    _, whole, pieces = both
    wanted = sorted(map(repr, blk.blocks_of(whole, KEY).drop("transactions").collect()))
    for content in (whole, pieces):
        assert sorted(map(repr, blk.sums_of(content, KEY).collect())) == wanted
    raw = make_block(txs=[make_tx(lock=i) for i in range(2 * blk.PART + 3)])
    content = spark.createDataFrame([(0, bytearray(frame(raw)))], "file_id int, content binary")
    assert [{k: r[k] for k in codec.SUMS} for r in blk.sums_of(content).collect()] == [{k: codec.block(raw)[k] for k in codec.SUMS}]
    with pytest.raises(Exception, match="file 0, record at 0"):
        blk.sums_of(spark.createDataFrame([(0, bytearray(frame(raw[:-1])))], "file_id int, content binary")).collect()


def test_few_places_leave_the_content_where_it_is(both):
    raws, whole, pieces = both
    where = blk.headers_of(whole, KEY).select("file_id", "offset", "record_len")
    for content in (whole, pieces):
        found = {sent: blk.payloads(content, KEY, where, sent) for sent in (len(raws) - 1, len(raws))}
        assert [sorted(bytes(r.payload) for r in x.collect()) for x in found.values()] == [sorted(raws)] * 2
        plans = [x._jdf.queryExecution().optimizedPlan().toString() for x in found.values()]
        assert ["strategy=broadcast" in x for x in plans] == [False, True]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_the_payloads_are_read_without_a_decoded_block(spark, monkeypatch):
    def fails(*_):
        raise AssertionError("transactions are sent")

    monkeypatch.setattr(blk, "blocks_of", fails)
    assert blocks.blk_payloads(spark, DATA).count() > 0
