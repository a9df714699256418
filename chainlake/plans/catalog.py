"""Every query over the test tables, and the DuckDB SQL that it is compared with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import chain, guard, measures, ordered, spends
from . import blocks, register  # blocks registers its queries
from .adapter import SQL, ins, outs, table, txs
from .register import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "blocks"]

FORK = 1200


def query(sql: str, views: bool = True):
    """Register a query under its name with its SQL; ``views`` puts the views over the order tables before it."""
    return register.query(sql, SQL if views else "")


def _linked(s: SparkSession, d: str) -> DataFrame:
    return spends.link_spends(ins(s, d), outs(s, d))


def _fees(s: SparkSession, d: str) -> DataFrame:
    return spends.tx_fees(ins(s, d), outs(s, d), _linked(s, d))


FEES = """, paid AS (SELECT txid, sum(spent_value_sat) AS paid FROM spends GROUP BY 1),
made AS (SELECT txid, height, sum(value_sat) AS made FROM outs GROUP BY 1, 2), kind AS (SELECT txid, bool_or(prev_txid IS NULL) AS coinbase FROM ins GROUP BY 1),
fees AS (SELECT txid, height, CAST(CASE WHEN coinbase THEN 0 ELSE greatest(coalesce(paid, 0) - made, 0) END AS BIGINT) AS fee, coinbase FROM made JOIN kind USING (txid) LEFT JOIN paid USING (txid))
"""


@query("SELECT txid, input_index, height, spent_txid, spent_vout, spent_value_sat, spent_address, spent_height FROM spends")
def spend_link(s, d):
    return _linked(s, d).select("txid", "input_index", "height", "spent_txid", "spent_vout", "spent_value_sat", "spent_address", "spent_height")


@query("SELECT height, count(*) AS n FROM spends WHERE spent_height = height GROUP BY 1")
def spend_same_block(s, d):
    return _linked(s, d).filter("spent_height = height").groupBy("height").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT (SELECT count(*) FROM ins) AS inputs, (SELECT count(*) FROM ins WHERE prev_txid IS NULL) AS coinbase, (SELECT count(*) FROM spends) AS spends, (SELECT count(*) FROM ins WHERE prev_txid IS NOT NULL) - (SELECT count(*) FROM spends) AS missing")
def spend_counters(s, d):
    i = ins(s, d).agg(F.count(F.lit(1)).alias("inputs"), F.count_if(F.col("prev_txid").isNull()).alias("coinbase"))
    n = _linked(s, d).agg(F.count(F.lit(1)).alias("spends"))
    return i.crossJoin(n).withColumn("missing", F.col("inputs") - F.col("coinbase") - F.col("spends"))  # one row each


@query("SELECT CASE WHEN height = spent_height THEN 'pending' WHEN height - spent_height <= 100 THEN 'recent' ELSE 'old' END AS age, count(*) AS n FROM spends GROUP BY 1")
def spend_age_class(s, d):
    age = F.when(F.col("height") == F.col("spent_height"), "pending").when(F.col("height") - F.col("spent_height") <= 100, "recent").otherwise("old")
    return _linked(s, d).groupBy(age.alias("age")).agg(F.count(F.lit(1)).alias("n"))


@query(""", twice AS (SELECT *, 0 AS copy FROM ins UNION ALL SELECT txid, height + 1, tx_index, input_index, prev_txid, prev_vout, 1 FROM ins),
m AS (SELECT t.*, o.height AS oh, row_number() OVER (PARTITION BY o.txid, o.vout ORDER BY t.height, t.tx_index, t.input_index, t.txid) AS n FROM twice t JOIN outs o ON prev_txid = o.txid AND prev_vout = o.vout AND o.height <= t.height)
SELECT count(*) FILTER (n = 1) AS spends, count(*) FILTER (n > 1) AS rejected FROM m""")
def double_spend_rejected(s, d):
    i = ins(s, d)
    both = i.unionByName(i.withColumn("height", F.col("height") + 1))
    o = outs(s, d)
    found = spends.candidates(both, o).filter("spent_txid is not null").agg(F.count(F.lit(1)).alias("found"))
    return spends.link_spends(both, o).agg(F.count(F.lit(1)).alias("spends")).crossJoin(found).select("spends", (F.col("found") - F.col("spends")).alias("rejected"))


@query(FEES + "SELECT txid, height, fee, coinbase FROM fees")
def tx_fees(s, d):
    return _fees(s, d).select("txid", "height", "fee", "coinbase")


@query(FEES + "SELECT height, CAST(sum(CASE WHEN coinbase THEN 0 ELSE fee END) AS BIGINT) AS total_fee, count(*) AS tx_count FROM fees GROUP BY 1")
def block_fees(s, d):
    return spends.block_fees(_fees(s, d))


@query("SELECT txid, bool_or(prev_txid IS NULL) AS coinbase FROM ins GROUP BY 1")
def coinbase_flag(s, d):
    return ins(s, d).groupBy("txid").agg(F.bool_or(F.col("prev_txid").isNull()).alias("coinbase"))


@query("SELECT height, CAST(sum(CASE WHEN tx_index = 0 THEN value_sat ELSE 0 END) AS BIGINT) AS coinbase_value, count(DISTINCT txid) AS tx_count, count(*) AS output_count, CAST(least(sum(4 * value_sat) + 320, 4294967295) AS BIGINT) AS weight FROM outs GROUP BY 1")
def block_rollup(s, d):
    o = outs(s, d)
    return o.groupBy("height").agg(F.sum(F.when(F.col("tx_index") == 0, F.col("value_sat")).otherwise(0)).alias("coinbase_value"), F.countDistinct("txid").alias("tx_count"), F.count(F.lit(1)).alias("output_count"), F.least(F.sum(4 * F.col("value_sat")) + 320, F.lit(4294967295)).alias("weight"))


@query(f"SELECT txid, vout, height, value_sat FROM outs o ANTI JOIN (SELECT spent_txid, spent_vout FROM spends WHERE height <= {FORK}) s ON s.spent_txid = o.txid AND s.spent_vout = o.vout WHERE o.height <= {FORK}")
def utxo_at_height(s, d):
    return spends.utxo_at(outs(s, d), _linked(s, d), FORK).select("txid", "vout", "height", "value_sat")


@query("SELECT o.height, count(*) AS n FROM outs o WHERE NOT EXISTS (SELECT 1 FROM spends s WHERE s.spent_txid = o.txid AND s.spent_vout = o.vout AND s.height = o.height) GROUP BY 1")
def net_new_outputs(s, d):
    return spends.undo(outs(s, d), _linked(s, d)).filter("created > 0").select("height", F.col("created").alias("n"))


@query(""", sp AS (SELECT height, count(*) AS spent FROM spends WHERE spent_height < height GROUP BY 1),
cr AS (SELECT o.height, count(*) AS created FROM outs o WHERE NOT EXISTS (SELECT 1 FROM spends s WHERE s.spent_txid = o.txid AND s.spent_vout = o.vout AND s.height = o.height) GROUP BY 1)
SELECT coalesce(sp.height, cr.height) AS height, coalesce(spent, 0) AS spent, coalesce(created, 0) AS created FROM sp FULL JOIN cr ON sp.height = cr.height""")
def block_undo(s, d):
    return spends.undo(outs(s, d), _linked(s, d))


@query(f"SELECT address, CAST(sum(v) AS BIGINT) AS balance_sat FROM (SELECT address, value_sat AS v FROM outs WHERE height <= {FORK} UNION ALL SELECT spent_address, -spent_value_sat FROM spends WHERE height <= {FORK}) GROUP BY 1")
def address_balance(s, d):
    return spends.balances(outs(s, d), _linked(s, d), FORK)


@query("SELECT txid, vout, value_sat, height FROM outs WHERE address = 7")
def address_outputs(s, d):
    return outs(s, d).filter("address = 7").select("txid", "vout", "value_sat", "height")


@query("SELECT txid, height, tx_index FROM tx WHERE txid = 101")
def tx_by_txid(s, d):
    return txs(s, d).filter("txid = 101").select("txid", "height", "tx_index")


@query("SELECT txid, input_index, height FROM spends WHERE spent_vout = 0 AND spent_address = 3")
def spender_of_output(s, d):
    return _linked(s, d).filter("spent_vout = 0 and spent_address = 3").select("txid", "input_index", "height")


@query("SELECT from_address, o.address AS to_address, CAST(sum(value_sat) AS BIGINT) AS value_sat FROM (SELECT DISTINCT txid, spent_address AS from_address FROM spends) f JOIN outs o USING (txid) GROUP BY 1, 2")
def coin_flow(s, d):
    return spends.coin_flow(outs(s, d), _linked(s, d))


@query(f"SELECT txid, height, tx_index FROM tx WHERE height >= {FORK} AND height < {FORK + 50}")
def height_range_scan(s, d):
    return txs(s, d).filter(f"height >= {FORK} and height < {FORK + 50}").select("txid", "height", "tx_index")


@query("SELECT height // 100 AS part, count(*) AS n, min(height) AS low, max(height) AS high FROM tx GROUP BY 1")
def part_ids(s, d):
    return txs(s, d).groupBy(C.part_id(F.col("height"), 100).alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min("height").alias("low"), F.max("height").alias("high"))


@query("SELECT height, txid, tx_index FROM tx")
def ordinals(s, d):
    return chain.ordinals(txs(s, d).select("height", "txid"), "height", "txid").select("height", "txid", F.col("ordinal").cast("long").alias("tx_index"))


@query("SELECT height, txid, tx_index FROM tx QUALIFY row_number() OVER (PARTITION BY height ORDER BY tx_index) <= 3")
def top3_txs(s, d):
    return txs(s, d).filter("tx_index < 3").select("height", "txid", "tx_index")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) = 1", views=False)
def dedupe_first_seen(s, d):
    rows = table(s, d, "lineitem").select(F.struct("l_orderkey", "l_linenumber").alias("k"), "l_partkey", "l_suppkey")
    return chain.first_seen(rows, "k", "l_partkey", "l_suppkey").select("k.l_orderkey", "k.l_linenumber", "l_partkey")


@query("""WITH e AS (SELECT event_id, CASE WHEN event_id = (SELECT min(event_id) FROM events) THEN NULL ELSE event_id - 1 END AS prev, 1 + event_id % 7 AS work FROM events)
SELECT event_id AS hash, row_number() OVER (ORDER BY event_id) - 1 AS height, CAST(sum(work) OVER (ORDER BY event_id) AS BIGINT) AS cum_work FROM e""", views=False)
def chain_heights(s, d):
    return chain.rooted(_headers(s, d))


def _headers(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "events")
    low = e.agg(F.min("event_id").alias("low"))
    return e.crossJoin(F.broadcast(low)).select(F.col("event_id").alias("hash"), F.when(F.col("event_id") > F.col("low"), F.col("event_id") - 1).alias("prev"), (1 + F.col("event_id") % 7).alias("work"))  # one row on the right


@query("SELECT max(event_id) AS hash, count(*) - 1 AS height, CAST(sum(1 + event_id % 7) AS BIGINT) AS cum_work FROM events", views=False)
def best_tip(s, d):
    return chain.best_tip(chain.rooted(_headers(s, d)))


#: A tree with many forks, ties and roots without a parent; each fifth header comes twice.
_GRAPH = """rec AS (SELECT event_id AS hash, CASE WHEN event_id = (SELECT min(event_id) FROM events) THEN NULL WHEN event_id % 97 = 5 THEN event_id + 1000000000 ELSE event_id // 2 END AS prev,
         1 + event_id % 7 AS work, event_id % 50 AS file_id FROM events),
twice AS (SELECT * FROM rec UNION ALL SELECT hash, prev, work, file_id + 100 FROM rec WHERE hash % 5 = 0),
up(hash, height, cum_work) AS (SELECT hash, 0, work FROM rec WHERE prev IS NULL UNION ALL SELECT r.hash, height + 1, cum_work + work FROM up JOIN rec r ON r.prev = up.hash),
tip AS (SELECT hash FROM up ORDER BY cum_work DESC, hash LIMIT 1),
main(hash) AS (SELECT hash FROM tip UNION ALL SELECT prev FROM main JOIN rec USING (hash) WHERE prev IS NOT NULL),
tips AS (SELECT hash, 1 + hash % 4 AS branch_length, CASE hash % 3 WHEN 0 THEN 'active' WHEN 1 THEN 'valid-fork' ELSE 'valid-headers' END AS status FROM rec WHERE hash % 50 = 7),
walk(hash, n) AS (SELECT hash, branch_length FROM tips WHERE status <> 'active' UNION SELECT prev, n - 1 FROM walk JOIN rec USING (hash) WHERE n > 1 AND prev IS NOT NULL)
"""


def _graph(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(all records, the first record of each header)."""
    e = table(s, d, "events")
    low = e.agg(F.min("event_id").alias("low"))
    prev = F.when(F.col("event_id") == F.col("low"), None).when(F.col("event_id") % 97 == 5, F.col("event_id") + 1_000_000_000).otherwise(F.floor(F.col("event_id") / 2))
    rec = e.crossJoin(F.broadcast(low)).select(F.col("event_id").alias("hash"), prev.cast("long").alias("prev"), (1 + F.col("event_id") % 7).alias("work"), (F.col("event_id") % 50).alias("file_id"))  # one row on the right
    records = rec.union(rec.filter("hash % 5 = 0").withColumn("file_id", F.col("file_id") + 100))
    return records, chain.first_seen(records, "hash", "file_id").select("hash", "prev", "work")


def _tips(headers: DataFrame) -> DataFrame:
    status = F.element_at(F.array(F.lit("active"), F.lit("valid-fork"), F.lit("valid-headers")), (F.col("hash") % 3 + 1).cast("int"))
    return headers.filter("hash % 50 = 7").select("hash", (1 + F.col("hash") % 4).alias("branch_length"), status.alias("status"))


@register.query("SELECT hash, height::BIGINT AS height, cum_work::BIGINT AS cum_work FROM up", _GRAPH)
def header_graph(s, d):
    return chain.rooted(_graph(s, d)[1])


@register.query("SELECT hash, height::BIGINT AS height, cum_work::BIGINT AS cum_work FROM main JOIN up USING (hash)", _GRAPH)
def main_chain(s, d):
    return chain.main_chain(_graph(s, d)[1])


@register.query("SELECT (SELECT count(*) FROM twice) AS total_records, (SELECT count(DISTINCT hash) FROM twice) AS unique_blocks, (SELECT count(*) FROM main) AS main_chain, (SELECT count(DISTINCT hash) FROM twice) - (SELECT count(*) FROM main) AS orphans", _GRAPH)
def header_stats(s, d):
    records, headers = _graph(s, d)
    return chain.header_stats(records, headers, chain.main_chain(headers))


@register.query("SELECT DISTINCT hash FROM walk", _GRAPH)
def stale_branch_walk(s, d):
    headers = _graph(s, d)[1]
    return chain.branch_blocks(headers, chain.stale_tips(_tips(headers)))


@register.query("SELECT hash, work FROM rec WHERE hash NOT IN (SELECT hash FROM walk)", _GRAPH)
def without_stale_branches(s, d):
    headers = _graph(s, d)[1]
    return chain.without(headers.select("hash", "work"), chain.branch_blocks(headers, chain.stale_tips(_tips(headers))))


@query("SELECT event_id, user_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND value > 90)", views=False)
def orphan_anti(s, d):
    e = table(s, d, "events")
    return e.join(e.filter("event_type = 'error' and value > 90").select("user_id").distinct(), "user_id", "left_anti").select("event_id", "user_id")


@query("SELECT max(a.event_id) AS fork_height FROM events a JOIN events b ON a.event_id = b.event_id WHERE b.user_id % 3 > 0", views=False)
def fork_point(s, d):
    e = table(s, d, "events").select(F.col("event_id").alias("height"), F.col("user_id").alias("hash"))
    return chain.fork_point(e, e.withColumn("hash", F.when(F.col("hash") % 3 > 0, F.col("hash")).otherwise(-1)))


@query("SELECT event_id, value FROM (SELECT event_id, value, max(value) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM events) WHERE top IS NULL OR value > top", views=False)
def monotone_checkpoints(s, d):
    return measures.monotone(table(s, d, "events").select("event_id", "value"), "value", "event_id")


_POINTS = """, per AS (SELECT height, count(*) AS n FROM tx GROUP BY 1), cum AS (SELECT height, CAST(sum(n) OVER (ORDER BY height) AS BIGINT) AS bytes FROM per),
p AS (SELECT * FROM cum WHERE height % 100 = 0), g AS (SELECT count(*) AS n, sum(height::DOUBLE) AS sx, sum(bytes::DOUBLE) AS sy, sum(height::DOUBLE * bytes) AS sxy, sum(height::DOUBLE * height) AS sxx FROM p),
l AS (SELECT n, (sy - (n * sxy - sx * sy) / (n * sxx - sx * sx) * sx) / n AS intercept, greatest((n * sxy - sx * sy) / (n * sxx - sx * sx), 0) AS slope FROM g)
"""


def _points(s: SparkSession, d: str) -> DataFrame:
    per = txs(s, d).groupBy("height").agg(F.count(F.lit(1)).alias("n"))
    return ordered.running_sum(per, F.col("n"), "bytes", F.col("height")).select("height", "bytes").filter("height % 100 = 0")


@query(_POINTS + "SELECT n, round(intercept, 4) AS intercept, round(slope, 4) AS slope FROM l")
def growth_regression(s, d):
    return measures.growth_line(_points(s, d), "height", "bytes").select("n", F.round("intercept", 4).alias("intercept"), F.round("slope", 4).alias("slope"))


@query(_POINTS + "SELECT CAST(floor(greatest(intercept + slope * 3000, 0)) AS BIGINT) AS projected FROM l")
def growth_projection(s, d):
    line = measures.growth_line(_points(s, d), "height", "bytes")
    return line.select(measures.project(line, 3000).alias("projected"))


@query("""WITH t AS (SELECT event_id, CASE WHEN event_id % 50 = 0 THEN 'network n' || user_id ELSE event_id || ' ' || user_id END AS line FROM events),
c AS (SELECT *, last_value(CASE WHEN line LIKE 'network%' THEN substr(line, 9) END IGNORE NULLS) OVER (ORDER BY event_id) AS section FROM t)
SELECT section, split_part(line, ' ', 1)::BIGINT AS height, split_part(line, ' ', 2)::BIGINT AS bytes FROM c WHERE line NOT LIKE 'network%'""", views=False)
def section_carry_forward(s, d):
    line = F.when(F.col("event_id") % 50 == 0, F.concat(F.lit("network n"), "user_id")).otherwise(F.concat_ws(" ", "event_id", "user_id"))
    return measures.carried_sections(table(s, d, "events").select("event_id", line.alias("line")), "event_id", "line")


@query("SELECT doc_id, sha256(unhex(sha256(text))) AS hash FROM documents", views=False)
def dsha256_docs(s, d):
    return table(s, d, "documents").select("doc_id", F.lower(F.hex(C.dsha256(F.col("text").cast("binary")))).alias("hash"))


@query("SELECT doc_id, array_to_string(list_reverse(regexp_extract_all(sha256(text), '..')), '') AS shown, sha256(text) AS stored FROM documents", views=False)
def display_hex(s, d):
    stored = F.unhex(F.sha2("text", 256))
    shown = C.display_hex(stored)
    return table(s, d, "documents").select("doc_id", shown.alias("shown"), F.lower(F.hex(C.from_display_hex(shown))).alias("stored"))


@query("SELECT doc_id, ('0x' || array_to_string(list_reverse(regexp_extract_all(substr(sha256(text), 1, 8), '..')), ''))::BIGINT AS value FROM documents", views=False)
def le_decode(s, d):
    return table(s, d, "documents").select("doc_id", C.le_uint(F.unhex(F.substring(F.sha2("text", 256), 1, 8))).alias("value"))


@query("SELECT doc_id, CASE WHEN n_chars < 253 THEN 1 WHEN n_chars <= 65535 THEN 3 ELSE 5 END AS width, CASE WHEN n_chars < 253 THEN printf('%02X', n_chars) WHEN n_chars <= 65535 THEN printf('FD%02X%02X', n_chars % 256, n_chars // 256) ELSE printf('FE%02X%02X%02X%02X', n_chars % 256, n_chars // 256 % 256, n_chars // 65536 % 256, n_chars // 16777216) END AS encoded FROM documents", views=False)
def varint_lengths(s, d):
    n = F.col("n_chars")
    return table(s, d, "documents").select("doc_id", C.varint_length(n).alias("width"), C.varint_hex(n).alias("encoded"))


@query("SELECT doc_id, n_chars AS value FROM documents", views=False)
def varint_round_trip(s, d):
    return table(s, d, "documents").select("doc_id", C.varint_value(F.unhex(C.varint_hex(F.col("n_chars")))).alias("value"))


@query("""WITH b AS (SELECT doc_id, sha256(coalesce(text, '')) AS h FROM documents),
n AS (SELECT doc_id, ('0x' || array_to_string(list_reverse(regexp_extract_all(h[:8], '..')), ''))::BIGINT AS four, ('0x' || array_to_string(list_reverse(regexp_extract_all(h[9:24], '..')), ''))::HUGEINT AS eight FROM b)
SELECT doc_id, CASE WHEN four >= 2147483648 THEN four - 4294967296 ELSE four END AS four, CASE WHEN eight >= 9223372036854775808::HUGEINT THEN eight - 18446744073709551616::HUGEINT ELSE eight END::BIGINT AS eight FROM n""", views=False)
def signed_decode(s, d):
    h = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    return table(s, d, "documents").select("doc_id", C.le_int(F.substring(h, 1, 4), 4).alias("four"), C.le_int(F.substring(h, 5, 8), 8).alias("eight"))


@query("""SELECT doc_id, '{"own":"' || array_to_string(list_reverse(regexp_extract_all(sha256(text), '..')), '') || '","lang":"' || array_to_string(list_reverse(regexp_extract_all(sha256(lang), '..')), '') || '"}' AS shown FROM documents""", views=False)
def hashes_as_json(s, d):
    hashed = table(s, d, "documents").select("doc_id", F.unhex(F.sha2("text", 256)).alias("own"), F.unhex(F.sha2("lang", 256)).alias("lang"))
    return hashed.select("doc_id", C.json_of("own", "lang").alias("shown"))


@query("SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'mainnet' WHEN 1 THEN 'testnet3' WHEN 2 THEN 'signet' WHEN 3 THEN 'testnet4' WHEN 4 THEN 'regtest' END AS network FROM events", views=False)
def network_names(s, d):
    magics = F.array(*[F.lit(x).cast("long") for x in (*C.MAGICS, 1)])
    return table(s, d, "events").select("event_id", C.network_of(F.element_at(magics, (F.col("event_id") % 6 + 1).cast("int"))).alias("network"))


@query("SELECT o_orderkey, printf('%.2f GiB', o_orderkey * 123456789.0::DOUBLE / 1073741824.0::DOUBLE) AS shown FROM orders", views=False)
def sizes_in_gib(s, d):
    return table(s, d, "orders").select("o_orderkey", C.gib(F.col("o_orderkey") * F.lit(123456789.0)).alias("shown"))


@query("SELECT event_id, 'x ' || event_type || CASE WHEN event_id % 11 = 0 THEN ' Stalled' ELSE '' END AS line FROM events WHERE event_id % 11 = 0", views=False)
def stall_lines(s, d):
    line = F.concat(F.lit("x "), "event_type", F.when(F.col("event_id") % 11 == 0, " Stalled").otherwise(""))
    return measures.stalls(table(s, d, "events").select("event_id", line.alias("line")), "line")


@query("""WITH h AS (SELECT event_id AS "at", event_id * 7 % 1000 AS height FROM events), m AS (SELECT *, max(height) OVER (ORDER BY "at" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM h WHERE height % 20 = 0 AND height > 0)
SELECT "at", height FROM m WHERE top IS NULL OR height > top""", views=False)
def recorder_points(s, d):
    return guard.due(table(s, d, "events").select(F.col("event_id").alias("at"), (F.col("event_id") * 7 % 1000).alias("height")), 20)


@query(_POINTS + """, r AS (SELECT n, CAST(floor(greatest(intercept + slope * 3000, 0)) AS BIGINT) AS projected FROM l)
SELECT projected, greatest(projected - 1000, 0) AS additional, greatest(50000000000 - greatest(projected - 1000, 0), 0) AS free_at_end, greatest(CAST(ceil((greatest(projected - 1000, 0) + 10737418240 - 50000000000) / 1073741824.0) AS BIGINT), 0) AS missing_gib FROM r""")
def space_preflight(s, d):
    """One row: what the projected growth leaves of 50 GB that are free."""
    found = guard.preflight(_points(s, d), 3000, 1000, 50_000_000_000)
    return s.createDataFrame([(found.projected, found.additional, found.free_at_end, found.missing_gib)], "projected long, additional long, free_at_end long, missing_gib long")


@query("SELECT l_linenumber AS code, CASE l_linenumber WHEN 0 THEN 'unknown' WHEN 1 THEN 'p2pk' WHEN 2 THEN 'p2pkh' WHEN 3 THEN 'p2sh' WHEN 4 THEN 'p2wpkh' WHEN 5 THEN 'p2wsh' WHEN 6 THEN 'p2tr' WHEN 7 THEN 'multisig' WHEN 8 THEN 'op_return' WHEN 9 THEN 'witness_unknown' ELSE 'unknown' END AS name, count(*) AS n FROM lineitem GROUP BY 1, 2", views=False)
def script_type_names(s, d):
    return table(s, d, "lineitem").groupBy(F.col("l_linenumber").alias("code"), C.script_type_name(F.col("l_linenumber")).alias("name")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, substr(sha256(text), 1, 40) || repeat('0', 24) AS padded FROM documents", views=False)
def pad_address(s, d):
    return table(s, d, "documents").select("doc_id", F.lower(F.hex(C.pad_hash(F.unhex(F.substring(F.sha2("text", 256), 1, 40))))).alias("padded"))


@query("SELECT o_orderkey, round(log2(CASE WHEN o_orderkey % 8388608 = 0 THEN 1 ELSE power(2.0, 256 - (log2((o_orderkey % 8388608)::DOUBLE) + 8 * (29 - 3))) END), 6) AS log_work FROM orders", views=False)
def work_from_bits(s, d):
    bits = F.lit(29 << 24).cast("long") + F.col("o_orderkey") % 8388608
    work = C.work_from_bits(bits)
    return table(s, d, "orders").select("o_orderkey", F.round(F.log2(F.when(work == 0, 1.0).otherwise(work)), 6).alias("log_work"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.error') IS NULL AS ok FROM events", views=False)
def json_rpc_envelope(s, d):
    e = F.from_json("props", "k string, error string")
    return table(s, d, "events").select("event_id", e["k"].alias("k"), e["error"].isNull().alias("ok"))


@query("""WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS r, count(*) OVER (PARTITION BY event_type) AS n FROM events)
SELECT event_type, count(*) AS n, max(value) FILTER (r = floor((n - 1) * 0.5 + 0.5)) AS p50, max(value) FILTER (r = floor((n - 1) * 0.99::DOUBLE + 0.5)) AS p99, max(value) AS largest, round(sum(value), 3) AS total FROM r GROUP BY 1""", views=False)
def latency_percentiles(s, d):
    return measures.nearest_rank(table(s, d, "events"), "event_type", "value").withColumn("total", F.round("total", 3))


@query("SELECT event_type AS stage, round(min(value), 6) AS low, round(median(value), 6) AS mid, round(max(value), 6) AS high FROM events GROUP BY 1", views=False)
def stage_medians(s, d):
    return measures.trials(table(s, d, "events"), "event_type", "value").select("stage", *[F.round(c, 6).alias(c) for c in ("low", "mid", "high")])


@query("SELECT event_type, round(count(*) / nullif(sum(value), 0), 6) AS per_unit, round(100.0 * count(*) / (SELECT count(*) FROM events), 6) AS share FROM events GROUP BY 1", views=False)
def rates(s, d):
    e = table(s, d, "events")
    own = e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("v"))
    return own.select("event_type", F.round(measures.ratio(F.col("n"), F.col("v")), 6).alias("per_unit"), F.round(100.0 * measures.ratio(F.col("n"), F.sum("n").over(Window.partitionBy())), 6).alias("share"))


@query("SELECT event_id FROM (SELECT event_id, sum(112) OVER (ORDER BY event_id DESC) AS used FROM events) WHERE used <= 11200", views=False)
def cache_budget_window(s, d):
    return measures.within_budget(table(s, d, "events").select("event_id"), F.lit(112), 11200, F.desc("event_id"))


@query("SELECT user_id FROM events WHERE event_type = 'error' UNION SELECT user_id FROM events WHERE event_type = 'click'", views=False)
def union_tips(s, d):
    e = table(s, d, "events")
    return e.filter("event_type = 'error'").select("user_id").union(e.filter("event_type = 'click'").select("user_id")).distinct()
