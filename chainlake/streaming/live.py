"""Following a node's tip: seed, reconcile, apply; reorganisations retract what they replace.

The node is any object with tip() -> height, hash_at(height) -> bytes or None and
raw_at(height) -> bytes. The store is any object with tip() -> (height, hash) or None,
hash_at(height), apply(height, block) and retract(fork). Notifications only trigger
catch_up, which is idempotent, so lost, late and repeated ones do no harm.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import dsha256
from ..operators import chain, spends
from ..sources import blk, codec, sinks
from ..sources.shared import LARGE, forget, written

TOPIC = b"hashblock"
_log = logging.getLogger(__name__)


class NoUndo(RuntimeError):
    """A height to take back that the store does not hold."""


class ReorgTooDeep(RuntimeError):
    """The fork lies deeper than the allowed depth."""


def hash_notice(frames: list[bytes]) -> bytes:
    """The block hash of a multipart notification: topic, 32-byte payload, sequence. Another topic is only logged."""
    if frames and frames[0] != TOPIC:
        _log.warning("notification of topic %r", frames[0])
    if len(frames) < 2 or len(frames[1]) != 32:
        raise ValueError("malformed notification")
    return frames[1]


def catch_up(node, store, most_depth: int = 100) -> Iterator[tuple[str, int]]:
    """Events (kind, height): seeded, reorg_start, disconnected, applied, caught_up."""
    top, own = node.tip(), store.tip()
    if own is None:
        start = top
    else:
        fork = own[0]
        while fork >= 0 and node.hash_at(fork) != store.hash_at(fork):
            fork -= 1
            if own[0] - fork > most_depth:
                raise ReorgTooDeep(f"over {most_depth} blocks")
        if fork < own[0]:
            yield "reorg_start", own[0] - fork
            store.retract(fork)
            for height in range(own[0], fork, -1):
                yield "disconnected", height
        start = fork + 1
    for height in range(start, top + 1):
        store.apply(height, codec.block(node.raw_at(height)))
        yield "applied", height
    yield "caught_up", top


class MemoryStore:
    """Blocks by height, for tests and small chains."""

    def __init__(self):
        self.blocks: dict[int, dict] = {}

    def tip(self):
        return (h := max(self.blocks), self.blocks[h]["hash"]) if self.blocks else None

    def hash_at(self, height: int):
        return self.blocks[height]["hash"] if height in self.blocks else None

    def apply(self, height: int, block: dict) -> None:
        self.blocks[height] = block

    def retract(self, fork: int) -> None:
        self.blocks = {h: b for h, b in self.blocks.items() if h <= fork}


class TableStore:
    """Blocks as the five entity tables below ``root``. They are the whole state, so a new store on the same root goes on where the last one ended.

    A height is there once its row is in blocks, which is written last and taken back first;
    rows of other tables beyond the tip, left by a crash, go when the store is opened.
    """

    def __init__(self, spark: SparkSession, root: str, blocks_per_part: int = 1000):
        self.spark, self.root, self.width = spark, root, blocks_per_part
        top = self.tip()
        if top is not None:
            for name in sinks.ENTITIES[1:]:
                if self._has(name) and self.table(name).filter(F.col("height") > top[0]).limit(1).count():
                    sinks.retract(spark, root, name, top[0], self.width)

    def _has(self, name: str) -> bool:
        return sinks.exists(self.spark, f"{self.root}/{name}")

    def table(self, name: str) -> DataFrame:
        return sinks.read(self.spark, self.root, name, blk.empty(self.spark)[name])

    def tip(self) -> tuple[int, bytes] | None:
        if not self._has("blocks"):
            return None
        row = self.table("blocks").agg(F.max(F.struct("height", "hash")).alias("top")).first()["top"]
        return None if row is None else (row["height"], bytes(row["hash"]))

    def hash_at(self, height: int) -> bytes | None:
        row = sinks.scan(self.spark, self.root, "blocks", height, height, self.width).select("hash").first() if self._has("blocks") else None
        return bytes(row[0]) if row else None

    def apply(self, height: int, block: dict) -> None:
        """One decoded block, as :func:`catch_up` gives it."""
        self._put(blk.as_frame(self.spark, [{"height": height} | block]))

    def apply_all(self, payloads: DataFrame) -> None:
        """(height, payload) rows: blocks that follow the tip, in any number."""
        self._put(blk.decoded(payloads))

    def _put(self, decoded: DataFrame) -> None:
        decoded = written(decoded, "decoded", LARGE)
        found = blk.tables(decoded)
        older = None
        if self._has("outputs"):
            wanted = found["inputs"].filter(~F.col("is_coinbase")).select(F.col("prev_txid").alias("txid"), F.col("prev_vout").alias("output_index")).distinct()
            gone = self.table("spends").select(F.col("spent_txid").alias("txid"), F.col("spent_vout").alias("output_index"), F.col("spent_height").alias("height"))
            older = self.table("outputs").join(wanted, ["txid", "output_index"], "left_semi").join(gone, ["txid", "output_index", "height"], "left_anti")
            older = written(older.join(found["blocks"].select("height"), "height", "left_anti"), "older")  # before the tables it is read from change
        whole = blk.linked(found, older, keep=True)
        for name in reversed(sinks.ENTITIES):
            sinks.merge(whole[name], self.root, name, self.width)
        forget(decoded)

    def undo(self, height: int) -> DataFrame:
        """(kind, txid, vout) of what taking back a height restores and removes."""
        if self.hash_at(height) is None:
            raise NoUndo(str(height))
        at = lambda name: sinks.scan(self.spark, self.root, name, height, height, self.width)
        return spends.undo_rows(at("outputs").withColumnRenamed("output_index", "vout"), at("spends")).select("kind", "txid", "vout")

    def unspent(self) -> DataFrame:
        return spends.utxo_at(self.table("outputs").withColumnRenamed("output_index", "vout"), self.table("spends"), 1 << 40)

    def retract(self, fork: int) -> None:
        """Take back all heights above ``fork``, rows of all tables."""
        top = self.tip()
        if top is None or fork >= top[0]:
            raise NoUndo(f"above {fork}")
        for name in sinks.ENTITIES:
            sinks.retract(self.spark, self.root, name, fork, self.width)


def catch_up_table(branch: DataFrame, store: TableStore, most_depth: int = 100) -> Iterator[tuple[str, int]]:
    """:func:`catch_up` for a node's whole branch as rows (height, payload): one job for all blocks that are new."""
    own = store.tip()
    top = branch.agg(F.max("height")).first()[0]
    fork = -1
    if own is not None:
        theirs = branch.select("height", dsha256(F.substring("payload", 1, 80)).alias("hash"))
        fork = chain.fork_point(store.table("blocks").select("height", "hash"), theirs).first()[0]
        fork = -1 if fork is None else fork
        if own[0] - fork > most_depth:
            raise ReorgTooDeep(f"{own[0] - fork} blocks, over {most_depth}")
        if fork < own[0]:
            yield "reorg_start", own[0] - fork
            store.retract(fork)
            for height in range(own[0], fork, -1):
                yield "disconnected", height
    fresh = branch.filter(F.col("height") > fork)
    if not fresh.isEmpty():
        store.apply_all(fresh)
        low = fresh.agg(F.min("height")).first()[0]
        for height in range(low, top + 1):
            yield "applied", height
    yield "caught_up", top


def polled(seconds: float = 2.0, sleep: Callable[[float], None] = time.sleep) -> Iterator[None]:
    """Notices at a fixed interval, where there are no others."""
    while True:
        yield None
        sleep(seconds)


def follow(node, store, notices: Iterable, on_event: Callable[[tuple[str, int]], None], most_depth: int = 100, sleep: Callable[[float], None] = time.sleep) -> None:
    """Catch up once, then after every notice, whatever it says. Lost connections are waited out; a reorganisation that is too deep ends it."""

    def once() -> None:
        try:
            for event in catch_up(node, store, most_depth):
                on_event(event)
        except (ConnectionError, TimeoutError, OSError) as e:
            _log.warning("%s; trying again", e)
            sleep(1.0)

    once()
    for notice in notices:
        if notice is not None:
            try:
                hash_notice(notice)
            except ValueError as e:
                _log.warning("%s", e)
        once()
