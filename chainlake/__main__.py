"""python -m chainlake COMMAND: headers, parse, init-db, load, inspect, live, bench."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import jobs
from .operators import guard
from .sources import blk, rpc, sinks
from .streaming import live


def _arguments() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="chainlake")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, *options: tuple) -> None:
        own = commands.add_parser(name)
        for flag, how in options:
            own.add_argument(flag, **how)

    folder, out, text = ("folder", {}), ("out", {}), {"default": None}
    number = lambda value: {"type": int, "default": value}
    node = (("--rpc-url", text), ("--rpc-cookie", text))
    watch = (("--network", {"default": "mainnet"}), ("--checkpoint-file", text))
    command("headers", folder)
    command("parse", folder, out, ("--start", number(0)), ("--end", number(None)), ("--blocks-per-part", number(10_000)), ("--skip-disk-check", {"action": "store_true"}), *node, *watch)
    command("init-db", ("database", {}))
    command("load", out, ("database", {}))
    command("inspect", folder, ("height", {"type": int}))
    command("live", out, ("--max-reorg-depth", number(100)), ("--seconds", {"type": float, "default": 2.0}), *node, *watch, ("--step", number(100_000)))
    command("bench", folder, ("--mode", {"choices": jobs.MODES, "default": "full"}), ("--repeat", number(1)), ("--out", text), ("--allow-missing-outputs", {"action": "store_true"}))
    return top


def _node(a: argparse.Namespace) -> rpc.Node | None:
    return rpc.Node(rpc.http(a.rpc_url, cookie=a.rpc_cookie)) if a.rpc_url else None


def main(argv: list[str] | None = None) -> int:
    a = _arguments().parse_args(argv)
    spark = SparkSession.builder.appName("chainlake").getOrCreate()
    if a.command == "headers":
        records, nodes, chain = jobs.header_index(spark, a.folder)
        row = chain.orderBy(F.desc("height")).first()
        print(json.dumps(jobs.chain.header_stats(records, nodes, chain).first().asDict() | {"network": blk.network(blk.files(spark, a.folder), blk.xor_key(spark, a.folder)), "tip": row["height"], "hash": bytes(row["hash"])[::-1].hex()}))
    elif a.command == "parse":
        node = _node(a)
        if node and a.checkpoint_file and not a.skip_disk_check:
            points = guard.history(spark, a.checkpoint_file, a.network)
            print(guard.preflight(points, node.tip(), guard.folder_bytes(a.out), guard.free_bytes(a.out)).text(), file=sys.stderr)
        found = jobs.index(spark, a.folder, a.out, a.start, a.end, node.stale_hashes() if node else frozenset(), a.blocks_per_part)
        if a.checkpoint_file:
            guard.append_point(a.checkpoint_file, a.network, found["high"] - 1, guard.folder_bytes(a.out))
        print(json.dumps(found))
    elif a.command == "init-db":
        sinks.create_tables(spark, a.database, blk.empty(spark))
    elif a.command == "load":
        for name in sinks.KEYS:
            sinks.load(spark, a.database, name, sinks.read(spark, a.out, name, blk.empty(spark)[name]))
    elif a.command == "inspect":
        print(jobs.inspect(spark, a.folder, a.height))
    elif a.command == "live":
        node = _node(a)
        if node is None:
            print("--rpc-url is needed", file=sys.stderr)
            return 2
        recorder = guard.Recorder(a.checkpoint_file, a.network, [a.out], a.step) if a.checkpoint_file else None

        def tell(event: tuple[str, int]) -> None:
            print(*event, flush=True)
            if recorder and event[0] == "applied":
                recorder.on_block(event[1])

        live.follow(node, live.TableStore(spark, a.out), live.polled(a.seconds), tell, a.max_reorg_depth)
    else:
        print(jobs.report(jobs.bench(spark, a.folder, a.mode, a.repeat, a.out, a.allow_missing_outputs)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
