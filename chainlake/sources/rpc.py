"""A node's JSON-RPC interface over any transport; the HTTP one needs the standard library only.

A transport is a callable (method, params) -> the answer's text. ``Node`` is what the tip
follower asks: tip(), hash_at(height), raw_at(height).
"""

from __future__ import annotations

import base64
import json
import urllib.request
from collections.abc import Callable
from pathlib import Path

from .codec import BadBlock

Transport = Callable[[str, list], str]


class RpcError(RuntimeError):
    """The node answered with an error, or with neither a result nor an error."""


def result_of(text: str):
    """The result of an answer; null is one only if the error is null too and the call allows it."""
    answer = json.loads(text)
    if not isinstance(answer, dict):
        raise RpcError("the answer is no object")
    if answer.get("error") is not None:
        error = answer["error"]
        raise RpcError(f"{error.get('code')}: {error.get('message')}" if isinstance(error, dict) else str(error))
    if answer.get("result") is None:
        raise RpcError("neither result nor error")
    return answer["result"]


def http(url: str, user: str | None = None, password: str | None = None, cookie: str | None = None, timeout: float = 120.0) -> Transport:
    """By HTTP with basic authorisation: user and password, or the content of a cookie file."""
    secret = Path(cookie).read_text().strip() if cookie else f"{user}:{password}" if user else None

    def call(method: str, params: list) -> str:
        body = json.dumps({"jsonrpc": "1.0", "id": "chainlake", "method": method, "params": params}).encode()
        request = urllib.request.Request(url, body, {"Content-Type": "application/json"})
        if secret:
            request.add_header("Authorization", "Basic " + base64.b64encode(secret.encode()).decode())
        with urllib.request.urlopen(request, timeout=timeout) as answer:
            return answer.read().decode()

    return call


def _bytes(text: str, length: int | None = None) -> bytes:
    try:
        found = bytes.fromhex(text)
    except ValueError as e:
        raise RpcError(f"no hexadecimal text: {text[:20]!r}") from e
    if length is not None and len(found) != length:
        raise RpcError(f"{len(found)} bytes in place of {length}")
    return found


class Node:
    def __init__(self, transport: Transport):
        self.transport = transport

    def call(self, method: str, *params):
        return result_of(self.transport(method, list(params)))

    def tip(self) -> int:
        return int(self.call("getblockcount"))

    def hash_at(self, height: int) -> bytes | None:
        """In stored order; None above the tip."""
        if height > self.tip():
            return None
        return _bytes(self.call("getblockhash", height), 32)[::-1]

    def header(self, hash_: bytes) -> dict:
        return self.call("getblockheader", hash_[::-1].hex())

    def raw_at(self, height: int) -> bytes:
        raw = _bytes(self.call("getblock", self.call("getblockhash", height), 0))
        if len(raw) < 80:
            raise BadBlock(f"{len(raw)} bytes are no header")
        return raw

    def tips(self) -> list[tuple[bytes, int, str]]:
        """(hash in stored order, branch length, status) of all known branches."""
        return [(_bytes(t["hash"], 32)[::-1], int(t["branchlen"]), t["status"]) for t in self.call("getchaintips")]

    def stale_hashes(self) -> set[bytes]:
        """The blocks of all branches that were left behind, each walked back by its length."""
        found: set[bytes] = set()
        for hash_, length, status in self.tips():
            if status in ("active", "headers-only"):
                continue
            for _ in range(length):
                found.add(hash_)
                before = self.header(hash_).get("previousblockhash")
                if before is None:
                    break
                hash_ = _bytes(before, 32)[::-1]
        return found
