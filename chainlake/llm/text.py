"""Words, word fingerprints and n-gram fingerprints of whole texts, vectorised with numpy.

A word is a maximal run of characters other than U+0020 and U+0009..U+000D, which is what
``bytes.split()`` yields on UTF-8. Fingerprints have 64 bits and depend on nothing but the
words, so all executors and all runs agree.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash

#: The same words as a regular expression, for Spark's and DuckDB's functions.
WORD = r"[^\x20\x09-\x0D]+"

_M0, _M1, _M2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))


#: A word's fingerprint. Words are made anew more often than they recur, so a table of known ones costs more than it saves.
word_hash = xxhash.xxh3_64_intdigest


_held: dict[Hashable, object] = {}


def keep(owner: Hashable, make: Callable[[], object]):
    """What a worker process keeps from one task to the next: one thing, that of the operator that ran last."""
    if owner not in _held:
        _held.clear()
        give_back()
        _held[owner] = make()
    return _held[owner]


def let_go() -> None:
    """Forget what an operator that ran earlier kept."""
    if _held:
        _held.clear()
        give_back()


def give_back() -> None:
    """Return freed memory to the system; workers live on between stages and share an executor's memory."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def mix(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """An order-dependent 64-bit combination of two arrays of fingerprints."""
    with np.errstate(over="ignore"):
        z = x * _M0 + (y ^ (y >> np.uint64(31))) * _M1
        z ^= z >> np.uint64(32)
        z *= _M2
        z ^= z >> np.uint64(29)
    return z


def ngrams(words: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints of all runs of ``n`` elements, by doubling: O(log n) passes."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    done, length, power, width = None, 0, words, 1
    while True:
        if n & width:
            if done is None:
                done, length = power, width
            else:
                k = len(power) - length
                done = mix(done[:k], power[length : length + k])
                length += width
        if length == n:
            return mix(done, np.full(len(done), n, np.uint64))
        power = mix(power[: len(power) - width], power[width:])
        width *= 2


def hashed_words(parts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """All words' fingerprints in one array, and each text's number of words."""
    lens = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.fromiter(map(word_hash, chain.from_iterable(parts)), np.uint64, int(lens.sum())), lens


def room_after(lens: np.ndarray) -> np.ndarray:
    """For each position of concatenated texts, the number of words from it to its text's end."""
    ends = np.cumsum(lens)
    return np.repeat(ends, lens) - np.arange(int(lens.sum()), dtype=np.int64)


def slices(batch: pa.RecordBatch, column: str, most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """The batch in row slices of about ``most`` bytes of ``column``; a longer text comes alone."""
    total = np.cumsum(_lengths(batch.column(column)))
    start = 0
    while start < batch.num_rows:
        base = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, base + most, "right")))
        yield batch.slice(start, end - start)
        start = end
    give_back()


def _lengths(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)


def utf8(column: pa.Array) -> list[bytes | None]:
    """The texts as UTF-8 bytes, without decoding."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()
