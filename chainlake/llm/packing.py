"""Best-fit packing of tokenized documents into fixed-length sequences (operator 2).

Large items (above a third of the capacity) go at most two to a bin, matched greedily:
largest first, each with the largest partner that still fits. Small items then fill the
remaining gaps by best fit, largest first.

Items of equal length are interchangeable, so the packing is planned on the histogram of
lengths (at most ``capacity`` rows, whatever the corpus holds): the plan is a list of bin
patterns with multiplicities. Each piece then takes the place that its rank among the
pieces of its length has in the plan. Ranks are distributed: counts per (length, hash
bucket), prefix sums over these, and a rank within the bucket of about ``bucket_rows``
rows, so that a length that a third of all pieces share is not ranked in one task.

Edge cases: a null or empty text is one piece that holds just the end token; texts longer
than the capacity are cut into full pieces and a rest; repeated rows are packed each; a
null id is allowed; an empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

import os
import uuid
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import store, text_batches
from .text import keep, slices


_SIGNS = frozenset(".,;:!?")
_MARK = "\x01"


class Encoded:
    """Token ids of texts, by runs of characters without space or line feed.

    The vocabulary's tokens never span those two characters, so a text's ids are its runs'
    ids in turn. A batch's distinct runs are looked up once; those that are not known yet are
    encoded together, thousands in a call. What is known lives in two generations of at most
    ``limit`` runs: a run that is met again moves to the younger, the older is forgotten.
    """

    def __init__(self, path: str, limit: int = 600_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.young: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}
        (self.mark,) = self.tokenizer.encode(_MARK, add_special_tokens=False).ids
        # words of small ASCII letters need neither the normaliser nor the splitting pattern
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer, self.letters.pre_tokenizer = None, pre_tokenizers.WhitespaceSplit()
        vocab = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocab.values()) + 1, bool)
        self.closes[[i for token, i in vocab.items() if token.endswith("</w>")]] = True

    def texts(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian bytes."""
        runs = pc.split_pattern(pa.array(map(self._clean, texts), pa.large_string(), size=len(texts)), " ")
        coded = runs.flatten().dictionary_encode()
        ids = pa.array(self._known(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(coded.indices)
        _, ends, raw = ids.buffers()
        ends = np.frombuffer(ends, np.int64)[runs.offsets.to_numpy()].tolist()
        raw = raw.to_pybytes()
        return [raw[a:b] for a, b in zip(ends, ends[1:])]

    @staticmethod
    def _clean(text: str) -> str:
        text = text.replace("\n", " ")
        # the tokenizer lower-cases; in capitals, the names of special tokens are ordinary text
        return text.lower() if text.isascii() and "<|" not in text else text

    def _known(self, runs: list[str]) -> list[bytes]:
        """The ids of each of these distinct runs."""
        young, old = self.young, self.old
        found = dict(zip(runs, map(young.get, runs)))
        new, bases = [], {}
        for r in [r for r, ids in found.items() if ids is None]:
            if r in old:
                found[r] = young[r] = old[r]
            elif r[-1] in _SIGNS and r[-2:-1].isascii() and r[-2:-1].isalpha():
                bases[r] = r[:-1]  # one sign after an ASCII letter is a token of its own: learn the word without it
            else:
                new.append(r)
        parts = {r: found.get(r) or young.get(r) or old.get(r) for r in [*bases.values(), *_SIGNS]} if bases else {}
        parts |= self._learn(list(dict.fromkeys([*new, *(r for r, ids in parts.items() if not ids)])))
        for r, base in bases.items():
            found[r] = young[r] = parts[base] + parts[r[-1]]
        for r in new:
            found[r] = parts[r]
            if len(r) <= 64:
                young[r] = parts[r]
        if len(young) > self.limit:
            self.young, self.old = {"": b""}, young
        return list(found.values())

    def _learn(self, runs: list[str], together: int = 2000) -> dict[str, bytes]:
        learned: dict[str, bytes] = {}

        def add(part: list[str], tokenizer, text: str, ends, gap: int) -> None:
            """The ids of ``part`` within those of ``text``; each run's end at ``ends``, ``gap`` ids after it left out."""
            ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            cuts, raw = np.flatnonzero(ends(ids)) + 1, ids.tobytes()
            starts = [0, *(4 * cuts).tolist()]
            learned.update(zip(part, [raw[a:b] for a, b in zip(starts, (4 * (cuts - gap)).tolist())], strict=True))

        words = [r for r in runs if r.isascii() and r.isalpha() and r.islower()]
        for i in range(0, len(words), together):
            part = words[i : i + together]
            add(part, self.letters, " ".join(part), self.closes.__getitem__, 0)
        marked = [r for r in runs if r not in learned and _MARK not in r and "<|" not in r]
        for i in range(0, len(marked), together):
            part = marked[i : i + together]
            add(part, self.tokenizer, f" {_MARK} ".join([*part, ""]), lambda ids: ids == self.mark, 1)
        rest = [r for r in runs if r not in learned]
        for r, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            learned[r] = np.array(e.ids, "<u4").tobytes()
        return learned


PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece of a document: ``PIECE``."""
    text_batches(docs.sparkSession)
    end, call = np.array([end_id], "<u4").tobytes(), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoded = keep(("tokens", tokenizer, call), lambda: Encoded(tokenizer))  # tasks of this call share what is known
        for batch in (part for whole in batches for part in slices(whole, "text")):
            rows: tuple[list, ...] = ([], [], [], [], [])
            for key, own in zip(batch.column(0).to_pylist(), encoded.texts([t or "" for t in batch.column(1).to_pylist()])):
                ids = memoryview(own + end)
                for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                    piece = ids[at : at + 4 * capacity]
                    for column, value in zip(rows, (key, n, at // 4, len(piece) // 4, zlib.crc32(piece))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(rows, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id).cast("long"), F.col(text).alias("text")).mapInArrow(run, PIECE)


@dataclass(order=True)
class _Bins:
    """``count`` equal bins: what they hold as (length, how many, offset)."""

    gap: int
    count: int
    items: list[tuple[int, int, int]] = field(default_factory=list)


def plan(histogram: dict[int, int], capacity: int) -> list[_Bins]:
    """Bin patterns for ``histogram`` (length -> number of pieces)."""
    large = {n: c for n, c in histogram.items() if 3 * n > capacity}
    bins = list(_match(large, capacity))
    by_gap: dict[int, list[_Bins]] = {}
    for b in bins:
        by_gap.setdefault(b.gap, []).append(b)
    gaps = sorted(by_gap)
    for length in sorted((n for n in histogram if 3 * n <= capacity), reverse=True):
        _fill(length, histogram[length], capacity, by_gap, gaps)
    return [b for group in by_gap.values() for b in group]


def _match(left: dict[int, int], capacity: int) -> Iterator[_Bins]:
    lengths = sorted(left)
    while lengths:
        first = lengths[-1]
        second = capacity - first
        at = bisect_left(lengths, second + 1) - 1
        if at < 0:
            yield _Bins(capacity - first, left[first], [(first, 1, 0)])
            lengths.pop()
            continue
        second = lengths[at]
        if second == first:
            pairs, odd = divmod(left[first], 2)
            if pairs:
                yield _Bins(capacity - 2 * first, pairs, [(first, 2, 0)])
            left[first] = odd
            if odd:
                lower = lengths[:-1]
                other = lower[-1] if lower else None
                if other is None:
                    yield _Bins(capacity - first, 1, [(first, 1, 0)])
                else:
                    yield _Bins(capacity - first - other, 1, [(first, 1, 0), (other, 1, first)])
                    left[other] -= 1
                    if not left[other]:
                        lengths.remove(other)
            lengths.pop()
            continue
        n = min(left[first], left[second])
        yield _Bins(capacity - first - second, n, [(first, 1, 0), (second, 1, first)])
        for length in (first, second):
            left[length] -= n
            if not left[length]:
                lengths.remove(length)


def _fill(length: int, count: int, capacity: int, by_gap: dict[int, list[_Bins]], gaps: list[int]) -> None:
    """Best fit for ``count`` items: the tightest gaps first; a bin that still fits takes the next item too."""

    def put(bins: _Bins, n: int, each: int) -> None:
        gap = bins.gap - each * length
        if gap not in by_gap:
            by_gap[gap] = []
            insort(gaps, gap)
        by_gap[gap].append(_Bins(gap, n, [*bins.items, (length, each, capacity - bins.gap)]))

    while count:
        at = bisect_left(gaps, length)
        if at == len(gaps):
            bins = _Bins(capacity, -(-count // (capacity // length)))
        else:
            group = by_gap[gaps[at]]
            bins = group.pop()
            if not group:
                del by_gap[gaps[at]]
                gaps.pop(at)
        each = bins.gap // length
        n = min(bins.count, count // each)
        if n:
            put(bins, n, each)
            count -= n * each
        untouched = bins.count - n
        if count and untouched:
            put(bins, 1, count)
            untouched -= 1
            count = 0
        if untouched:
            rest = _Bins(bins.gap, untouched, bins.items)
            if rest.gap not in by_gap:
                by_gap[rest.gap] = []
                insort(gaps, rest.gap)
            by_gap[rest.gap].append(rest)


def places(bins: list[_Bins]) -> np.ndarray:
    """Rows (length, first rank, each, first sequence, offset) by length and first rank.

    Among the pieces of this length, the one of rank r >= first rank (and below the next
    row's) lies in sequence first + (r - first rank) // each, at offset + length * ((r - first rank) % each).
    """
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for b in bins:
        for length, each, offset in b.items:
            at = used.get(length, 0)
            rows.append((length, at, each, sequence, offset))
            used[length] = at + each * b.count
        sequence += b.count
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(cut: DataFrame, capacity: int = 4096, bucket_rows: int = 20_000) -> DataFrame:
    """``cut`` (as of :func:`pieces`) with sequence_id and offset."""
    rows = store(cut, "pieces")
    histogram = {r[0]: r[1] for r in rows.groupBy("length").count().collect()}  # at most `capacity` rows
    parts = max(1, -(-sum(histogram.values()) // bucket_rows))
    table = places(plan(histogram, capacity))
    shift = 44  # ranks below 2**44
    keys = (table[:, 0] << shift) | table[:, 1]
    sent = rows.sparkSession.sparkContext.broadcast((keys, table))  # bounded by the patterns over `capacity` lengths

    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    local = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = rows.withColumn("local", local).join(counts, ["length", "bucket"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("local")).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, table = sent.value
        for batch in batches:
            length, rank = (batch.column(i).to_numpy() for i in (3, 5))
            row = table[np.searchsorted(keys, (length << shift) | rank, "right") - 1]
            within = rank - row[:, 1]
            columns = [batch.column(i) for i in range(5)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(row[:, 3] + within // row[:, 2]), pa.array(row[:, 4] + length * (within % row[:, 2]))], names=[*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(run, PIECE + ", sequence_id long, offset long")
