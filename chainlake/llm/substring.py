"""Removal of repeated passages with Aho-Corasick automata (operator 5).

A window is ``width`` consecutive words. Every word that lies in a window whose words also
start earlier (smaller id, or same id and smaller start, or both the same in another text of
that id that is placed before this one) is removed; windows are judged on the input.

1. Anchors: in each window the 8-word phrase of least hash. Equal windows have equal
   anchors, so a window can only recur if its anchor does. About one phrase in seven is an
   anchor; their counts over the whole corpus confirm the recurring ones.
2. Documents and phrases are dealt to shards of about ``bucket_rows`` documents by a hash of id and
   text: a shard gets the recurring phrases that its documents may hold, each with one place
   where its words stand. They are compiled to an automaton (over word numbers), and all
   the shard's documents stream through it, which locates every occurrence. The windows
   around an occurrence are the only ones that can recur.
3. These windows' hashes meet, each with the least (id, start) of its shard only; what is
   not the least of all is removed. The texts are read by shard again and cut.

Copies, windows and cuts belong to a row, known by its bucket and its place among the
bucket's (id, text) in order; the id alone only says what is earlier.

A passage that a third of all documents share meets as one row a bucket, not one a
document; anchors that many rows of a bounded sample hold are known to recur and are not
gathered by their hash. Texts that equal an earlier text as a whole are settled by their
SHA-256 beforehand: with ``width`` words or more nothing of them stays.

Edge cases: a null text has no words; texts of fewer than ``width`` words lose nothing; rows
with equal id and text are one document and get equal answers, null ids too; different texts
of one id, or of null ids, are documents of their own; a null id comes after all others; an
empty table gives an empty table; columns that are not carried are ignored; ids are whole numbers. Hashes of
phrases and windows have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .scratch import store, text_batches
from .text import hashed_words, let_go, ngrams, room_after, slices, utf8, word_hash

PHRASE = 8
_LAST = (1 << 63) - 1  # stands for a null id
_SALTS = 64


def anchors(flat: np.ndarray, lens: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the phrases that are the least of some window of their text."""
    grams = ngrams(flat, PHRASE)
    span = width - PHRASE + 1
    starts = np.flatnonzero(room_after(lens)[: max(0, len(grams) - span + 1)] >= width)
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    least = np.lib.stride_tricks.sliding_window_view(grams, span).argmin(1)
    at = np.unique(starts + least[starts])
    return at, grams[at]


def _order(id: str):
    return F.coalesce(F.col(id).cast("long"), F.lit(_LAST))


def _recurring(dealt: DataFrame, total: int, width: int, sample_rows: int) -> DataFrame:
    """(bucket, hash, row, start) of the anchors that the corpus has more than once, with one place in each bucket that has it."""

    def counted(heavy):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            let_go()
            for whole in batches:
                for batch in slices(whole, "_text"):
                    flat, lens = hashed_words([(x or b"").split() for x in utf8(batch.column(1))])
                    at, grams = anchors(flat, lens, width)
                    text = np.searchsorted(np.cumsum(lens), at, "right")
                    bucket = batch.column(0).to_numpy()[text]
                    row, start = batch.column(2).to_numpy()[text], at - (np.cumsum(lens) - lens)[text]
                    order = np.lexsort((bucket, grams))
                    bucket, grams = bucket[order], grams[order]
                    first = np.flatnonzero(np.concatenate([[True], (grams[1:] != grams[:-1]) | (bucket[1:] != bucket[:-1])])) if len(grams) else np.empty(0, np.int64)
                    n = np.diff(np.append(first, len(grams)))
                    bucket, grams, row, start = bucket[first], grams[first].view(np.int64), row[order[first]], start[order[first]].astype(np.int32)
                    salt = np.zeros(len(grams), np.int32)
                    if heavy is not None and len(heavy.value) and len(grams):
                        near = np.minimum(np.searchsorted(heavy.value, grams), len(heavy.value) - 1)
                        salt = np.where(heavy.value[near] == grams, 1 + bucket % _SALTS, 0).astype(np.int32)
                    for i in range(0, len(grams), 100_000):
                        made = {"hash": grams, "bucket": bucket, "n": n.astype(np.int32), "salt": salt, "row": row, "start": start}
                        yield pa.RecordBatch.from_pydict({k: x[i : i + 100_000] for k, x in made.items()})

        return run

    schema = "hash long, bucket int, n int, salt int, row long, start int"
    texts = dealt.select("_bucket", "_text", "_row")
    every = max(1, -(-total // sample_rows))
    sample = dealt.filter(F.pmod(F.xxhash64("_order", "_text", F.lit("heavy")), F.lit(every)) == 0).select("_bucket", "_text", "_row")
    least = max(50, sample_rows // 200)
    found = sample.mapInArrow(counted(None), schema).groupBy("hash").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    heavy = np.sort(np.array([r[0] for r in found.select("hash").collect()], np.int64))  # at most (anchors of the sample) / least
    sent = dealt.sparkSession.sparkContext.broadcast(heavy)
    rows = texts.mapInArrow(counted(sent), schema)
    times = F.sum("n").over(Window.partitionBy("hash", "salt"))
    often = rows.withColumn("times", times).filter("salt > 0 or times > 1")
    return often.groupBy("bucket", "hash").agg(F.min(F.struct("row", "start")).alias("at")).select("bucket", "hash", "at.row", "at.start")


def _copies(dealt: DataFrame) -> DataFrame:
    """(bucket, order, sha) of the rows whose whole text an earlier id has."""
    texts = dealt.filter("_text is not null").select("_bucket", "_order", F.unhex(F.sha2("_text", 256)).alias("sha"))
    first = texts.groupBy("sha").agg(F.min("_order").alias("low"), F.max("_order").alias("high")).filter("low < high")
    first = store(first, "copied")  # written, so the join has exchanges of its own, which Spark can split where a text is frequent
    return texts.join(first, "sha").filter("_order > low").select(F.col("_bucket").alias("bucket"), F.col("_order").alias("order"), "sha").distinct()


def _places(orders: np.ndarray, texts: list[bytes | None]) -> np.ndarray:
    """The place of each row among the different (order, text) of its bucket."""
    keys = [(o, x or b"") for o, x in zip(orders.tolist(), texts)]
    place = {k: i for i, k in enumerate(sorted(set(keys)))}
    return np.fromiter((place[k] for k in keys), np.int64, len(keys))


def _is_copy(told: pa.Table, orders: np.ndarray, texts: list[bytes | None]) -> list[bool]:
    """Which rows the told (order, sha) name."""
    copies = set(zip(told.column("order").combine_chunks().drop_null().to_pylist(), told.column("sha").combine_chunks().drop_null().to_pylist()))
    ids = {o for o, _ in copies}
    return [o in ids and (o, sha256(x or b"").digest()) in copies for o, x in zip(orders.tolist(), texts)]


def _automaton(told: pa.Table, rows: np.ndarray, texts: list[bytes | None], number: dict[int, int]):
    """The automaton of the told phrases, in numbers of word hashes; None if no fresh text can hold any."""
    import ahocorasick

    places: dict[int, list[int]] = {}
    for i, row in enumerate(rows.tolist()):
        places.setdefault(row, []).append(i)
    words: dict[int, list[bytes]] = {}
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH, ahocorasick.KEY_SEQUENCE)
    for gram, row, start in zip(*(told.column(c).to_pylist() for c in ("hash", "row", "start"))):
        for i in places[row]:  # more than one only where an id has several texts
            if i not in words:
                words[i] = (texts[i] or b"").split()
            phrase = [word_hash(w) for w in words[i][start : start + PHRASE]]
            if len(places[row]) == 1 or (len(phrase) == PHRASE and ngrams(np.array(phrase, np.uint64), PHRASE)[0] == np.uint64(gram & (1 << 64) - 1)):
                key = tuple([number.get(x, -1) for x in phrase])
                if -1 not in key:
                    automaton.add_word(key)
                break
    if not len(automaton):
        return None
    automaton.make_automaton()
    return automaton


def _openings(automaton, numbers: list[int], lens: np.ndarray, width: int) -> np.ndarray:
    """Starts of windows around the occurrences that the automaton locates."""
    possible = np.zeros(len(numbers) + 1, np.int64)
    base = 0
    for n in lens.tolist():
        ends = np.fromiter((e for e, _ in automaton.iter(tuple(numbers[base : base + n]))), np.int64) if n >= width else ()
        if len(ends):
            start = ends - PHRASE + 1 + base
            np.add.at(possible, np.maximum(start - (width - PHRASE), base), 1)
            np.add.at(possible, start + 1, -1)
        base += n
    return np.flatnonzero((np.cumsum(possible[:-1]) > 0) & (room_after(lens) >= width))


def _windows(width: int):
    """Of one bucket: windows that can recur; ``known`` ones come after another of this bucket.

    ``at`` is the start above 32 bits of the row's place; a copy is one known window of start -1.
    """

    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        let_go()
        known = told.filter(pc.is_valid(told.column("hash")))
        docs = docs.combine_chunks()
        orders = docs.column("_order").to_numpy()
        texts = utf8(docs.column("_text").combine_chunks()) if told.num_rows else []
        places = _places(orders[: len(texts)], texts)
        copy = np.array(_is_copy(told, orders[: len(texts)], texts), bool)
        fresh = np.flatnonzero(~copy) if known.num_rows else np.empty(0, np.int64)
        flat, lens = hashed_words([(texts[i] or b"").split() for i in fresh.tolist()])
        different, number = np.unique(flat, return_inverse=True)
        automaton = _automaton(known, docs.column("_row").to_numpy(), texts, dict(zip(different.tolist(), range(len(different))))) if len(flat) else None
        start = _openings(automaton, number.tolist(), lens, width) if automaton else np.empty(0, np.int64)
        ends = np.cumsum(lens)
        text = np.searchsorted(ends, start, "right")
        hashed = ngrams(flat, width)[start] if len(start) else np.empty(0, np.uint64)
        row = fresh[text] if len(start) else np.empty(0, np.int64)
        own, at = orders[row], places[row]
        if len(start):
            at = at | (start - (ends - lens)[text]) << 32
        rank = np.lexsort((at, own, hashed))
        hashed, own, at = hashed[rank], own[rank], at[rank]
        first = np.concatenate([[True], hashed[1:] != hashed[:-1]])[: len(hashed)]
        lead = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
        later = at != at[lead]
        whole = np.unique(places[copy])
        found = {"hash": [hashed.view(np.int64), whole], "order": [np.where(later, 0, own), 0 * whole], "at": [at, whole | -1 << 32], "known": [later, whole >= 0]}
        n = len(later) + len(whole)
        return pa.table({"bucket": np.full(n, docs.column("_bucket")[0].as_py() if docs.num_rows else 0, np.int32)} | {k: np.concatenate(v) for k, v in found.items()})

    return run


def _cut(width: int, names: list[str], as_is: bool):
    """Of one bucket: its rows with what is left of their texts."""

    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        at = told.column("at").to_numpy()
        place, start = at & 0xFFFFFFFF, at >> 32
        rank = np.argsort(place, kind="stable")
        place, start = place[rank], start[rank]
        orders, texts = docs.column("_order").to_numpy(), utf8(docs.column("_text").combine_chunks())
        total, gone, kept = [], [], []
        for own, text in zip(_places(orders, texts).tolist(), texts):
            words = (text or b"").split()
            a, b = np.searchsorted(place, own), np.searchsorted(place, own, "right")
            if a < b and len(words) >= width:
                if start[a:b].min() < 0:
                    left = []
                else:
                    cover = np.zeros(len(words) + 1, np.int64)
                    np.add.at(cover, start[a:b], 1)
                    np.add.at(cover, start[a:b] + width, -1)
                    left = list(compress(words, (np.cumsum(cover[:-1]) == 0).tolist()))
            else:
                left = words
            total.append(len(words))
            gone.append(len(words) - len(left))
            kept.append((text or b"" if as_is and len(left) == len(words) else b" ".join(left)).decode())
        own = [docs.column(x) for x in names]
        return pa.Table.from_arrays([*own, pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], names=[*names, "n_words", "n_removed", "kept_text"])

    return run


def cut_repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", carry: tuple[str, ...] = (), width: int = 20, bucket_rows: int = 400, bucket_bytes: int = 4_000_000, sample_rows: int = 20_000, as_is: bool = False
) -> DataFrame:
    """``id``, ``carry`` columns, n_words, n_removed and kept_text (the kept words joined by one space).

    as_is: a text that loses nothing keeps its white space.
    """
    text_batches(docs.sparkSession)
    total, size = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()
    buckets = max(1, -(-total // bucket_rows), -(-size // bucket_bytes))
    names = [id, *carry]
    dealt = docs.select(*names, F.col(text).alias("_text"), _order(id).alias("_order"), F.coalesce(F.col(id).cast("long"), F.xxhash64(text)).alias("_row"))
    dealt = dealt.withColumn("_bucket", F.pmod(F.xxhash64("_order", "_text"), F.lit(buckets)).cast("int"))
    copies = store(_copies(dealt), "copies")
    phrases = store(_recurring(dealt, total, width, sample_rows), "phrases")

    none = lambda kind: F.lit(None).cast(kind)
    told = phrases.select("bucket", "hash", "row", "start", none("long").alias("order"), none("binary").alias("sha")).union(copies.select("bucket", none("long"), none("long"), none("int"), "order", "sha"))
    # the same exchange of the texts serves both cogroups
    found = dealt.groupBy("_bucket").cogroup(told.groupBy("bucket")).applyInArrow(_windows(width), "bucket int, hash long, order long, at long, known boolean")
    salt = F.when(F.col("known"), F.col("bucket") + 1).otherwise(0)
    own = F.struct("order", "at", "bucket")
    least = F.min(own).over(Window.partitionBy("hash", salt))
    gone = found.withColumn("least", least).filter(F.col("known") | (own != F.col("least"))).select("bucket", "at")
    out = StructType(docs.select(*names).schema.fields + StructType.fromDDL("n_words long, n_removed long, kept_text string").fields)
    return dealt.groupBy("_bucket").cogroup(gone.groupBy("bucket")).applyInArrow(_cut(width, names, as_is), out)
