"""N-gram Jaccard join by parity sketches (operator 4).

A text's set is its distinct word n-grams, as 64-bit fingerprints. Equal sets are one node
(a group of copies, however large, is one node). A sketch is a bit array; every member of
the set flips one bit, so the Hamming distance of two sketches is at most the symmetric
difference of the sets, and two sets that reach the similarity differ in at most
``D = (100 - p) / (100 + p) * (sum of sizes)`` bits.

Pigeonhole: within a band of set sizes the sketch has K = 2 D + 3 blocks, of which K - D at least
agree. Nodes are joined on (band, block, content of the block); a node also enters the next
band if a partner there can reach the similarity. Blocks without a set bit would join
everything: they are left out unless a node has K - D or more of them, so that each pair
keeps a common block with a set bit, or meets in an empty block with its like.

A node with e empty blocks shares K - D - e filled ones with every partner, so in any fixed order of
all keys it can do without its K - D - e - 1 last ones. The order is by frequency: on a sample of
``sample_rows`` rows at once, which leaves D + 1 keys and a reserve, and by the exact counts
for the reserve. Passages that many texts share then hold few buckets together, unless they
make up most of a text. The sample decides the order and the salting only, not the result.

Buckets are resolved without writing out all their pairs: each member is compared with the
strongest lead of its buckets, the node that shares the most blocks; components are formed; only buckets
that still span several components are looked at again, between their components. Small
ones give their pairs directly. The nodes of larger ones form families, which are compared
in chunks of bounded size by bit sketches, without a row per pair; their work is quadratic
in the nodes of a family that do not link with its leads, the rest is not. Sketches are
compared first, and sets are made and sent only for nodes of pairs that pass the Hamming bound, and
of families. No cap, no sampling: every pair that links is found, or lies in one component already.

Edge cases: a null or empty text has an empty set, links with nothing, and is its own
component; a text shorter than n words is one n-gram; copies and repeated rows share a
component; a null id takes part and gets the smallest id of its component (null if there is
none); ids are whole numbers; an empty table gives an empty table; further columns are ignored. Fingerprints of
n-grams and of sets have 64 bits, so two of N different sets coincide with a probability
below N * N / 2**65.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .scratch import drop, release, store, text_batches
from .text import hashed_words, let_go, mix, ngrams, slices, utf8

_SKETCH_WORDS = 64  # of 64 bits, for the Hamming test of a pair
_SALTS = 16
_RESERVE = 16


def sets_of(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Each text's set as a sorted array; A-Z count as a-z."""
    flat, lens = hashed_words([x.lower().split() for x in texts])
    grams = ngrams(flat, n)
    out, at = [], 0
    for k in lens.tolist():
        if k >= n:
            out.append(np.unique(grams[at : at + k - n + 1]))
        elif k:
            out.append(np.array([xxhash.xxh3_64_intdigest(flat[at : at + k].tobytes(), seed=k)], np.uint64))
        else:
            out.append(np.empty(0, np.uint64))
        at += k
    return out


def node_of(members: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(members.tobytes()) - (1 << 63)


@cache
def _bands(percent: int) -> tuple[list[int], list[int], list[int]]:
    """Largest set size, D and number of blocks of each band. Below the first band D is 0: equal sets only."""
    tops, most, blocks = [], [], []
    top = 1
    while 2 * (top + 1) * (100 - percent) < 100 + percent:
        top += 1
    while top < 1 << 40:
        d = 2 * top * (100 - percent) // (100 + percent)
        tops.append(top)
        most.append(d)
        blocks.append(2 * d + 3)
        top = max(top + 1, int(top * 1.4))
    return tops, most, blocks


def _spread(x: np.ndarray) -> np.ndarray:
    return mix(x, np.full(len(x), 0x5851F42D4C957F2D, np.uint64))


def _later(keys: np.ndarray, often: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The keys in the order of their frequency in the sample, then by themselves."""
    known, times = often
    if not len(known):
        return np.sort(keys)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return keys[np.lexsort((keys, np.where(known[at] == keys, times[at], 0)))]


_UNKNOWN = np.empty(0, np.uint64), np.empty(0, np.int64)


def keys_of(members: np.ndarray, percent: int, often: tuple[np.ndarray, np.ndarray] = _UNKNOWN) -> tuple[np.ndarray, np.ndarray]:
    """The join keys of a set: of its blocks with a set bit, in its band and perhaps the next.

    ``often`` has sorted keys and how often a sample holds them. Also each key's ``place``: 0 or
    1 for the band, plus twice the number of its most frequent keys that the node can still do without there.
    """
    most = _bands(percent)[1]
    found, places = [], []
    for place, (band, keys, empty) in enumerate(_blocks(members, percent)):
        spare = max(0, len(keys) - most[band] - 1)  # a partner shares spare + 1 of these keys at least
        reserve = min(spare, 2 + most[band] // _RESERVE)  # left for the exact counts to choose from
        keys = np.concatenate([_later(keys, often)[: len(keys) - spare + reserve], empty])
        found.append(keys)
        places.append(np.full(len(keys), 2 * reserve + place, np.int32))
    return (np.concatenate(found), np.concatenate(places)) if found else (np.empty(0, np.uint64), np.empty(0, np.int32))


def _blocks(members: np.ndarray, percent: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(band, keys of the blocks with a set bit, keys of the empty blocks where these are needed) of a set."""
    tops, most, blocks = _bands(percent)
    n = len(members)
    if not n:
        return
    high, bits = members >> np.uint64(32), _spread(members & np.uint64(0xFFFFFFFF))
    own = int(np.searchsorted(tops, n))
    for band in (own, own + 1):
        if not most[band] or (band > own and 100 * n // percent <= tops[own]):
            continue
        k = blocks[band]
        block = (high * np.uint64(k)) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        content, block = np.bitwise_xor.reduceat(bits, first), block[first]
        tag = np.uint64(band << 32)
        filled = content != 0
        keys, empty = mix(content[filled], block[filled] + tag), np.empty(0, np.uint64)
        if k - len(keys) >= k - most[band]:
            empty = np.setdiff1d(np.arange(k, dtype=np.uint64), block[filled])
            empty = mix(np.full(len(empty), 0xE, np.uint64), empty + tag)
        yield band, keys, empty


def sketch_of(members: np.ndarray) -> np.ndarray:
    """The parity of the members' hashes in ``_SKETCH_WORDS`` words of 64 bits."""
    bit = (members * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(52)
    odd = np.bincount(bit.astype(np.int64), minlength=64 * _SKETCH_WORDS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _over_sets(docs: DataFrame, n: int, make, schema: str, once: bool = False) -> DataFrame:
    """``make(ids, nodes, sets, *more)`` -> columns, over docs (id, text, more columns). once: a node that this task had lately comes no more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        seen = set()
        for whole in batches:
            for batch in slices(whole, "text", 1_000_000):
                sets = sets_of([x or b"" for x in utf8(batch.column(1))], n)
                nodes = [node_of(s) if len(s) else None for s in sets]
                fresh = range(len(sets))
                if once:
                    fresh = [i for i, x in enumerate(nodes) if x is not None and not (x in seen or seen.add(x))]
                    if len(seen) > 200_000:
                        seen.clear()
                ids, *more = [c.to_pylist() for i, c in enumerate(batch.columns) if i != 1]
                yield from make([ids[i] for i in fresh], [nodes[i] for i in fresh], [sets[i] for i in fresh], *[[x[i] for i in fresh] for x in more])

    return docs.mapInArrow(run, schema)


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def links_and_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """(id, n_shingles, component_id) of each row; component_id is the smallest id of its component."""
    given = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    return _groups(given, **how).select(F.col("id").alias(id), "n_shingles", "component_id")


def _groups(given: DataFrame, n: int = 5, percent: int = 80, small: int = 12, family_members: int = 2_000_000, sample_rows: int = 20_000) -> DataFrame:
    """(id, n_shingles, hash, component_id, component) of given (id, text, perhaps a hash of each row); component is a node, null for an empty set."""
    text_batches(given.sparkSession)
    docs, hashed = given.select("id", "text"), [c for c in given.columns if c == "hash"]

    def base(ids, nodes, sets, *hashes):
        last: set[int] = set()  # a node that this batch has twice needs one sketch
        sketches = [sketch_of(s) if x is not None and not (x in last or last.add(x)) else None for x, s in zip(nodes, sets)]
        yield _batch(id=pa.array(ids, pa.int64()), n_shingles=pa.array(map(len, sets), pa.int64()), node=pa.array(nodes, pa.int64()), **{c: pa.array(x, pa.int64()) for c, x in zip(hashed, hashes)}, sketch=pa.array(sketches, pa.list_(pa.int64())))

    whole = store(_over_sets(given, n, base, ", ".join(f"{c} long" for c in ("id", "n_shingles", "node", *hashed)) + ", sketch array<long>"), "sets-base")
    rows = whole.drop("sketch")
    first = rows.filter("node is not null").groupBy("node").agg(F.min("id").alias("first_id"))
    members = store(_members(docs, rows.count(), n, percent, sample_rows), "bucket-members")
    release(docs.sparkSession)
    plain, members = members, store(_needed(members), "needed-members")
    drop(plain)
    plain, members = members, store(_led(members), "led-members")
    drop(plain)

    nodes = store(members.select("node").distinct(), "nodes")
    known = _semi(whole.filter("sketch is not null"), nodes, "node").select("node", F.col("n_shingles").alias("n"), "sketch")
    sketches = store(known.dropDuplicates(["node"]), "sketches")

    def full(ids, nodes, sets):
        for i in range(0, len(sets), 200):
            part = sets[i : i + 200]
            yield _batch(node=pa.array(nodes[i : i + 200], pa.int64()), members=pa.array([s.view(np.int64) for s in part], pa.list_(pa.int64())))

    def sets_for(wanted: DataFrame) -> DataFrame:
        wanted = store(wanted.distinct(), "wanted-nodes")
        ids = store(rows.join(wanted, "node").groupBy("node").agg(F.min("id").alias("id")), "wanted-ids")
        texts = _semi(docs, ids.filter("id is not null").select("id").distinct(), "id").unionByName(docs.filter("id is null"))
        return store(_semi(_over_sets(texts, n, full, "node long, members array<long>", once=True), wanted, "node").dropDuplicates(["node"]), "sets")

    # most links show against the strongest lead; what these join needs no further test
    tested = store(_first(members), "star")
    near = store(_near(tested, sketches, percent), "near-star")
    sets = sets_for(_ends(near))
    links = store(_linked(near, sets, percent), "links-star")
    drop(near, sets)
    comp = store(components(links), "components")
    open_ = store(_open(members, comp), "open")
    drop(members)
    near = store(_near(_between(open_.filter(F.col("size") <= small), tested, percent), sketches, percent), "near-between")
    drop(sketches)
    families = store(_families(open_.filter(F.col("size") > small)), "families")
    drop(open_)
    if not (near.isEmpty() and families.isEmpty()):
        sets = sets_for(_ends(near).union(families.select("node")))
        again = store(_linked(near, sets, percent).union(_within(families, sets, percent, family_members)), "links-between")
        drop(near, families, sets)
        if not again.isEmpty():
            comp = store(components(links.union(again)), "components")

    named = first.join(comp, "node").groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = comp.join(named, "component").select("node", "component", F.col("component_id").alias("joined"))
    known = first.join(named, "node", "left").select("node", F.coalesce("joined", "first_id").alias("component_id"), F.coalesce("component", "node").alias("component"))
    done = rows.filter("node is not null").join(known, "node").select("id", "n_shingles", *hashed, "component_id", "component")
    alone = rows.filter("node is null").select("id", "n_shingles", *hashed, F.col("id").alias("component_id"), F.lit(None).cast("long").alias("component"))
    return done.unionByName(alone)


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """One row of each component: the smallest id, a null id last, then the least hash of the text.

    A text with an empty set is its own component; of rows with equal id and text one stays.
    """
    # the row travels as one column, so no name of its own can clash
    hashed = docs.select(F.struct(*docs.columns).alias("row"), F.col(id).cast("long").alias("id"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))
    groups = store(_groups(hashed.select("id", "text", "hash"), **how), "groups")
    least = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "hash")).alias("least")
    stay = groups.filter("component is not null").groupBy("component").agg(least).select("least.id", "least.hash")
    stay = store(stay.union(groups.filter("component is null").select("id", "hash")).distinct().toDF("stay_id", "stay_hash"), "stay")
    kept = hashed.drop("text").join(stay, F.col("id").eqNullSafe(F.col("stay_id")) & (F.col("hash") == F.col("stay_hash")), "left_semi")
    repeated = groups.groupBy("id", "hash").count().filter("count > 1")
    return (kept if repeated.isEmpty() else kept.dropDuplicates(["id", "hash"])).select("row.*")


def _semi(rows: DataFrame, ids: DataFrame, on: str, broadcast_rows: int = 1_000_000) -> DataFrame:
    """The rows with a value in ids; by broadcast up to ``broadcast_rows`` ids (8 MB), else by a shuffle."""
    side = F.broadcast(ids) if ids.count() <= broadcast_rows else ids
    return rows.join(side, on, "left_semi")


_KEYS = "key long, node long, n int, salt int, place int"


def _members(docs: DataFrame, total: int, n: int, percent: int, sample_rows: int, ordered_keys: int = 500_000) -> DataFrame:
    """(key, salt, node, n): the nodes of each bucket with two nodes or more."""

    def keyed(often, heavy):
        def make(ids, nodes, sets):
            known = (often.value if often is not None else _UNKNOWN,)
            keys, places = zip(*[keys_of(s, percent, *known) for s in sets]) if sets else ((), ())
            lens = list(map(len, keys))
            if not sum(lens):
                return
            key = np.concatenate(keys).view(np.int64)
            node = np.repeat(np.array(nodes, np.int64), lens)
            salt = np.zeros(len(key), np.int32)
            if heavy is not None and len(heavy.value):
                at = np.minimum(np.searchsorted(heavy.value, key), len(heavy.value) - 1)
                salt = np.where(heavy.value[at] == key, 1 + (node % _SALTS), 0).astype(np.int32)
            size, place = np.repeat(np.array(list(map(len, sets)), np.int32), lens), np.concatenate(places)
            for i in range(0, len(key), 100_000):
                yield _batch(key=key[i : i + 100_000], node=node[i : i + 100_000], n=size[i : i + 100_000], salt=salt[i : i + 100_000], place=place[i : i + 100_000])

        return make

    def every_key(ids, nodes, sets):
        keys = [keys for s in sets for _, keys, _ in _blocks(s, percent)]
        key = np.concatenate(keys).view(np.int64) if keys else np.empty(0, np.int64)
        for i in range(0, len(key), 100_000):
            yield _batch(key=key[i : i + 100_000])

    every = max(1, -(-total // sample_rows))
    sample = docs.filter(F.pmod(F.xxhash64("id", "text", F.lit("heavy")), F.lit(every)) == 0)
    least = max(50, sample_rows // 200)
    counted = _over_sets(sample, n, every_key, "key long", once=True).groupBy("key").count().filter(F.col("count") > 1)
    # only the order of keys hangs on these, so the most frequent ones will do
    found = counted.orderBy(F.desc("count"), "key").limit(ordered_keys).toArrow()
    key, times = found.column("key").to_numpy().view(np.uint64), found.column("count").to_numpy()
    rank = np.argsort(key)
    context = docs.sparkSession.sparkContext
    often = context.broadcast((key[rank], times[rank].astype(np.int32)))
    heavy = context.broadcast(np.sort(key[times >= least].view(np.int64)))
    keys = _over_sets(docs, n, keyed(often, heavy), _KEYS, once=True)
    bucket = Window.partitionBy("key", "salt")
    spans = keys.withColumns({"low": F.min("node").over(bucket), "high": F.max("node").over(bucket)})
    return spans.filter("salt > 0 or low < high").select("key", "salt", "node", "n", "place").distinct()


def _needed(members: DataFrame) -> DataFrame:
    """members without the most frequent keys of each node and band that no pair needs.

    In the order of frequency, the rarest of a linked pair's s + 1 common keys has s of them
    above it on both sides, so each side may leave out its last s and the pair still meets.
    """
    often = members.groupBy("key").agg(F.count(F.lit(1)).alias("often"))
    last = Window.partitionBy("node", "place").orderBy(F.desc("often"), F.desc("key"))
    ranked = members.join(often, "key").withColumn("last", F.row_number().over(last))
    return ranked.filter(F.col("last") > F.floor(F.col("place") / 2)).select("key", "salt", "node", "n").distinct()


def _led(members: DataFrame) -> DataFrame:
    """members with ``lead``: the bucket's node that shares the most blocks with others, the likely centre."""
    support = members.groupBy("node").agg(F.count(F.lit(1)).alias("support"))
    lead = F.max(F.struct("support", "node")).over(Window.partitionBy("key", "salt"))
    led = members.join(support, "node").withColumn("_lead", lead)
    return led.select("key", "salt", "node", "n", F.col("_lead.node").alias("lead"), F.col("_lead.support").alias("lead_support"))


def _first(members: DataFrame) -> DataFrame:
    """One pair (a, b) for each node: with the strongest lead of all its buckets."""
    best = members.groupBy("node").agg(F.max(F.struct("lead_support", "lead"))["lead"].alias("lead")).filter("node != lead")
    return best.select(F.least("lead", "node").alias("a"), F.greatest("lead", "node").alias("b")).distinct()


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select("b"))


def _near(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sizes and sketches allow the similarity."""

    def end(x: str) -> DataFrame:
        return sketches.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}"))

    total = F.col("n_a") + F.col("n_b")
    apart = F.aggregate(F.zip_with("sketch_a", "sketch_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    light = pairs.join(end("a"), "a").join(end("b"), "b").filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    return light.filter((100 - percent) * total >= (100 + percent) * apart).select("a", "b")


def _linked(near: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that reach the similarity, by their exact intersections."""
    both = near.join(sets.select(F.col("node").alias("a"), F.col("members").alias("members_a")), "a")
    both = both.join(sets.select(F.col("node").alias("b"), F.col("members").alias("members_b")), "b")
    common, total = F.size(F.array_intersect("members_a", "members_b")), F.size("members_a") + F.size("members_b")
    return both.filter((100 + percent) * common >= percent * total).select("a", "b")


def _open(members: DataFrame, comp: DataFrame) -> DataFrame:
    """The members of buckets that lie in several components, with these and the bucket's size."""
    own = members.join(comp, "node", "left").select("key", "node", "n", "lead", F.coalesce("component", "node").alias("component"))
    spread = own.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("size"), F.max(F.when(F.col("node") == F.col("lead"), F.col("component"))).alias("centre"))
    return own.drop("lead").join(spread.filter("low != high").select("key", "size", "centre"), "key")


def _between(small: DataFrame, tested: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes that share a small bucket, lie in different components and were not tested."""
    other = small.select("key", F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("component").alias("component_b"))
    pairs = small.join(other, "key").filter("component < component_b").filter(100 * F.least("n", "n_b") >= percent * F.greatest("n", "n_b"))
    pairs = pairs.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct()
    return pairs.join(tested, ["a", "b"], "left_anti")


def _families(large: DataFrame) -> DataFrame:
    """(node, n, component, family) of the nodes of large buckets; components that large buckets hold together are a family."""
    edges = large.filter("component != centre").select(F.col("component").alias("a"), F.col("centre").alias("b"))
    family = components(edges).toDF("component", "family")
    return family.join(large.select("node", "n", "component").distinct(), "component")


def _within(nodes: DataFrame, sets: DataFrame, percent: int, most: int) -> DataFrame:
    """Links between components within the families.

    A family is cut into chunks of about ``most`` set members, and each pair of chunks is one
    task, which compares bit sketches and intersects what these leave; pairs in one component are passed over.
    """
    chunks = nodes.groupBy("family").agg(F.ceil(F.sum("n") / most).cast("int").alias("chunks"))
    placed = nodes.join(chunks, "family").withColumn("own", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    placed = placed.join(sets.select("node", "members"), "node")
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    task = [F.col("family"), F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two")]
    return placed.select(*task, "own", "node", "component", "members").groupBy("family", "one", "two").applyInArrow(_compare(percent), "a long, b long")


def _compare(percent: int):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        members = rows.column("members").combine_chunks()
        flat, ends = members.values.to_numpy().view(np.uint64), members.offsets.to_numpy()
        size = np.diff(ends)
        order = np.lexsort((rows.column("node").to_numpy(), size))
        node, own, size = rows.column("node").to_numpy()[order], rows.column("own").to_numpy()[order], size[order]
        _, component = np.unique(rows.column("component").to_numpy()[order], return_inverse=True)
        sets = [flat[ends[i] : ends[i + 1]] for i in order]
        sketch = np.stack([sketch_of(s) for s in sets])
        both = rows.column("one")[0].as_py() == rows.column("two")[0].as_py()
        found = []
        for i in range(len(sets)):
            end = int(np.searchsorted(size, 100 * size[i] // percent, "right"))
            if end <= i + 1:
                continue
            near = np.arange(i + 1, end)
            near = near[(component[near] != component[i]) & (both | (own[near] != own[i]))]
            apart = np.bitwise_count(sketch[near] ^ sketch[i]).sum(1, dtype=np.int64)
            near = near[(100 - percent) * (size[near] + size[i]) >= (100 + percent) * apart]
            for j in near.tolist():
                if component[i] == component[j]:
                    continue
                common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if (100 + percent) * common >= percent * (size[i] + size[j]):
                    found.append((node[i], node[j]))
                    component[component == component[j]] = component[i]
        ends = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"a": ends[:, 0], "b": ends[:, 1]})

    return run
