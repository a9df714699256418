"""License scans by MinHash over overlapping windows (operator 8), with DataFrame functions only.

Texts are lower-cased and cut to words of letters and digits; shingles are three words.
Templates are put in length classes. A text has windows of one and a half class lengths at
every half class length, so each occurrence of a template lies whole in some window and has
a Jaccard similarity of about a third or more with it, less what edits take. Each of
``BANDS`` hash functions is a band of one row: two sets of similarity J share a band's
minimum with probability J, so a template that a window contains is retrieved with
probability 1 - (1 - J) ** BANDS, 0.999 at J = 1/4. The exact share of the template's
shingles in the window then decides (``containment`` or more).

Two steps keep the work small without losing a match. A template's marker words are chosen
so that a text without any of them lacks too many of its shingles; texts that have no
marker of any template are passed over after a substring test. Long texts are cut into
segments of at least twice the longest window that overlap by it, so memory is bounded for
any length of a text, and a template may have any length.

Nothing is gathered by license or by band value: minima are grouped by window, after a
combine in each task, and templates join by broadcast, so a notice that a third of all
texts carry costs no more than its rows.

Edge cases: a null or empty text matches nothing; a text may match several templates, once
each, at its first best window; repeated rows with one id and text are one answer; a null id
is kept; an empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .license_texts import TEMPLATES
from .scratch import store

SHINGLE, BANDS = 3, 24
_SENT_SHINGLES = 1_000_000  # of all templates together, up to which they go by broadcast (8 MB)
WORDS = r"[\p{L}\p{N}]+"


def _words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


#: Words too common to mark a notice.
_COMMON = frozenset("a an and any are as at be by for from in is it may must not of on or other that the these this to under used was which with you your".split())


def markers(text: str, containment: float) -> list[str]:
    """As few words as a greedy choice needs, such that a text without them holds under ``containment`` of the shingles."""
    words = _words(text)
    left = {tuple(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))}
    least = containment * len(left)
    chosen: list[str] = []
    while len(left) >= least:
        held = Counter(w for s in left for w in set(s))
        able = set(held)
        able = able - _COMMON or able
        enough = [w for w in able if len(left) - held[w] < least]
        chosen.append(min(enough, key=lambda w: (-len(w), w)) if enough else min(able, key=lambda w: (-held[w], -len(w), w)))
        left = {s for s in left if chosen[-1] not in s}
    return chosen


def length_class(n_words: int) -> int:
    return max(8, 1 << (n_words - 1).bit_length())


def _shingles(words: Column) -> Column:
    n = F.size(words)
    return F.when(n >= SHINGLE, F.transform(F.sequence(F.lit(1), n - (SHINGLE - 1)), lambda i: F.xxhash64(*[F.get(words, i + (k - 1)) for k in range(SHINGLE)]))).otherwise(F.array().cast("array<bigint>"))


def _band_hashes(shingles: Column) -> list[Column]:
    def seeded(band: int) -> Column:
        return F.transform(shingles, lambda h: F.xxhash64(h, F.lit(band)))

    return [seeded(b) for b in range(BANDS)]


def _templates(spark, templates: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(template, class, band, value) with a row per template and band, and (template, template_words, wanted) with its shingles."""
    rows = [(name, length_class(len(_words(text))), _words(text)) for name, text in sorted(templates.items())]
    table = spark.createDataFrame(rows, "template string, class int, words array<string>")
    table = table.select("template", "class", F.size("words").alias("template_words"), F.array_distinct(_shingles(F.col("words"))).alias("wanted"))
    mins = F.array(*[F.array_min(x) for x in _band_hashes(F.col("wanted"))])
    bands, whole = table.select("template", "class", F.posexplode(mins).alias("band", "value")), table.select("template", "template_words", "wanted")
    small = sum(len(words) for *_, words in rows) <= _SENT_SHINGLES and BANDS * len(rows) <= _SENT_SHINGLES
    return (F.broadcast(bands), F.broadcast(whole)) if small else (bands, whole)


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text", templates: dict[str, str] | None = None, containment: float = 0.8) -> DataFrame:
    """(id, template, containment, start_word, template_words): the templates that each text holds, with the best window."""
    templates = TEMPLATES if templates is None else templates
    known, whole = _templates(docs.sparkSession, templates)
    classes = sorted({length_class(len(_words(t))) for t in templates.values()})
    longest = classes[-1] * 3 // 2
    segment = max(512, 2 * longest)  # words of a text in one row

    lower = F.lower(F.col(text))
    found = sorted({m for t in templates.values() for m in markers(t, containment)})
    marked = F.lit(False)
    for word in found:
        marked = marked | (lower.contains(word) if len(word) > 4 else lower.rlike(rf"\b{word}\b"))
    rows = docs.filter(marked).select(F.col(id).alias("id"), F.xxhash64(id, text).alias("key"), F.regexp_extract_all(lower, F.lit(f"({WORDS})"), F.lit(1)).alias("words"))

    step = segment - longest
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - longest - 1, F.lit(0)), F.lit(step))
    parts = rows.select("id", "key", "words", F.explode(starts).alias("at")).filter(F.size("words") >= SHINGLE)
    # each array is a column of its own before a lambda reads it: an expression would be computed once an element
    parts = parts.select("id", "key", "at", F.slice("words", F.col("at") + 1, F.lit(segment)).alias("words"))
    parts = store(parts.select("id", "key", "at", _shingles(F.col("words")).alias("shingles")), "marked-parts")

    # each shingle with the (up to three) windows of each class that hold it, then each window's least hashes
    kinds = F.array(*[F.struct(F.lit(c).alias("class"), F.lit(c * 3 // 2 - (SHINGLE - 1)).alias("width"), F.lit(c // 2).alias("hop")) for c in classes])
    single = parts.select("key", "at", F.posexplode("shingles").alias("pos", "shingle"))
    spread = single.select("*", F.explode(kinds).alias("kind")).select("*", F.explode(F.array(*map(F.lit, range(3)))).alias("back"))
    begin = (F.expr("pos div kind.hop") - F.col("back")) * F.col("kind.hop")
    spread = spread.select("key", "at", "shingle", F.col("kind.class").alias("class"), F.col("kind.width").alias("width"), begin.cast("int").alias("begin"), "pos")
    spread = spread.filter((F.col("begin") >= 0) & (F.col("pos") < F.col("begin") + F.col("width")))
    windows = spread.groupBy("key", "at", "class", "width", "begin").agg(*[F.min(F.xxhash64("shingle", F.lit(b))).alias(f"b{b}") for b in range(BANDS)])
    banded = windows.select("key", "at", "class", "width", "begin", F.posexplode(F.array(*[f"b{b}" for b in range(BANDS)])).alias("band", "value"))
    joined = banded.join(known, ["class", "band", "value"]).select("key", "at", "width", "begin", "template").distinct()
    joined = joined.join(whole, "template").join(parts, ["key", "at"]).withColumn("own", F.slice("shingles", F.col("begin") + 1, F.col("width"))).withColumn("start_word", F.col("at") + F.col("begin"))
    share = F.size(F.array_intersect("wanted", "own")) / F.size("wanted")
    good = joined.select("id", "key", "template", "template_words", "start_word", share.alias("containment")).filter(F.col("containment") >= containment)
    best = F.min(F.struct((-F.col("containment")).alias("less"), "start_word")).alias("best")
    return good.groupBy("id", "key", "template", "template_words").agg(best).select(
        F.col("id").alias(id), "template", (-F.col("best.less")).alias("containment"), F.col("best.start_word").cast("long").alias("start_word"), F.col("template_words").cast("long").alias("template_words")
    )
