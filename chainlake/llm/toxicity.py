"""Toxicity by class-conditional Kneser-Ney models over characters (operator 9).

A word is a run of letters, lower-cased, with start marks before it and an end mark after
it. Two models of order 6, one from toxic and one from ordinary texts, give each character
a probability by interpolated Kneser-Ney smoothing. Each class has its own counts at the
highest order, less a discount; what the discount frees goes to a shared model of both
classes' counts, which backs off to pooled continuation counts. So a rare expression is
told apart only where the classes really saw something different.

A toxic text is mostly ordinary words, so its likelihood per word is that of a mixture in
which the toxic model has a share. A text's evidence is the log-likelihood ratio of this
mixture to the ordinary model, normalised by the text's length, and by the root of it. A
logistic regression on these, fitted on labelled texts that the models did not see, turns
them into a score; the classes' discount is chosen by its loss.

The models are fitted on at most ``fit_rows`` labelled rows (a third of them toxic), chosen
by a hash of the id; everything else runs over all rows. The model is a table of at most
the n-grams of that sample and goes to the executors by broadcast.

Edge cases: a null or empty text, or one without letters, has no evidence and gets the
score of zero evidence, below one half; repeated rows get equal scores; labels that are
null are left out, a row labelled twice counts as toxic if either says so; without labels
of both classes every score is the smoothed share of toxic labels; an empty table gives an
empty table; further columns, lang and source among them, are never looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import store, text_batches
from .text import ngrams, slices

ORDER, DISCOUNT = 6, 0.75
#: Shares of toxic words in a toxic text, for the evidence.
SHARES = (0.25, 0.1)
#: Tried for the classes; the one with the least loss on the calibrating rows is used.
DISCOUNTS = (2.0, 5.0)
_WORD = re.compile(r"[^\W\d_]+")


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words with marks in one array of code points; the positions to predict; each one's word."""
    pad = "\x02" * (ORDER - 1)
    joined = "".join([f"{pad}{w}\x03" for w in words])
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.uint64)
    lens = np.fromiter(map(len, words), np.int64, len(words)) + 1
    first = np.cumsum(lens + ORDER - 1) - lens
    word = np.repeat(np.arange(len(words)), lens)
    at = np.arange(int(lens.sum())) - np.repeat(np.cumsum(lens) - lens, lens) + first[word]
    return codes, at, word


def _grams(codes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints of the n characters that end at each position."""
    return ngrams(codes, n)[at - n + 1]


@dataclass
class Model:
    """Log ratios of n-grams seen in either class, and of contexts for all other characters."""

    grams: np.ndarray
    gram_ratio: np.ndarray
    contexts: np.ndarray
    context_ratio: np.ndarray

    def words(self, words: list[str]) -> np.ndarray:
        """Each word's log-likelihood ratio, toxic to ordinary."""
        if not words:
            return np.empty(0)
        codes, at, word = _codes(words)
        gram, context = _grams(codes, at, ORDER), _grams(codes, at - 1, ORDER - 1)
        g, c = (np.minimum(np.searchsorted(t, x), len(t) - 1) for t, x in ((self.grams, gram), (self.contexts, context)))
        ratio = np.where(self.grams[g] == gram, self.gram_ratio[g], np.where(self.contexts[c] == context, self.context_ratio[c], 0.0))
        return np.bincount(word, ratio, len(words))


def fit_model(words: list[str], toxic: np.ndarray, ordinary: np.ndarray, discount: float) -> Model:
    """From word types and how often each class has them.

    Each class takes ``discount`` off its counts of an n-gram and gives the mass to the
    shared model of the same order, which has the counts of both.
    """
    codes, at, word = _codes(words)
    top, first, inverse = np.unique(_grams(codes, at, ORDER), return_index=True, return_inverse=True)
    contexts, of = np.unique(_grams(codes, at[first] - 1, ORDER - 1), return_inverse=True)
    both, rest = _smoothed(np.bincount(inverse, (toxic + ordinary)[word], len(top)), of, DISCOUNT)
    shared = both + rest[of] * _continuation(codes, at[first])
    log_p, log_rest = [], []
    for counts in (toxic, ordinary):
        own, rest = _smoothed(np.bincount(inverse, counts[word], len(top)), of, discount)
        log_p.append(np.log(own + rest[of] * shared))
        log_rest.append(np.log(rest))
    return Model(top, (log_p[0] - log_p[1]).astype(np.float32), contexts, (log_rest[0] - log_rest[1]).astype(np.float32))


def _smoothed(n: np.ndarray, of: np.ndarray, discount: float) -> tuple[np.ndarray, np.ndarray]:
    """Discounted relative frequencies, and each context's mass for the next model."""
    total, taken = np.bincount(of, n), np.bincount(of, np.minimum(n, discount))
    return np.maximum(n - discount, 0) / np.maximum(total, 1)[of], np.where(total > 0, taken / np.maximum(total, 1), 1.0)


def _continuation(codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Kneser-Ney probability of the character at each position (of distinct n-grams) from one order below."""
    levels = []
    here = at
    for n in range(ORDER - 1, 0, -1):
        grams, first, inverse, count = np.unique(_grams(codes, here, n), return_index=True, return_inverse=True, return_counts=True)
        levels.append((here, first, inverse, count, n))
        here = here[first]
    p = None
    for here, first, inverse, count, n in reversed(levels):
        if n == 1:
            own = count / count.sum()
        else:
            _, of = np.unique(_grams(codes, here[first] - 1, n - 1), return_inverse=True)
            total, kinds = np.bincount(of, count), np.bincount(of)
            own = np.maximum(count - DISCOUNT, 0) / total[of] + (DISCOUNT * kinds / total)[of] * p
        p = own[inverse]
    return p


class _Evidence:
    """Per-word ratios of whole texts, remembered up to ``limit`` word types."""

    def __init__(self, model: Model, limit: int = 300_000):
        self.model, self.limit, self.known = model, limit, {}

    def texts(self, texts: list[str]) -> np.ndarray:
        """(ratio per word for each of ``SHARES``, and for the first per square root of words) of each text."""
        parts = [_WORD.findall(t.lower()) for t in texts]
        new = list({w for p in parts for w in p} - self.known.keys())
        if len(self.known) + len(new) > self.limit:
            self.known.clear()
            new = list({w for p in parts for w in p})
        self.known.update(zip(new, self.model.words(new).tolist()))
        out = np.zeros((len(texts), 3))
        for i, p in enumerate(parts):
            if p:
                words = np.fromiter(map(self.known.__getitem__, p), np.float64, len(p))
                sums = [np.log1p(e * np.expm1(np.minimum(words, 50))).sum() for e in SHARES]
                out[i] = sums[0] / len(p), sums[1] / len(p), sums[0] / len(p) ** 0.5
        return out


EVIDENCE = "key {}, mean double, sharp double, root double"


def _evidence(sent, carry: tuple[str, ...] = ()):
    """Over (key, text, carried columns)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Evidence(sent.value)
        for whole in batches:
            for batch in slices(whole, "text"):
                x = known.texts([t or "" for t in batch.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, x.T.copy()), *map(batch.column, carry)], names=["key", "mean", "sharp", "root", *carry])

    return run


def _logistic(x: np.ndarray, y: np.ndarray, toxic_weight: float = 3.0, ridge: float = 0.1, rounds: int = 50) -> tuple[np.ndarray, float]:
    """(weights and intercept, mean log loss) by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    weight = np.where(y == 1, toxic_weight, 1.0)
    penalty = ridge * np.diag([1.0] * (len(w) - 1) + [1e-3])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (weight * p * (1 - p))) @ x + penalty, x.T @ (weight * (p - y)) + penalty @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    p = np.clip(1 / (1 + np.exp(-np.clip(x @ w, -30, 30))), 1e-6, 1 - 1e-6)
    return w, float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())


def held_out(id: str):
    """Rows that no label may be learnt from."""
    return F.pmod(F.crc32(F.col(id).cast("string").cast("binary")), F.lit(5)) == 0


def score(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic", fit_rows: int = 12_000) -> DataFrame:
    """(id, held_out, score, predicted) of each row of docs."""
    text_batches(docs.sparkSession)
    usable = labels.filter(F.col(label).isNotNull() & F.col(id).isNotNull() & ~held_out(id)).groupBy(id).agg(F.max(label).cast("int").alias("y"))
    draw = F.xxhash64(id, F.lit("fit"))
    chosen = usable.filter("y = 1").orderBy(draw, id).limit(fit_rows // 3).union(usable.filter("y = 0").orderBy(draw, id).limit(fit_rows - fit_rows // 3))
    # a quarter of the labelled rows calibrates, the others make the models
    sample = docs.select(id, text).join(F.broadcast(chosen), id).withColumn("part", (F.pmod(F.xxhash64(id, F.lit("part")), F.lit(4)) == 0).cast("int"))
    sample = store(sample.select(F.coalesce(text, F.lit("")).alias("text"), "y", "part"), "labelled")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, y in zip(batch.column(0), batch.column(1).to_pylist()):
                words = _WORD.findall(t.as_py().lower())
                yield pa.RecordBatch.from_pydict({"word": pa.array(words, pa.string()), "y": pa.array([y] * len(words), pa.int32())})

    types = sample.filter("part = 0").select("text", "y").mapInArrow(counted, "word string, y int")
    types = types.groupBy("word").agg(F.sum("y").alias("toxic"), F.sum(1 - F.col("y")).alias("ordinary")).toArrow()
    toxic, ordinary = (types.column(c).to_numpy().astype(np.float64) for c in ("toxic", "ordinary"))
    order = np.argsort(words := np.array(types.column("word").to_pylist(), object)) if types.num_rows else []
    seen = {r[0]: r[1] for r in sample.groupBy("y").count().collect()}
    if not (toxic.sum() and ordinary.sum() and len(seen) == 2):
        share = (seen.get(1, 0) + 0.5) / (sum(seen.values()) + 1.0) if seen else 0.0
        return docs.select(id, F.coalesce(held_out(id), F.lit(False)).alias("held_out"), F.lit(share).alias("score"), F.lit(int(share >= 0.5)).alias("predicted"))
    best = None
    for discount in DISCOUNTS:
        model = fit_model(words[order].tolist(), toxic[order], ordinary[order], discount)
        sent = docs.sparkSession.sparkContext.broadcast(model)
        fit = sample.select(F.col("y").alias("key"), "text", "part").mapInArrow(_evidence(sent, ("part",)), EVIDENCE.format("int") + ", part int").toPandas()
        fit = fit[fit["part"] == 1] if fit[fit["part"] == 1]["key"].nunique() == 2 else fit
        w, loss = _logistic(fit[["mean", "sharp", "root"]].to_numpy(), fit["key"].to_numpy())
        if best is None or loss < best[0]:
            best = loss, sent, w
    _, sent, w = best
    kind = dict(docs.select(id).dtypes)[id]
    rows = docs.select(F.col(id).alias("key"), F.col(text).alias("text")).mapInArrow(_evidence(sent), EVIDENCE.format(kind))
    z = F.col("mean") * float(w[0]) + F.col("sharp") * float(w[1]) + F.col("root") * float(w[2]) + float(w[3])
    scored = rows.select(F.col("key").alias(id), (1 / (1 + F.exp(-z))).alias("score"))
    return scored.select(id, F.coalesce(held_out(id), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
