"""Quality rules as a short-circuit cascade (operator 3).

Base counts are made for every text. The further rules form a cascade: their cost and
rejection rate are measured on a sample (about ``sample_rows`` rows, of which those count that
pass the base check, as in the cascade), and they run in the order of rejection per second, each
only on the texts that all earlier ones passed.
The verdict is "no rule rejects", so the order can change the time but never a result.

Edge cases: a null text counts as a text without words; a text of fewer than ``min_words``
words fails the base check; repeated rows get equal answers; a very long text is looked
at whole and makes a slice of its own; an empty table gives an empty table; input columns
other than the named ones are not looked at.
"""

from __future__ import annotations

import time
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from .scratch import text_batches
from .text import hashed_words, let_go, mix, ngrams, room_after, slices, utf8

_SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\r\x0b\x0c"
_NOT_COUNTED = _SPACES + bytes(range(0x80, 0xC0))  # white space and UTF-8 continuation bytes


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each code point: is it a letter, an upper-case letter, white space."""
    kinds = [unicodedata.category(chr(c)) for c in range(0x110000)]
    letter = np.array([k[0] == "L" for k in kinds])
    upper = np.array([k == "Lu" for k in kinds])
    space = np.zeros(0x110000, bool)
    space[list(_SPACES)] = True
    return letter, upper, space


@dataclass
class Text:
    """One text with its base counts; what rules need beyond these is made on first use."""

    raw: bytes
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_lines: int

    @cached_property
    def points(self) -> np.ndarray:
        return np.frombuffer(self.raw.decode().encode("utf-32-le"), np.uint32)

    @cached_property
    def letters(self) -> np.ndarray:
        return _tables()[0][self.points]


@dataclass(frozen=True)
class Rule:
    """``rejects`` looks at one text; it must depend on nothing else."""

    name: str
    rejects: Callable[[Text], bool] = field(compare=False)


def _symbols(t: Text) -> bool:
    return 10 * t.n_symbols > t.n_words


def _word_length(t: Text) -> bool:
    return not 2 * t.n_words <= t.word_chars <= 14 * t.n_words


def _same_lines(t: Text) -> bool:
    return 2 * t.n_dup_lines > t.n_lines


def _capitals(t: Text) -> bool:
    return 2 * int(_tables()[1][t.points].sum()) > int(t.letters.sum())


def _letterless(t: Text) -> bool:
    word = np.cumsum(_tables()[2][t.points])[t.letters]
    with_letters = int((np.diff(word) > 0).sum()) + 1 if len(word) else 0
    return 4 * with_letters < 3 * t.n_words


#: More symbols than a tenth of the words; mean word length outside 2 to 14; over half of the
#: lines repeated; over half of the letters capital; under three quarters of the words with a letter.
RULES = (
    Rule("symbols", _symbols),
    Rule("word_length", _word_length),
    Rule("same_lines", _same_lines),
    Rule("capitals", _capitals),
    Rule("letterless", _letterless),
)


def _texts(batch: pa.RecordBatch, column: str) -> tuple[list[Text], np.ndarray]:
    """The texts with base counts, and for each the words in 8-word windows that it has more than once."""
    raws = [x or b"" for x in utf8(batch.column(column))]
    parts = [x.split() for x in raws]
    flat, lens = hashed_words(parts)
    texts = []
    for raw, n in zip(raws, lens.tolist()):
        lines = [x for x in raw.split(b"\n") if x.strip()]
        texts.append(Text(raw, n, len(raw.translate(None, _NOT_COUNTED)), len(raw) - len(raw.translate(None, _SYMBOLS)), len(lines) - len(set(lines)), len(lines)))
    return texts, _repeated(flat, lens)


def _repeated(flat: np.ndarray, lens: np.ndarray, width: int = 8) -> np.ndarray:
    grams = ngrams(flat, width)
    covered = np.zeros(len(flat) + 1, np.int64)
    if len(grams):
        at = np.flatnonzero(room_after(lens)[: len(grams)] >= width)
        text = np.repeat(np.arange(len(lens), dtype=np.uint64), lens)[at]
        keys = mix(grams[at], text)
        order = np.argsort(keys)
        same = keys[order][1:] == keys[order][:-1]
        twice = np.zeros(len(keys), bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        np.add.at(covered, at[twice], 1)
        np.add.at(covered, at[twice] + width, -1)
    inside = np.concatenate([[0], np.cumsum(np.cumsum(covered[:-1]) > 0)])
    ends = np.cumsum(lens)
    return inside[ends] - inside[ends - lens]


def measure(docs: DataFrame, rules: tuple[Rule, ...], text: str, sample_rows: int, min_words: int = 20) -> list[tuple[str, float, float]]:
    """(rule, seconds a text, rate of rejection) on a sample of about ``sample_rows`` rows, of texts that reach the cascade.

    Each partition samples its own rows, so nothing meets in one task. Every rule gets texts
    of its own, so what it computes is charged to it alone, after a first run that is not timed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for rule in rules:
            rule.rejects(Text(b"warm up", 2, 6, 0, 0, 1))
        for whole in batches:
            for batch in slices(whole, text):
                texts, repeated = _texts(batch, text)
                reach = [t for t, r in zip(texts, repeated.tolist()) if not _base_failed(t.n_words, r, min_words)]
                spent, hit = [], []
                for rule in rules:
                    own = [replace(t) for t in reach]
                    began = time.perf_counter()
                    hit.append(sum(map(rule.rejects, own)))
                    spent.append(time.perf_counter() - began)
                yield pa.RecordBatch.from_pydict({"rule": [r.name for r in rules], "s": spent, "hit": hit, "n": [len(reach)] * len(rules)})

    share = min(1.0, sample_rows / max(docs.count(), 1))
    rows = docs.select(text).sample(share, seed=3).mapInArrow(run, "rule string, s double, hit long, n long").groupBy("rule").sum().collect()
    found = {r[0]: (r[1] / max(r[3], 1), r[2] / max(r[3], 1)) for r in rows}
    return [(r.name, *found.get(r.name, (0.0, 0.0))) for r in rules]


def _base_failed(n_words, repeated, min_words: int):
    return (n_words < min_words) | (100 * repeated > 30 * n_words)


def ordered(rules: tuple[Rule, ...], measured: list[tuple[str, float, float]]) -> tuple[Rule, ...]:
    """Most rejections per second first; equal ones stay in the given order."""
    worth = {name: rate / max(cost, 1e-9) for name, cost, rate in measured}
    return tuple(sorted(rules, key=lambda r: -worth[r.name]))


SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean"


def judge(
    docs: DataFrame, id: str = "doc_id", text: str = "text", carry: tuple[str, ...] = (), rules: tuple[Rule, ...] = RULES, min_words: int = 20, sample_rows: int = 2000
) -> DataFrame:
    """Base counts and verdict for each row: ``id``, ``carry`` columns, then ``SCHEMA``'s."""
    text_batches(docs.sparkSession)
    cascade = ordered(rules, measure(docs, rules, text, sample_rows, min_words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for whole in batches:
            for batch in slices(whole, read):
                texts, repeated = _texts(batch, read)
                n = np.array([t.n_words for t in texts], np.int64)
                failed = _base_failed(n, repeated, min_words)
                kept = ~failed
                for rule in cascade:
                    for i in np.flatnonzero(kept):
                        kept[i] = not rule.rejects(texts[i])
                own = [batch.column(i) for i in range(1 + len(carry))]
                made = [n, [t.word_chars for t in texts], [t.n_symbols for t in texts], [t.n_dup_lines for t in texts], repeated, failed, kept]
                kinds = [pa.int64()] * 5 + [pa.bool_()] * 2
                yield pa.RecordBatch.from_arrays([*own, *(pa.array(x, k) for x, k in zip(made, kinds))], names=out.fieldNames())

    read = text if text in carry else "_text"
    given = docs.select(id, *carry, *([] if text in carry else [docs[text].alias(read)]))
    out = StructType(docs.select(id, *carry).schema.fields + StructType.fromDDL(SCHEMA).fields)
    return given.mapInArrow(run, out)
