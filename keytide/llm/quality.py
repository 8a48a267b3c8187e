"""Quality rules as a short-circuit cascade.

Every document is measured (words, symbols, repeated lines and words) and held to the base rules. The rules
beyond are run in turn on the documents that are still in, cheapest rejection first: each rule's cost
and selectivity are estimated on a sample, and rules are ordered by rejections per second. The order changes
the cost and never the verdict: a document is kept if no rule rejects it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from keytide.llm.blocks import portions, released
from keytide.llm.vectors import Prefixes, covered, mixed, span_hashes, words_of

PIECE_BYTES = 1 << 20  # of text worked on at a time; its words and windows take some thirty times that
SAMPLE_ROWS = 2000
MIN_WORDS, MOST_REPEATED_PERCENT, REPEAT_WORDS = 50, 50, 3

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True


class Batch:
    """Some texts as words and lines, each worked out when a rule first asks."""

    def __init__(self, texts: list[bytes]):
        self.size = len(texts)
        self.buffer, self.starts, self.ends, self.words, self.bounds = words_of(texts)
        self.first = np.cumsum([0, *(len(t) + 1 for t in texts)])
        self.n_words = np.diff(self.bounds)

    def rows(self, rows: np.ndarray) -> Batch:
        """The batch of only these texts."""
        raw = self.buffer.tobytes()
        return Batch([raw[self.first[i] : self.first[i + 1] - 1] for i in rows.tolist()])

    def count(self, mark: np.ndarray) -> np.ndarray:
        """Marked bytes per text."""
        return np.add.reduceat(mark, self.first[:-1], dtype=np.int64) if self.size else np.zeros(0, np.int64)

    @cached_property
    def word_chars(self) -> np.ndarray:
        starts_char = (self.buffer & 0xC0) != 0x80
        spaces = (self.buffer == 32) | ((self.buffer >= 9) & (self.buffer <= 13))
        return self.count(starts_char & ~spaces)

    @cached_property
    def n_symbols(self) -> np.ndarray:
        return self.count(_SYMBOL[self.buffer])

    @cached_property
    def _lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Text and hash of every line with a word, in order."""
        end = np.flatnonzero(self.buffer == 10)
        start = np.concatenate([[0], end[:-1] + 1]) if len(end) else end
        held = np.searchsorted(self.starts, end) > np.searchsorted(self.starts, start)
        start, end = start[held], end[held]
        return np.searchsorted(self.first, start, "right") - 1, span_hashes(self.buffer, start, end)

    @cached_property
    def n_lines(self) -> np.ndarray:
        return np.bincount(self._lines[0], minlength=self.size)

    @cached_property
    def n_dup_lines(self) -> np.ndarray:
        owner, line = self._lines
        order = np.lexsort((line, owner))
        again = np.zeros(len(order), bool)
        again[1:] = (line[order][1:] == line[order][:-1]) & (owner[order][1:] == owner[order][:-1])
        return np.bincount(owner[order][again], minlength=self.size)

    @cached_property
    def n_repeat_words(self) -> np.ndarray:
        n = REPEAT_WORDS
        owner = np.repeat(np.arange(self.size), self.n_words)
        at = np.arange(max(len(self.words) - n + 1, 0))
        at = at[owner[at] == owner[at + n - 1]] if len(at) else at
        window = mixed(Prefixes(self.words).of(at, at + n))
        order = np.lexsort((window, owner[at])) if len(at) else at
        same = (window[order][1:] == window[order][:-1]) & (owner[at][order][1:] == owner[at][order][:-1])
        twice = np.zeros(len(order), bool)
        twice[1:] |= same
        twice[:-1] |= same
        found = at[order[twice]]
        return np.bincount(owner[covered(len(self.words), found, found + n - 1)], minlength=self.size)

    @cached_property
    def top_word(self) -> np.ndarray:
        """How often the most frequent word occurs."""
        owner = np.repeat(np.arange(self.size), self.n_words)
        order = np.lexsort((self.words, owner))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (self.words[order][1:] != self.words[order][:-1]) | (owner[order][1:] != owner[order][:-1])
        heads = np.flatnonzero(fresh)
        top = np.zeros(self.size, np.int64)
        np.maximum.at(top, owner[order][heads], np.diff(np.append(heads, len(order))))
        return top


@dataclass(frozen=True)
class Rule:
    """``rejects`` says for each text of a batch whether the rule turns it down."""

    name: str
    rejects: Callable[[Batch], np.ndarray]


RULES = (
    Rule("symbols", lambda b: 10 * b.n_symbols > b.n_words),
    Rule("word_length", lambda b: (b.word_chars < 2 * b.n_words) | (b.word_chars > 15 * b.n_words)),
    Rule("dup_lines", lambda b: 10 * b.n_dup_lines > 3 * b.n_lines),
    Rule("top_word", lambda b: 10 * b.top_word > 3 * b.n_words),
    Rule("capitals", lambda b: 2 * b.count(_UPPER[b.buffer]) > b.count(_LETTER[b.buffer])),
)

MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
MEASURES += ", base_failed boolean, kept boolean"


def _batches(texts: pa.Array) -> Iterator[Batch]:
    """About a megabyte of texts at a time; what the one before took is given back first."""
    released()
    for _, held in portions(texts, PIECE_BYTES):
        yield Batch(held)
        released()


def _base_failed(batch: Batch) -> np.ndarray:
    return (batch.n_words < MIN_WORDS) | (100 * batch.n_repeat_words > MOST_REPEATED_PERCENT * batch.n_words)


def cascade_order(docs: DataFrame, id_col: str, text_col: str, rules: Sequence[Rule] = RULES) -> list[str]:
    """Names of the rules by rejections per second, most first, estimated on about SAMPLE_ROWS documents.

    Each rule is timed on its own on all sampled texts that pass the base rules. Only the order comes from the
    sample; every rule runs on every document that is still in.
    """
    rows = docs.count()
    every = F.pmod(F.xxhash64(id_col, text_col), F.lit(max(1, rows // SAMPLE_ROWS))) == 0

    def tried(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (batch for frame in frames for batch in _batches(frame.column(0))):
            batch = batch.rows(np.flatnonzero(~_base_failed(batch)))
            for rule in rules:
                own = batch.rows(np.arange(batch.size))  # nothing worked out by another rule
                began = time.perf_counter()
                gone = int(np.count_nonzero(rule.rejects(own)))
                yield pa.RecordBatch.from_pydict({"rule": [rule.name], "gone": [gone], "seconds": [time.perf_counter() - began]})

    sample = docs.where(every).select(F.col(text_col).cast("string").alias("text"))
    tried_rules = sample.mapInArrow(tried, "rule string, gone long, seconds double")
    figures = tried_rules.groupBy("rule").agg(F.sum("gone").alias("gone"), F.sum("seconds").alias("seconds")).collect()
    worth = {row["rule"]: row["gone"] / max(row["seconds"], 1e-9) for row in figures}
    return sorted((rule.name for rule in rules), key=lambda name: -worth.get(name, 0.0))


def _rejected(batch: Batch, open_: np.ndarray, rules: Sequence[Rule]) -> np.ndarray:
    """Which texts a rule rejects; each rule sees only the texts that are still in."""
    out = np.zeros(batch.size, bool)
    rows, part = np.flatnonzero(open_), None
    for rule in rules:
        if not len(rows):
            break
        if part is None or 2 * len(rows) < part.size:  # cut down once half of the texts are out
            at, part = rows, batch if len(rows) == batch.size else batch.rows(rows)
        gone = rule.rejects(part)[np.searchsorted(at, rows)]
        out[rows[gone]] = True
        rows = rows[~gone]
    return out


def verdicts(docs: DataFrame, id_col: str, text_col: str, rules: Sequence[Rule] = RULES):
    """The measures of a text as one column expression, with the cascade ordered for these documents."""
    order = cascade_order(docs, id_col, text_col, rules)
    cascade = sorted(rules, key=lambda rule: order.index(rule.name))

    def measured(texts: pa.Array) -> pa.Array:
        fields = [(name, {"long": pa.int64(), "boolean": pa.bool_()}[kind]) for name, kind in map(str.split, MEASURES.split(", "))]
        parts = [pa.array([], pa.struct(fields))]
        for batch in _batches(texts):
            failed = _base_failed(batch)
            columns = {
                "n_words": batch.n_words,
                "word_chars": batch.word_chars,
                "n_symbols": batch.n_symbols,
                "n_dup_lines": batch.n_dup_lines,
                "n_repeat_words": batch.n_repeat_words,
                "base_failed": failed,
                "kept": ~failed & ~_rejected(batch, ~failed, cascade),
            }
            parts.append(pa.StructArray.from_arrays([pa.array(columns[name], kind) for name, kind in fields], [name for name, _ in fields]))
            del batch, columns  # before it is given back
        return pa.concat_arrays(parts)

    return F.arrow_udf(measured, MEASURES)(F.col(text_col).cast("string"))


def rate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    The base rules want 50 words and at most half of all words in 3-word windows found twice. A null text has
    no words. A null id stays null; rows that share an id are rated each. Other columns are not looked
    at; empty tables give no rows.
    """
    measures = verdicts(docs, id_col, text_col, rules)
    rated = docs.select(F.col(id_col).cast("long").alias("doc_id"), measures.alias("m"))
    return rated.select("doc_id", "m.*")


def kept(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The documents that no rule rejects, with all their columns."""
    return docs.where(verdicts(docs, id_col, text_col, rules)["kept"])
