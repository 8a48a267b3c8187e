"""Toxicity by a factorization machine over hashed terms.

A text's terms are its distinct runs of letters in lower case, and how these begin, hashed to 32 bits. The score is the logistic of a bias, a
weight per term and, for every pair of terms, the product of their factor vectors, so that two terms may mean together
what neither means alone. Only terms whose frequency differs most between the classes take part (G statistic); the others
count nothing, which keeps the model small and a long text's score as sharp as a short one's.

Features and frequencies are worked out by Spark; the fit of the few thousand terms runs in one task over a bounded sample
of labelled rows. Scoring reads whole texts where they lie.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from keytide.settings import written_table

SAMPLE_ROWS = 20_000  # the most labelled rows a model is fitted on
TERMS = 1024  # the most terms a model weighs
RARE = 4  # a term in fewer sampled texts is not weighed
FACTORS = 4
SWEEPS = 30
SPARSE, RIDGE, SMOOTH = 2e-5, 3e-5, 2e-3  # penalties: absolute and squared weights, squared factors
THRESHOLD = 0.7
SLICE = 1 << 20  # characters of a long text worked on at a time
STEMS = (4, 5, 6)  # first letters of a word that count as a term
KNOWN = 200_000  # words remembered per task
_WORD = re.compile(r"[^\W\d_]+")
_BREAK = re.compile(r"[\W\d_]")
_MODEL = "term long, weight double, factors array<double>"
_BIAS = -1  # the term that stands for the bias


def hashed(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass"))


def terms(word: str) -> tuple[int, ...]:
    """A word stands for itself and for how it begins, so that forms of one stem are met together."""
    return (hashed(word), *(hashed(word[:n] + "-") for n in STEMS if len(word) > n))


def words(text: str) -> Iterator[list[str]]:
    """Lower-case runs of letters; a long text in slices that end between words."""
    low = 0
    while low < len(text):
        end = _BREAK.search(text, low + SLICE) if len(text) - low > SLICE else None
        high = end.start() if end else len(text)
        yield _WORD.findall(text[low:high].lower())
        low = high


class _Memory(dict):
    """Words to what ``of`` makes of them, forgotten all at once when there are too many."""

    def __init__(self, of):
        super().__init__()
        self.of = of

    def __missing__(self, word: str):
        if len(self) >= KNOWN:
            self.clear()
        found = self[word] = self.of(word)
        return found


def terms_of(text: str | None, memory: dict) -> set:
    found: set = set()
    for part in words(text or ""):
        found.update(*map(memory.__getitem__, set(part)))
    return found


def held_out(doc_id: Column) -> Column:
    """Whether a row's label is kept for testing; a null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, most: int, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(row, toxic, terms) of at most ``most`` labelled rows, taken in the order of a hash of the id; equal texts once."""
    told = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    one = told.groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    chosen = one.orderBy(F.xxhash64("_id"), "_id").limit(most)
    met = docs.join(F.broadcast(chosen), F.col(id_col) == F.col("_id")).select("toxic", F.col(text_col).alias("text"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memory = _Memory(terms)
        for batch in batches:
            found = [sorted(terms_of(text, memory)) for text in batch["text"]]
            yield pd.DataFrame({"toxic": batch["toxic"], "terms": found})

    seen = met.mapInPandas(read, "toxic int, terms array<long>")
    same = seen.groupBy("terms").agg(F.max("toxic").alias("toxic"))
    return written_table(same.select(F.monotonically_increasing_id().alias("row"), "toxic", "terms"), "toxicity-sample")


def telling_terms(rows: DataFrame, most: int) -> DataFrame:
    """term, place: the terms whose share among toxic rows differs most from that among the others."""
    all_rows, toxic_rows = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    counts = rows.select("toxic", F.explode("terms").alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("t")
    )

    def part(seen: Column, rate: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / rate)).otherwise(0.0)

    def gain(toxic: Column, clean: Column, n: Column) -> Column:
        share = toxic_rows / max(all_rows, 1)
        return part(toxic, n * share) + part(clean, n * (1 - share))

    with_term = gain(F.col("t"), F.col("n") - F.col("t"), F.col("n"))
    without = gain(toxic_rows - F.col("t"), all_rows - toxic_rows - F.col("n") + F.col("t"), all_rows - F.col("n"))
    ranked = counts.where(F.col("n") >= RARE).withColumn("g", 2 * (with_term + without))
    return ranked.where("g > 0").orderBy(F.col("g").desc(), "term").limit(most).select("term")


@dataclass
class Machine:
    """A fitted model: ``terms`` sorted, with a weight and factors each."""

    bias: float
    terms: np.ndarray
    weights: np.ndarray
    factors: np.ndarray

    def scores(self, row: np.ndarray, place: np.ndarray, rows: int) -> np.ndarray:
        """The probability of each of ``rows`` rows; entry i says that row[i] holds the term at place[i]."""
        return 1 / (1 + np.exp(-np.clip(_margin(self, row, place, rows)[0], -40, 40)))


def _sums(row: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    return np.stack([np.bincount(row, column, rows) for column in values.T], 1)


def _margin(m: Machine, row: np.ndarray, place: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    held = m.factors[place]
    total = _sums(row, held, rows)
    pairs = (total * total - _sums(row, held * held, rows)).sum(1) / 2
    return m.bias + np.bincount(row, m.weights[place], rows) + pairs, total


def fit(row: np.ndarray, place: np.ndarray, toxic: np.ndarray, terms: np.ndarray, sweeps: int = SWEEPS) -> Machine:
    """Coordinate descent: the margin is linear in every single parameter, so each takes a Newton step in turn.

    Weights are drawn to zero by their absolute size, so that of terms that say the same the commonest stands for all;
    factors by their squares, so that a pair counts only if the weights leave much unexplained.
    """
    n, size = len(toxic), len(terms)
    share = (toxic.sum() + 0.5) / (n + 1)
    start = np.random.default_rng(7).normal(0, 0.05, (size, FACTORS))
    m = Machine(float(np.log(share / (1 - share))), terms, np.zeros(size), start)
    if not n:
        return m
    order = np.lexsort((row, place))
    holders = np.split(row[order], np.cumsum(np.bincount(place, minlength=size))[:-1])[:size]
    margin, total = _margin(m, row, place, n)

    def slopes(at) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(margin[at], -40, 40)))
        return (p - toxic[at]) / n, p * (1 - p) / n

    for _ in range(sweeps):
        first, second = slopes(slice(None))
        step = np.clip(-first.sum() / (second.sum() + 1e-9), -1, 1)
        m.bias, margin = m.bias + float(step), margin + step
        moved = abs(step)
        for j, at in enumerate(holders):
            first, second = slopes(at)
            bend = second.sum() + RIDGE
            goal = m.weights[j] - (first.sum() + RIDGE * m.weights[j]) / bend
            goal = np.sign(goal) * max(abs(goal) - SPARSE / bend, 0.0)
            step = np.clip(goal - m.weights[j], -1, 1)
            if step:
                m.weights[j] += step
                margin[at] += step
            moved = max(moved, abs(step))
        for j, at in enumerate(holders):
            for f in range(FACTORS):
                others = total[at, f] - m.factors[j, f]
                first, second = slopes(at)
                slope = (first * others).sum() + SMOOTH * m.factors[j, f]
                step = np.clip(-slope / ((second * others * others).sum() + SMOOTH), -0.5, 0.5)
                m.factors[j, f] += step
                margin[at] += step * others
                total[at, f] += step
        if moved < 0.01:
            break
    return m


def trained(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """The model as a table: a row per term that weighs something, and the bias."""
    chosen = terms.withColumn("one", F.lit(1))
    entries = rows.select("row", "toxic", F.explode_outer("terms").alias("term")).join(F.broadcast(chosen), "term", "left")
    texts = entries.groupBy("row", "toxic").agg(F.collect_list(F.when(F.col("one") == 1, F.col("term"))).alias("terms"))

    def work(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values("row")
        held = [np.asarray(t, np.int64) for t in batch["terms"]]
        flat = np.concatenate([np.zeros(0, np.int64), *held])
        known, place = np.unique(flat, return_inverse=True)
        m = fit(np.repeat(np.arange(len(held)), [len(t) for t in held]), place, batch["toxic"].to_numpy(float), known)
        weighs = np.flatnonzero((m.weights != 0) | (np.abs(m.factors).max(1, initial=0) > 0.05))
        told = [(_BIAS, m.bias, [0.0] * FACTORS), *zip(m.terms[weighs], m.weights[weighs], m.factors[weighs].tolist())]
        return pd.DataFrame(told, columns=["term", "weight", "factors"])

    return written_table(texts.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(work, _MODEL), "toxicity-model")


def machine(model: DataFrame) -> Machine:
    """The model in memory: at most TERMS terms and the bias. Without labelled rows it says one half of every text."""
    told = sorted((r.term, r.weight, r.factors) for r in model.collect())
    bias = told.pop(0)[1] if told else 0.0
    factors = np.array([r[2] for r in told]).reshape(len(told), FACTORS)
    return Machine(bias, np.array([r[0] for r in told], np.int64), np.array([r[1] for r in told], float), factors)


def learned(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
) -> Machine:
    """A machine fitted on at most ``sample_rows`` labelled rows whose ids are not held out.

    Labels that are null, or of a null id, are left out; of several labels of an id the highest counts, as it does of equal
    sets of terms. All texts of a labelled id are used.
    """
    rows = sample(docs, labels, sample_rows, id_col, text_col, label_col)
    return machine(trained(rows, written_table(telling_terms(rows, TERMS), "toxicity-terms")))


def scored(
    docs: DataFrame, model: Machine, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from ``threshold``) per row, repeated rows too.

    A null text counts as empty and gets the score of a text without any telling term. A null id is not held out. Other
    columns, labels among them, play no part.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most TERMS terms

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Machine = shared.value
        number = {int(t): i for i, t in enumerate(m.terms)}
        memory = _Memory(lambda word: tuple(number[t] for t in terms(word) if t in number))
        for batch in batches:
            held = [terms_of(text, memory) for text in batch.column(2).to_pylist()]
            row = np.repeat(np.arange(len(held)), [len(t) for t in held])
            place = np.array([p for t in held for p in sorted(t)], np.int64)
            score = m.scores(row, place, len(held))
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)), F.col(text_col).cast("string"))
    return rows.mapInArrow(work, "doc_id long, held_out boolean, score double, predicted int")
