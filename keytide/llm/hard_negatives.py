"""Hard negatives by slots: rows of another label whose score lies in a window below a positive's score.

A positive of score p takes negatives from ``low`` to ``high`` percent of p. An anchor's windows overlap, but all of them
end at the upper limits of its positives. These limits split the scores into disjoint slots, and only the best few rows of
a slot can ever be an answer. Tasks score rows against blocks of anchors, keep the best per (anchor, slot) and nothing
else; those of all tasks are reduced again by a ranked window. A positive's answer is then read off the slots from its own
downwards, since every slot lies below the one before.

Scores are exact integers. Where sums could exceed what doubles hold, Python integers take over; a score beyond 64 bits
counts as the largest or smallest 64-bit number.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from keytide.settings import written_table

# An anchor block is broadcast, so its size is fixed; more anchors are more passes over the rows.
BLOCK_ANCHORS = 8192
BLOCK_VALUES = 4 << 20
CHUNK_SCORES = 4 << 20  # rows are scored so many products at a time
EXACT = 1 << 53  # doubles hold all integers up to here
LEAST = np.iinfo(np.int64).min + 1
SCORED = "anchor_id long, slot int, score long, found_id long"


def integral(vectors: Column, scale: int) -> Column:
    """floor(scale * x) of every component."""
    return F.transform(vectors, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def usable(vectors: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""

    def bad(x: Column) -> Column:
        x = x.cast("double")
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    return vectors.isNotNull() & ~F.exists(vectors, bad)


def prepared(rows: DataFrame, id_col: str, label_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, label, v) of the rows that take part, one per id; written, since several passes read it."""
    there = rows.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & usable(F.col(vector_col)))
    same = F.struct(F.col(label_col).cast("long").alias("label"), integral(F.col(vector_col), scale).alias("v"))
    one = there.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min(same).alias("_one"))
    return written_table(one.select("id", "_one.label", "_one.v"), "vectors")


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists as rows of one array; shorter ones end in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = int(sizes.max(initial=0))
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def products(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Inner products as 64-bit integers, exact."""
    width = min(rows.shape[1], anchors.shape[1])
    rows, anchors = rows[:, :width], anchors[:, :width]
    if not rows.size or not anchors.size:
        return np.zeros((len(rows), len(anchors)), np.int64)
    largest = [max(abs(int(m.min())), abs(int(m.max()))) for m in (rows, anchors)]
    if largest[0] * largest[1] * width < EXACT:
        return (rows.astype(np.float64) @ anchors.astype(np.float64).T).astype(np.int64)
    exact = rows.astype(object) @ anchors.astype(object).T
    return np.clip(exact, int(LEAST), -int(LEAST)).astype(np.int64)


@dataclass
class Anchors:
    """A block of anchors. ``limits`` are their slots' upper ends, descending; a slot that is not there has LEAST."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    limits: np.ndarray | None = None
    floors: np.ndarray | None = None


class Best:
    """The best ``most`` found rows of every (anchor, slot), by score and then id."""

    def __init__(self, anchors: int, slots: int, most: int):
        self.slots, self.most = slots, most
        self.group = np.zeros(0, np.int64)
        self.score, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.bar = np.full(anchors * slots, LEAST, np.int64)  # what a full group's next row has to reach

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        group = np.concatenate([self.group, group])
        score, ids = np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        order = np.lexsort((ids, -score, group))
        group, score, ids = group[order], score[order], ids[order]
        begins = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, np.int64)
        place = np.arange(len(group)) - np.repeat(begins, np.diff(np.r_[begins, len(group)]))
        keep = place < self.most
        self.group, self.score, self.id = group[keep], score[keep], ids[keep]
        full = place == self.most - 1
        self.bar[group[full]] = score[full]


def _positives(best: Best, anchors: Anchors, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
    for label in np.intersect1d(labels, anchors.labels):
        at, to = np.flatnonzero(labels == label), np.flatnonzero(anchors.labels == label)
        score = products(vectors[at], anchors.vectors[to])
        r, a = np.nonzero((score >= best.bar[to]) & (ids[at][:, None] != anchors.ids[to]))
        best.add(to[a], score[r, a], ids[at[r]])


def _negatives(best: Best, anchors: Anchors, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
    score = products(vectors, anchors.vectors)
    open_ = (labels[:, None] != anchors.labels) & (score >= anchors.floors)
    bars = best.bar.reshape(-1, best.slots)
    slot = np.zeros(score.shape, np.int8)
    for limit in anchors.limits.T:
        slot += score <= limit
    for number in range(best.slots):
        r, a = np.nonzero(open_ & (slot == number + 1) & (score >= bars[:, number]))
        best.add(a * best.slots + number, score[r, a], ids[r])


def _scored(rows: DataFrame, anchors: Anchors, slots: int, most: int, step: Callable) -> DataFrame:
    """One pass: what each task found for every (anchor, slot)."""
    shared = rows.sparkSession.sparkContext.broadcast(anchors)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Anchors = shared.value
        best = Best(len(block.ids), slots, most)
        size = max(1, CHUNK_SCORES // max(1, len(block.ids)))
        for batch in batches:
            for low in range(0, batch.num_rows, size):
                part = batch.slice(low, size)
                ids, labels = (part.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                step(best, block, ids, labels, _matrix(part.column(2)))
        anchor, slot = best.group // slots, best.group % slots
        yield pa.record_batch(
            [pa.array(block.ids[anchor]), pa.array(slot.astype(np.int32)), pa.array(best.score), pa.array(best.id)],
            names=["anchor_id", "slot", "score", "found_id"],
        )

    return rows.select("id", "label", "v").mapInArrow(work, SCORED)


def _best(scored: DataFrame, most: int) -> DataFrame:
    """The ranked window drops what cannot be among the best before the shuffle, too."""
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.col("score").desc(), "found_id")
    return scored.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)


def _blocks(anchors: DataFrame) -> int:
    rows, values = anchors.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("v") + 1), F.lit(0))).first()
    return max(1, math.ceil(rows / BLOCK_ANCHORS), math.ceil(values / BLOCK_VALUES)) if rows else 0


def mined(
    rows: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` is a condition over the column ``id``. An anchor's positives are the ``positives`` other rows of its label
    with the highest scores; each gets the best ``negatives`` rows of other labels between ``low`` and ``high`` percent of
    its score (whole percentages from 0). Ties go to the smaller id. The score is the inner product of the components'
    floor(scale * x); of vectors of different lengths the shorter ends in zeros, an empty one scores 0.

    Rows with a null id, label or vector, or with a component that is null or not finite, take no part. Of several rows
    with one id the one with the smallest label, then vector, counts. An anchor without positives, and a positive with
    nothing in its window (any with a negative score), has no row. Empty tables give no rows. Other columns play no part.

    Every row is scored against every anchor, in blocks of a fixed size: the anchors of a block are broadcast (at most
    about BLOCK_ANCHORS anchors and BLOCK_VALUES components), the rows stay where they are. What moves is the best few per
    anchor, slot and task.
    """
    spark = rows.sparkSession
    table = prepared(rows, id_col, label_col, vector_col, scale)
    anchors = table.where(is_anchor)
    blocks = _blocks(anchors)
    found: DataFrame | None = None
    for number in range(blocks):
        inside = anchors.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == number)
        block = _block(inside)
        scored = _scored(table, block, 1, positives, _positives)
        pairs = written_table(_best(scored, positives).select("anchor_id", "place", "score", "found_id"), "positives")
        ends = _with_windows(pairs, low, high)
        _set_slots(block, ends, positives)
        slots = written_table(_best(_scored(table, block, positives, negatives, _negatives), negatives), "slots")
        answered = _answers(ends, slots, negatives)
        found = answered if found is None else found.unionByName(answered)
    if found is None:
        kinds = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        return spark.createDataFrame([], kinds)
    return found


def _block(anchors: DataFrame) -> Anchors:
    told = anchors.select("id", "label", "v").toArrow()
    ids, labels = (told.column(i).to_numpy() for i in (0, 1))
    return Anchors(ids, labels, _matrix(told.column(2)))


def _with_windows(pairs: DataFrame, low: int, high: int) -> DataFrame:
    """Positives with the first and last score of their window, as far as there is one, and the slot it ends in."""
    wide = F.col("score").cast("decimal(20,0)")
    first = F.ceil(wide * low / 100).cast("decimal(20,0)")
    last = F.floor(wide * high / 100).cast("decimal(20,0)")
    windows = pairs.select("anchor_id", F.col("found_id").alias("positive_id"), "score", first.alias("first"), last.alias("last"))
    order = Window.partitionBy("anchor_id").orderBy(F.col("last").desc())
    kept = windows.where(F.col("first") <= F.col("last")).withColumn("slot", F.dense_rank().over(order) - 1)
    return kept.withColumn("first", F.col("first").cast("long")).withColumn("last", F.col("last").cast("long"))


def _set_slots(block: Anchors, ends: DataFrame, slots: int) -> None:
    """Give the block its slots. The positives of a block are a fixed number per anchor."""
    place = {int(i): n for n, i in enumerate(block.ids)}
    block.limits = np.full((len(block.ids), slots), LEAST, np.int64)
    block.floors = np.full(len(block.ids), -LEAST, np.int64)
    told = ends.groupBy("anchor_id", "slot").agg(F.first("last").alias("last"), F.min("first").alias("first")).toArrow()
    at = np.array([place[i] for i in told["anchor_id"].to_pylist()], np.int64)
    block.limits[at, told["slot"].to_numpy()] = told["last"].to_numpy()
    np.minimum.at(block.floors, at, told["first"].to_numpy())


def _answers(ends: DataFrame, slots: DataFrame, negatives: int) -> DataFrame:
    """A positive's window begins in its own slot and goes on through those below, each already in order."""
    entry = F.struct("slot", (-F.col("score")).alias("minus"), "found_id")
    by_anchor = slots.groupBy("anchor_id").agg(F.sort_array(F.collect_list(entry)).alias("entries"))  # slots * negatives
    inside = F.filter("entries", lambda e: (e["slot"] >= F.col("slot")) & (-e["minus"] >= F.col("first")))
    met = ends.join(by_anchor, "anchor_id").withColumn("inside", F.slice(inside, 1, negatives))
    return met.select(
        "anchor_id", "positive_id", F.col("score").alias("positive_score"), F.posexplode("inside").alias("at", "one")
    ).select(
        "anchor_id",
        "positive_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("one.found_id").alias("negative_id"),
        "positive_score",
        (-F.col("one.minus")).alias("negative_score"),
    )
