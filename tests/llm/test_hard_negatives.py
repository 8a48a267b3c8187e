"""Hard negatives against a plain loop, with odd vectors."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from keytide.llm import hard_negatives as H

SCHEMA = "vec_id long, label int, embedding array<float>, slot string, score int"


def brute(rows, anchor, positives=5, negatives=3, low=50, high=95):
    usable = {}
    for number, label, vector, *_ in rows:
        if number is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        ints = [math.floor(256 * float(np.float32(x))) for x in vector]
        usable[number] = min(usable.get(number, (label, ints)), (label, ints))

    def score(a, b):
        whole = sum(x * y for x, y in zip(usable[a][1], usable[b][1]))
        return max(-(2**63 - 1), min(2**63 - 1, whole))

    out = []
    for a in filter(anchor, usable):
        others = sorted((o for o in usable if o != a), key=lambda o: (-score(a, o), o))
        for p in [o for o in others if usable[o][0] == usable[a][0]][:positives]:
            top = score(a, p)
            inside = [
                o for o in others if usable[o][0] != usable[a][0] and low * top <= 100 * score(a, o) <= high * top
            ]
            out += [(a, p, n + 1, o, top, score(a, o)) for n, o in enumerate(inside[:negatives])]
    return sorted(out)


def made(seed, rows, spread=0.4):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    return [
        (i * 10, draw.randrange(4), [c + draw.gauss(0, spread) for c in centres[draw.randrange(4)]], "x", None)
        for i in range(rows)
    ]


def got(spark, rows, is_anchor, **given):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return sorted(map(tuple, H.mined(df, is_anchor, **given).collect()))


@pytest.mark.parametrize("seed", range(3))
def test_equals_a_loop(spark, seed):
    rows = made(seed, 150)
    assert got(spark, rows, F.col("id") % 50 == 0) == brute(rows, lambda i: i % 50 == 0)


def test_blocks_and_chunks_change_nothing(spark, monkeypatch):
    rows = made(9, 120)
    monkeypatch.setattr(H, "BLOCK_ANCHORS", 7)
    assert got(spark, rows, F.col("id") % 30 == 0) == brute(rows, lambda i: i % 30 == 0)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 1.0], "a", 1),
        (0, 1, [1.0, 1.0], "a", 1),  # a repeated row counts once
        (0, 2, [9.0, 9.0], "a", 1),  # of one id, the smallest label counts
        (1, 1, [1.0, 0.5], None, None),
        (2, 1, [1.0, 0.5], "", 0),  # a tie goes to the smaller id
        (3, 1, [0.0, 0.0], "", 0),  # score 0: only 0 is in its window
        (4, 1, [-1.0, -1.0], "", 0),  # a negative score has no window
        (5, 2, [0.5, 0.5], "", 0),
        (6, 2, [0.5], "", 0),  # shorter vectors end in zeros
        (7, 3, [], "", 0),
        (8, 3, [0.6, 0.1], "", 0),
        (9, 3, [0.6, 0.1, 5.0], "", 0),
        (10, None, [1.0, 1.0], "", 0),
        (11, 2, None, "", 0),
        (12, 2, [1.0, None], "", 0),
        (13, 2, [nan, 1.0], "", 0),
        (14, 2, [inf, 1.0], "", 0),
        (None, 2, [1.0, 1.0], "", 0),
        (15, 4, [1.0, 1.0], "", 0),  # an anchor without positives
    ]
    want = brute(rows, lambda i: i % 5 == 0)
    assert want and got(spark, rows, F.col("id") % 5 == 0) == want


def test_scores_beyond_doubles_are_exact(spark):
    draw = random.Random(4)
    rows = [(i, i % 2, [float(draw.randrange(1 << 28)) for _ in range(3)], "", 0) for i in range(40)]
    assert got(spark, rows, F.col("id") % 4 == 0) == brute(rows, lambda i: i % 4 == 0)
    rows = [(i, i % 2, [float(draw.randrange(1 << 10)) * 1e30], "", 0) for i in range(12)]
    assert got(spark, rows, F.col("id") % 4 == 0) == brute(rows, lambda i: i % 4 == 0)


def test_empty_tables(spark):
    assert got(spark, [], F.col("id") % 2 == 0) == []
    assert got(spark, made(1, 5), F.col("id") < 0) == []


def test_a_task_sends_no_more_than_the_best(spark):
    rows = spark.createDataFrame(made(2, 400), SCHEMA).repartition(3)
    table = H.prepared(rows, "vec_id", "label", "embedding", 256)
    block = H._block(table.where("id % 100 = 0"))
    sent = H._scored(table, block, 1, 5, H._positives)
    assert sent.count() <= 5 * len(block.ids) * table.rdd.getNumPartitions()
