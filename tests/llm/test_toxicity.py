"""Toxicity scores: pairs of terms, held-out accuracy, and what is left out."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from keytide.llm import queries, toxicity as T


@pytest.mark.parametrize("toxic_if", [np.logical_xor, np.logical_and], ids=["either", "both"])
def test_pairs_are_learned(toxic_if):
    """Weights alone cannot say that one of two terms is toxic and both are not."""
    draw = np.random.default_rng(3)

    def texts(n):
        held = draw.random((n, 40)) < 0.3
        return *np.nonzero(held), toxic_if(held[:, 0], held[:, 1]).astype(float)

    row, place, toxic = texts(600)
    machine = T.fit(row, place, toxic, np.arange(40))
    row, place, toxic = texts(400)
    assert ((machine.scores(row, place, 400) >= 0.5) == (toxic == 1)).mean() > 0.97


def test_scores_equal_the_sum_over_pairs():
    draw = np.random.default_rng(1)
    machine = T.Machine(-0.3, np.arange(6), draw.normal(size=6), draw.normal(size=(6, 4)))
    held = [[0, 2, 5], [], [3], [0, 1, 2, 3, 4, 5]]
    row = np.repeat(np.arange(4), [len(h) for h in held])
    got = machine.scores(row, np.array(sum(held, [])), 4)
    for h, score in zip(held, got):
        pairs = sum(machine.factors[i] @ machine.factors[j] for i in h for j in h if i < j)
        assert score == pytest.approx(1 / (1 + np.exp(-(-0.3 + machine.weights[h].sum() + pairs))))


@pytest.fixture(scope="module")
def labelled(spark):
    """Insults of two kinds among invented words; a word that toxic and clean texts share."""
    draw = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(900):
        said = ["".join(draw.choice(list("abcdefgh"), 5)) for _ in range(40)] + ["common"]
        toxic = int(i % 5 == 0)
        if toxic:
            said[7] = "Vile!" if i % 2 else "grobel" + "".join(draw.choice(list("xyz"), 3))
        rows.append((i, " ".join(said)))
        labels.append((i, toxic))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_accuracy(labelled):
    docs, labels = labelled
    got = T.scored(docs, T.learned(docs, labels)).join(labels, "doc_id").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    assert ((got.score >= 0.7) == (got.predicted == 1)).all() and got.score.between(0, 1).all()
    test = got[got.held_out]
    assert test[test.toxic == 1].predicted.mean() > 0.95 and test[test.toxic == 0].predicted.mean() < 0.01


def test_held_out_labels_are_not_used(labelled):
    """Turning them round changes no score."""
    docs, labels = labelled
    turned = labels.withColumn("toxic", T.F.when(T.held_out(T.F.col("doc_id")), 1 - T.F.col("toxic")).otherwise(T.F.col("toxic")))
    first, second = (T.scored(docs, T.learned(docs, told)).orderBy("doc_id").collect() for told in (labels, turned))
    assert first == second


def test_the_sample_is_bounded(spark, labelled):
    docs, labels = labelled
    assert T.sample(docs, labels, 100, "doc_id", "text", "toxic").count() == 100


def test_odd_rows(spark, odd, empty, labelled):
    docs, labels = labelled
    machine = T.learned(docs, labels)
    got = T.scored(odd, machine).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    blank = {r.score for r in got if r.doc_id in (3, 4, 7)}
    assert blank == {1 / (1 + np.exp(-machine.bias))} and not any(r.held_out for r in got if r.doc_id is None)
    assert T.scored(empty, machine).collect() == []


def test_without_labels(spark, odd, empty):
    no_labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    for docs in (odd, empty):
        machine = T.learned(docs, no_labels)
        assert {r.score for r in T.scored(odd, machine).collect()} == {0.5}
    one = spark.createDataFrame([(2, 1), (2, 0), (4, 0), (9, 0)], "doc_id long, toxic int")
    assert all(0 <= r.score <= 1 for r in T.scored(odd, T.learned(odd, one)).collect())


def test_long_texts_are_read_whole():
    memory = T._Memory(T.terms)
    text = "word " * (T.SLICE // 4) + "Scoundrel, " + "x" * (2 * T.SLICE) + " end"
    found = T.terms_of(text, memory)
    assert {T.hashed(w) for w in ("word", "scoundrel", "x" * (2 * T.SLICE), "end")} <= found


def test_given_tables(spark, data):
    got = queries.op11_toxicity(spark, data).collect()
    assert len(got) == queries.documents(spark, data).count()
