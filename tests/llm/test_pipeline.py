"""The corpus pipeline, and each of its stages, against brute force on a small folder of documents."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from keytide.llm import queries
from tests.compare import database
from tests.llm.test_near import WORD, brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WINDOW = corpus_pipeline.PASSAGE_WORDS


def made() -> list[tuple]:
    """Clean texts, copies, near copies, shared passages, rejects, nulls, empty texts and a repeated row."""
    draw = random.Random(12)
    word = lambda: "".join(draw.choice("abcdefghiklmnoprstu") for _ in range(draw.randrange(3, 9)))
    words = lambda n: [word() for _ in range(n)]
    texts: dict = {}
    for i in range(20):
        texts[i] = words(120)
    for i in range(5):
        near = list(texts[i])
        near[10 * i + 5] = word()  # 5 of 116 shingles differ
        texts[100 + i] = near
        texts[200 + i] = list(texts[i])
        texts[250 + i] = [w.capitalize() for w in texts[i]]  # the same shingles
    far = list(texts[7])
    for at in range(0, 120, 11):
        far[at] = word()
    texts[107] = far  # most shingles differ
    passage, other = words(60), words(55)
    for i in range(300, 305):
        texts[i] = words(70) + passage + words(30 + i % 7)
    texts[310] = passage  # nothing is left of it
    texts[311] = other + words(60)
    texts[312] = words(60) + other
    texts[313] = words(60) + other[:-10] + words(60)  # 45 words in a row are too few
    texts[314] = words(80) + other + words(20) + passage
    texts[400] = words(20)
    texts[401] = words(4) * 40
    texts[402] = ["#" + w + "*|" for w in words(90)]
    texts[403] = [w.upper() for w in words(90)]
    rows = [(i, " ".join(text), "xx", "made", None) for i, text in texts.items()]
    rows += [(500, "", "xx", None, 0), (501, None, None, "made", None), (None, " ".join(words(100)), None, None, None)]
    rows += [rows[9], (502, " ".join(words(9000)), "xx", "long", 1)]
    return rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    where = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(made(), SCHEMA).repartition(4).write.parquet(f"{where}/documents.parquet")
    return where


def of(rows) -> list[tuple]:
    return sorted(((r[0], r[1]) for r in rows), key=repr)


def good(folder) -> list[tuple]:
    kept = {r[0] for r in database(folder, ("documents",)).sql(f"SELECT doc_id FROM ({queries.ORACLES['op7_quality_rules']}) WHERE kept").fetchall()}
    return [row for row in made() if row[0] in kept]


def singles(rows) -> list[tuple]:
    found = brute([row[:2] for row in rows], corpus_pipeline.SHINGLE_WORDS, corpus_pipeline.NEAR_PERCENT)
    # A null id is in no group here.
    stays = {one[0] for one in found if one[0] == one[2]} | {None}
    return list({row[:2]: row for row in rows if row[0] in stays}.values())


def cut(rows) -> list[tuple]:
    number = lambda key: float("inf") if key is None else key
    held = [(row, WORD.findall(row[1].encode())) for row in rows]
    first: dict = {}
    for row, words in held:
        for i in range(len(words) - WINDOW + 1):
            name = tuple(words[i : i + WINDOW])
            first[name] = min(first.get(name, float("inf")), number(row[0]))
    out = []
    for row, words in held:
        gone = set()
        for i in range(len(words) - WINDOW + 1):
            if first[tuple(words[i : i + WINDOW])] < number(row[0]):
                gone |= set(range(i, i + WINDOW))
        if not gone:
            out.append(row)
        elif len(gone) < len(words):
            runs, last = [], None
            for i in sorted(set(range(len(words))) - gone):
                runs = [*runs, [words[i]]] if last != i - 1 else [*runs[:-1], [*runs[-1], words[i]]]
                last = i
            text = "\n".join(b" ".join(run).decode() for run in runs)
            out.append((row[0], text, row[2], row[3], len(text)))
    return out


def pieces(rows) -> list[tuple]:
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = []
    for row in rows:
        ids = np.array([*library.encode(row[1], add_special_tokens=False).ids, 1], "<u4")
        for number, low in enumerate(range(0, len(ids), 4096)):
            part = ids[low : low + 4096]
            out.append((row[0], number, low, len(part), zlib.crc32(part.tobytes())))
    return sorted(out, key=repr)


def test_the_fixture_has_every_case(folder):
    start, kept = made(), good(folder)
    left = singles(kept)
    done = cut(left)
    ids = lambda rows: {row[0] for row in rows}
    assert {400, 401, 402, 403, 500, 501} == ids(start) - ids(kept)
    assert {*range(100, 105), *range(200, 205), *range(250, 255)} <= ids(kept) - ids(left) and 107 in ids(left)
    assert ids(left) - ids(done) == {310} and {301, 304, 312, 314} <= ids(done) - {r[0] for r in done if r in left}
    assert {300, 313, None, 502} <= {r[0] for r in done if r in left}


def test_each_stage(spark, folder):
    """Each is judged on its own input; all but the last give the columns of documents."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    steps = dict(corpus_pipeline.STAGES)
    want = made()
    for name, expected in (("quality_rules", good(folder)), ("near_copies", None), ("repeated_passages", None)):
        want = expected if expected is not None else (singles if name == "near_copies" else cut)(want)
        docs = steps[name](spark, spark.createDataFrame(docs.collect(), SCHEMA), folder)
        assert docs.columns == columns
        got = docs.collect()
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr), name


def test_the_whole(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    want = pieces(cut(singles(good(folder))))
    got = sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr)
    assert got == want
    sequences: dict = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in sequences.values():
        ends = np.cumsum([length for _, length in sorted(held)])
        assert [offset for offset, _ in sorted(held)] == [0, *ends[:-1].tolist()] and ends[-1] <= 4096
    assert len(sequences) == -(-sum(row[3] for row in want) // 4096)


def test_nothing_in_nothing_out(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_copies", "repeated_passages", "packed_sequences"]
