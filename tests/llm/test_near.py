from __future__ import annotations

import random
import re
import tempfile
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from keytide.llm import ngram_join, queries
from keytide.llm.components import components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def brute(rows, words, per, of=100):
    """(doc_id, n_shingles, component_id) of every row, all pairs compared."""
    sets = []
    for _, text in rows:
        held = WORD.findall((text or "").encode().translate(LOWER))
        sets.append({tuple(held[j : j + words]) for j in range(max(len(held) - words + 1, min(1, len(held))))})
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    at: dict = {}
    for i, s in enumerate(sets):
        for shingle in s:
            at.setdefault(shingle, []).append(i)
    overlap = Counter((a, b) for held in at.values() for k, b in enumerate(held) for a in held[:k])
    for (a, b), shared in overlap.items():
        if of * shared >= per * (len(sets[a]) + len(sets[b]) - shared):
            root[find(b)] = find(a)
    least: dict = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return sorted(((key, len(s), least.get(find(i)) if s else key) for i, ((key, _), s) in enumerate(zip(rows, sets))), key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def families():
    """Chains of ever more edited copies, around the threshold on either side, of many sizes."""
    draw = random.Random(11)
    rows, key = [], 0
    for size in (1, 2, 3, 4, 6, 9, 14, 25, 60, 200, 700):
        base = [f"w{draw.randrange(5000)}" for _ in range(size)]
        for _ in range(14):
            copy = list(base)
            for _ in range(draw.randrange(0, 2 + size // 25)):
                copy[draw.randrange(size)] = f"x{draw.randrange(5000)}"
            if draw.random() < 0.3:
                copy += [f"y{draw.randrange(5000)}" for _ in range(draw.randrange(1 + size // 12))]
            if draw.random() < 0.3:
                base = copy
            rows.append((key, " ".join(copy).upper() if draw.random() < 0.2 else "  ".join(copy)))
            key += 1
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize(("words", "per"), [(3, 90), (5, 80), (1, 50)])
def test_components_equal_brute_force(spark, families, words, per):
    docs = spark.createDataFrame(families, "doc_id long, text string").repartition(4)
    assert got(ngram_join.near_documents(docs, words=words, per=per)) == brute(families, words, per)


def test_registered_query_equals_brute_force(spark, data):
    rows = [(r.doc_id, r.text) for r in queries.documents(spark, data).collect()]
    assert got(queries.op2_ngram_join(spark, data)) == brute(rows, 3, 90)


def test_odd_rows(spark, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert got(ngram_join.near_documents(odd, words=3, per=90)) == brute(rows, 3, 90)
    assert ngram_join.near_documents(empty).count() == 0


def test_one_of_each_group_stays(spark, odd, empty):
    rows = ngram_join.without_copies(odd).collect()
    assert rows[0].asDict().keys() == set(odd.columns)
    assert sorted((r.doc_id for r in rows), key=repr) == sorted([1, 3, 4, None, 6, 7, 8], key=repr)  # 9 says 1 twice
    assert ngram_join.without_copies(empty).count() == 0


def test_chains_and_stars_are_one_component(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 150), (150, 200)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 150: 150, 200: 150}


def test_sizes_pair_within_a_class_or_the_next():
    for per, of in ((90, 100), (80, 100), (50, 100)):
        ends = ngram_join.size_classes(5000, per, of)
        own = lambda n: next(i for i, e in enumerate(ends) if n <= e)
        assert all(own(min(n * of // per, 5000)) - own(n) <= 1 for n in range(1, 5001))


def test_classes_do_not_depend_on_the_largest_set():
    for per, of in ((90, 100), (95, 100), (80, 100), (50, 100)):
        ends = ngram_join.size_classes(30_000, per, of)
        for most in (1, 5, 50, 95, 97, 98, 457, 5000, 20_218):
            held = ngram_join.size_classes(most, per, of)
            assert held.tolist() == ends[: len(held)].tolist() and held[-2] >= most


def test_pairs_across_a_class_end_link_from_separate_partitions(spark):
    rows = []
    for key, (size, more) in enumerate([(95, 5), (450, 20), (20_000, 500)]):
        text = [f"w{key}x{i}" for i in range(size)]
        rows.append((2 * key, " ".join(text)))
        rows.append((2 * key + 1, " ".join(text + [f"y{key}x{i}" for i in range(more)])))
    # A partition for each row, so that the classes worked out there end with that row's set.
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, len(rows)), "doc_id long, text string")
    found = got(ngram_join.near_documents(docs, words=1, per=90))
    assert found == brute(rows, 1, 90)
    assert all(component == key - key % 2 for key, _, component in found)


@pytest.mark.parametrize(("leaders", "tile"), [(0, 5), (0, 2048), (1, 7)])
def test_families_in_tiles_equal_brute_force(spark, families, monkeypatch, leaders, tile):
    """Everything, or all but one leader a block, is left to the tiles."""
    monkeypatch.setattr(ngram_join, "LEADER_ROUNDS", leaders)
    monkeypatch.setattr(ngram_join, "TILE_SETS", tile)
    docs = spark.createDataFrame(families, "doc_id long, text string").repartition(4)
    assert got(ngram_join.near_documents(docs, words=3, per=90)) == brute(families, 3, 90)


def test_large_group_of_copies_around_the_threshold(spark):
    draw = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for key in range(300):
        copy = list(base)
        for place in draw.sample(range(120), draw.randrange(2, 8)):
            copy[place] = f"x{draw.randrange(10**6)}"
        rows.append((key, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = got(ngram_join.near_documents(docs, words=1, per=90))
    assert found == brute(rows, 1, 90) and 1 < len({component for _, _, component in found}) < 300


def test_tiles_get_the_ngrams_of_sets_in_reach_only(spark, monkeypatch):
    """Unrelated texts share a word and so parts; of them, only sizes and parities go to the tiles."""
    rows = [(key, " ".join(["common"] + [f"w{key}x{i}" for i in range(40)])) for key in range(60)]
    rows += [(100 + key, " ".join(text.split()[:38] + ["a", "b", "c"])) for key, text in rows[:4]]
    asked, whole = [], ngram_join._family_links

    def told(left, traits, hashes, per, of):
        def spied(nodes):
            asked.append((left.select("node").distinct().count(), nodes.distinct().count()))
            return hashes(nodes)

        return whole(left, traits, spied, per, of)

    monkeypatch.setattr(ngram_join, "_family_links", told)
    monkeypatch.setattr(ngram_join, "LEADER_ROUNDS", 0)
    monkeypatch.setattr(ngram_join, "TILE_SETS", 9)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(ngram_join.near_documents(docs, words=1, per=50)) == brute(rows, 1, 50)
    assert len(asked) == 1 and asked[0][0] > 16 and asked[0][1] == 8


def test_parts_go_to_buckets_in_messages(spark, families, monkeypatch):
    """No row for each part of each set is grouped or shuffled to find the parts that sets share."""
    plans, write = {}, ngram_join.written_table

    def spied(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(ngram_join, "written_table", spied)
    docs = spark.createDataFrame(families, "doc_id long, text string").repartition(4)
    assert got(ngram_join.near_documents(docs, words=5, per=80)) == brute(families, 5, 80)
    assert "Aggregate" not in plans["blocks"] and "message" in plans["blocks"]


def test_a_part_costs_a_message_two_sets_at_most():
    rows = pd.DataFrame({"part": [7] * 50 + [9, 9, 8, -8], "node": [*range(50), 3, 3, -4, 5]})
    part, low, high = ngram_join._ends(rows["part"].to_numpy(), rows["node"].to_numpy())
    assert (part.tolist(), low.tolist(), high.tolist()) == ([-8, 7, 8, 9], [5, 0, -4, 3], [5, 49, -4, 3])
    told = [np.stack([part, low]).tobytes(), np.array([[9, 8], [3, -9]]).tobytes(), np.array([[7], [0]]).tobytes()]
    met = ngram_join._met(pd.DataFrame({"message": told}))
    assert met.to_dict("list") == {"part": [8], "leader": [-9]}


def overlapping(n: int, width: int) -> list[tuple]:
    """Texts of which each shares some words with the next ones only; all parts lead to one family, and none link."""
    return [(key, " ".join(f"w{5 * key + i}" for i in range(width))) for key in range(n)]


def test_sizes_and_parities_go_to_blocks_where_tiles_would_be_more(spark, monkeypatch, tmp_path):
    """What is compared follows the parts of the sets left apart, not the square of their number."""
    met, whole = {}, ngram_join._tile_reach

    def counting(folder):
        def made(per, of):
            reach = whole(per, of)

            def told(rows):
                with open(tempfile.mkstemp(dir=folder)[1], "w") as file:
                    file.write(str(len(rows)))
                return reach(rows)

            return told

        return made

    monkeypatch.setattr(ngram_join, "LEADER_ROUNDS", 0)
    monkeypatch.setattr(ngram_join, "TILE_SETS", 4)
    for n in (60, 240):
        folder = tmp_path / str(n)
        folder.mkdir()
        monkeypatch.setattr(ngram_join, "_tile_reach", counting(str(folder)))
        rows = overlapping(n, 25)
        rows += [(1000 + key, f"{text} z") for key, text in rows[::9]]
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        assert got(ngram_join.near_documents(docs, words=1, per=80)) == brute(rows, 1, 80)
        met[n] = sum(int(file.read_text()) for file in folder.iterdir())
    assert 0 < met[240] < 6 * met[60]


def test_no_join_after_rows_are_repeated_for_tiles(spark, families, monkeypatch):
    """Spark sizes exploded rows by those before, and would broadcast them."""
    plans, write = {}, ngram_join.written_table

    def spied(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(ngram_join, "written_table", spied)
    monkeypatch.setattr(ngram_join, "LEADER_ROUNDS", 0)
    docs = spark.createDataFrame(families, "doc_id long, text string").repartition(4)
    ngram_join.near_documents(docs, words=3, per=90)
    for name in ("reach", "links"):
        above = plans[name].partition("Generate explode")
        assert above[1] and "Join" not in above[0], name
        assert "leftHint" in above[2] or "rightHint" in above[2] or "strategy=merge" in above[2]
