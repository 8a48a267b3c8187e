"""Token alignment against the two libraries run on whole texts."""

from __future__ import annotations

import collections
import hashlib

import numpy as np
import public_tokenizers
import pytest

from keytide.llm import alignment as A, queries
from keytide.llm.token_counts import byte_letters

FILES = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


def encoded(text):
    """Groups and links of one text, or None without tokens."""
    one, two, bytes_one, bytes_two = A._libraries(*FILES)
    if not text:
        return None
    x, y, want = one.encode(" " + text, add_special_tokens=False).ids, two.encode(text), (" " + text).encode()
    first, second = [bytes_one[i] for i in x], [bytes_two[i] for i in y]
    if b"".join(first) != want or b"".join(second) != want:
        return None
    _, i, j = np.intersect1d(np.cumsum([*map(len, first)]), np.cumsum([*map(len, second)]), return_indices=True)
    groups, low, down = [], 0, 0
    for p, q in zip(i, j):
        groups.append(",".join(map(str, x[low : p + 1])) + "|" + ",".join(map(str, y[down : q + 1])))
        low, down = p + 1, q + 1
    return len(x), len(y), groups, [(x[p], y[q]) for p, q in zip(i, j)]


def expected(texts):
    found = [encoded(text) for text in texts]
    count = collections.Counter(link for one in found if one for link in one[3])
    most = collections.Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    out = []
    for one in found:
        if one is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = one
        best, total = sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links)
        out.append((n_a, n_b, len(groups), len(links), best, total, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


def check(spark, texts):
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: tuple(r)[1:] for r in A.aligned(docs, *FILES).collect()}
    assert [got[i] for i in range(len(rows))] == expected(texts)


def test_bytes_of_ids():
    """The tables of bytes agree with what the vocabularies print."""
    letters = byte_letters()
    one, two, bytes_one, bytes_two = A._libraries(*FILES)
    assert len(letters) == 256 and bytes_one[one.token_to_id("Ġthe")] == b" the"
    assert bytes_two[two.piece_to_id("▁the")] == b" the" and bytes_two[two.piece_to_id("<0x0A>")] == b"\n"


def test_given_documents(spark, data):
    rows = queries.documents(spark, data).select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in queries.op13_token_alignment(spark, data).collect()}
    assert [got[r.doc_id] for r in rows] == expected([r.text for r in rows])


ODD = [
    None, "", " ", "   ", "a", " a", "a ", "a  b", "a \n b", "\n", "\ta b\r\n", "</s> <s> <unk> <|endoftext|> x", "<0x0A> y",
    "under▁score gone", "é" * 300, "ﬁ ligature ｆull　width", "x\u0000y z", "emoji 👩‍👩‍👧 ok", "I'm we've 'quoted' 12 345,6",
    " no break   line", "a\u0085b c\u001cd e", "same words same words", "same words same words", "Ĳ ĳ ß ſ",
]


def test_odd_texts(spark):
    check(spark, ODD)


def test_slices_units_and_containers_change_nothing(spark, monkeypatch):
    """Small bounds; a text that loses its tokens late must leave nothing behind."""
    long = " ".join(f"word{i % 7} and thing" for i in range(400))
    texts = [*ODD, long, long + " late▁loss", long + " end", "x" * 3000]
    monkeypatch.setattr(A, "SLICE", 64)
    monkeypatch.setattr(A, "MOST_UNITS", 5)
    units = A.Units(*FILES)
    held = A._Container(units)
    for number, text in enumerate(texts):
        held.take(number, text)
    _, message = held.packed()
    told = A.Postings(message)
    count = collections.Counter(x for one in map(encoded, texts) if one for x in one[3])
    links = dict(zip(((p // units.size_b, p % units.size_b) for p in told.pairs.tolist()), told.links().tolist()))
    assert links == dict(count)
    want = expected(texts)
    assert [digest.hexdigest() if digest else "" for digest in held.digests] == [row[-1] for row in want]


def test_bitmaps_hold_entries_of_any_density():
    draw = np.random.default_rng(2)
    docs = 1000
    entries = {(p, d): int(draw.integers(1, 9)) for p in range(50) for d in np.flatnonzero(draw.random(docs) < p / 60)}
    key = np.array([p * 7 << 16 | d for p, d in entries], np.int64)
    shuffled = draw.permutation(np.repeat(key, list(entries.values())))
    told = A.Postings(A.packed_postings(shuffled, np.ones(len(shuffled), np.int64), docs))
    held = sorted({p for p, _ in entries})
    assert told.pairs.tolist() == [7 * p for p in held] and any(len(p["dense"]) for p in told.planes)
    by_pair = [[n for (q, _), n in entries.items() if q == p] for p in held]
    assert told.documents().tolist() == [len(n) for n in by_pair] and told.links().tolist() == [sum(n) for n in by_pair]


def test_odd_rows(spark, odd, empty):
    got = A.aligned(odd, *FILES).collect()
    assert len(got) == odd.count() and sum(r.doc_id is None for r in got) == 2
    assert {r.groups_sha256 for r in got if r.doc_id in (3, 4)} == {""}
    one, other = (r for r in got if r.doc_id == 1)
    assert one == other and one.n_links > 0
    assert A.aligned(empty, *FILES).collect() == []


def test_pair_counts(spark):
    docs = spark.createDataFrame([(1, "to be or not to be"), (2, "to do")], "doc_id long, text string")
    size = A.pieces(FILES[1])
    rows = A.pair_counts(A.containers(docs, *FILES), size).collect()
    want = collections.Counter(x for text in ("to be or not to be", "to do") for x in encoded(text)[3])
    assert {(r.a, r.b): r.n_links for r in rows} == dict(want)
    two, _ = A._libraries(*FILES)[:2]
    to = next(r for r in rows if r.a == two.token_to_id("Ġto"))
    assert (to.n_docs, to.n_links, to.best) == (2, 3, True)


def test_groups_of_a_text():
    assert [",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in A.groups("Some words, here.", *FILES)] == encoded("Some words, here.")[2]
    assert A.groups("", *FILES) == [] and A.groups("x▁y", *FILES) == []


@pytest.mark.parametrize("text", ["ab " * 50_000, "x" * 200_000])
def test_long_texts(spark, text):
    check(spark, [text, "short"])
