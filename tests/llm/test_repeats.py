from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from keytide.llm import blocks, passages, queries, substrings
from keytide.llm.vectors import span_hashes, winnowed, word_spans

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LAST = 1 << 62


def brute(rows, size, symbols):
    """For each row the symbols and which of them go, window by window."""
    first: dict = {}
    held = [(LAST if i is None else i, symbols((t or "").encode())) for i, t in rows]
    for i, s in held:
        for j in range(len(s) - size + 1):
            key = s[j : j + size] if isinstance(s, bytes) else tuple(s[j : j + size])
            first[key] = min(first.get(key, LAST), i)
    out = []
    for i, s in held:
        gone = bytearray(len(s))
        for j in range(len(s) - size + 1):
            key = s[j : j + size] if isinstance(s, bytes) else tuple(s[j : j + size])
            if first[key] < i:
                gone[j : j + size] = b"\1" * size
        out.append((s, gone))
    return out


def want_bytes(rows, size=50):
    out = []
    for (i, _), (s, gone) in zip(rows, brute(rows, size, bytes)):
        kept = bytes(c for c, g in zip(s, gone) if not g)
        out.append((i, len(s), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def want_words(rows, size=13):
    out = []
    for (i, _), (s, gone) in zip(rows, brute(rows, size, WORD.findall)):
        kept = b" ".join(w for w, g in zip(s, gone) if not g)
        out.append((i, len(s), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def as_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def mixed_texts():
    """Documents that share stretches at random places, some just below and just at the window."""
    draw = random.Random(3)
    vocabulary = ["".join(draw.choices("abcdé", k=draw.randint(1, 6))) for _ in range(40)]
    shared = [" ".join(draw.choices(vocabulary, k=k)) for k in (12, 13, 14, 30, 60)]
    rows = []
    for i in range(120):
        parts = [" ".join(draw.choices(vocabulary, k=draw.randint(0, 30)))]
        for _ in range(draw.randint(0, 3)):
            parts += [draw.choice(shared), " ".join(draw.choices(vocabulary, k=draw.randint(0, 9)))]
        rows.append((i, draw.choice([" ", "\n", "  "]).join(parts)))
    rows += [(200 + i, "ab" * draw.randint(10, 200)) for i in range(10)]
    return rows


def test_bytes_equal_brute_force(spark, mixed_texts):
    docs = spark.createDataFrame(mixed_texts, "doc_id long, text string").repartition(5)
    assert as_rows(substrings.remove_repeats(docs)) == want_bytes(mixed_texts)


def test_words_equal_brute_force(spark, mixed_texts):
    docs = spark.createDataFrame(mixed_texts, "doc_id long, text string").repartition(5)
    assert as_rows(passages.remove_passages(docs)) == want_words(mixed_texts)


def test_registered_queries_equal_brute_force(spark, data):
    rows = [(r.doc_id, r.text) for r in queries.documents(spark, data).collect()]
    assert as_rows(queries.op1_suffix_dedup(spark, data)) == want_bytes(rows)
    assert as_rows(queries.op9_substring_dedup(spark, data)) == want_words(rows)


@pytest.mark.parametrize("broadcast", [48 << 20, -1], ids=["replies-broadcast", "replies-shuffled"])
def test_small_blocks_and_slices_agree(spark, mixed_texts, monkeypatch, broadcast):
    from keytide.llm import blocks

    monkeypatch.setattr(blocks, "BROADCAST_BYTES", broadcast)
    monkeypatch.setattr(blocks, "LEAST_BYTES", 2000)
    monkeypatch.setattr(blocks, "MESSAGE_KEYS", 0)
    docs = spark.createDataFrame(mixed_texts, "doc_id long, text string").repartition(3)
    assert as_rows(substrings.remove_repeats(docs)) == want_bytes(mixed_texts)
    assert as_rows(passages.remove_passages(docs)) == want_words(mixed_texts)


def test_odd_rows(spark, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert as_rows(substrings.remove_repeats(odd)) == want_bytes(rows)
    assert as_rows(passages.remove_passages(odd)) == want_words(rows)
    assert substrings.remove_repeats(empty).count() == 0
    assert passages.remove_passages(empty).count() == 0


def test_cleaned_keeps_columns_and_untouched_texts(spark, odd):
    got = passages.cleaned(odd, window=50, length_col="n_chars")
    assert got.columns == odd.columns
    rows = got.collect()
    first = [r for r in rows if r.doc_id == 1]
    assert len(first) == 2 and all(r.text.startswith("word0 word1") and r.kept == "x" for r in first)
    assert not [r for r in rows if r.doc_id is None and r.text]  # a copy with nothing left goes
    assert [r.text for r in rows if r.doc_id == 7] == [" \n\t "]


def test_suffix_sort_orders_suffixes():
    draw = np.random.default_rng(5)
    buffer = draw.integers(97, 99, 4000).astype(np.uint8)
    start = np.sort(draw.choice(3900, 700, replace=False))
    length = draw.integers(1, 60, 700)
    group = draw.integers(0, 9, 700)
    made = substrings.Suffixes(buffer, start, length, substrings.BASES[0])
    order, raw = made.sort(group), buffer.tobytes()
    keys = [(group[i], raw[start[i] : start[i] + length[i]]) for i in order]
    assert keys == sorted(keys)
    shares = made.agreement(order, group)
    for k in range(1, len(order)):
        a, b = keys[k - 1], keys[k]
        same = next((j for j, (x, y) in enumerate(zip(a[1], b[1])) if x != y), min(len(a[1]), len(b[1])))
        assert shares[k] == (same if a[0] == b[0] else -1)


def test_a_collision_is_seen():
    buffer = np.frombuffer(b"abcabd", np.uint8)
    made = substrings.Suffixes(buffer, np.array([0, 3]), np.array([3, 3]), substrings.BASES[0])
    made.prefixes.sums[:] = 0  # every hash equal
    assert made.agreement(np.array([0, 1]), np.array([0, 0])) is None


def test_windows_select_alike_across_slices(monkeypatch):
    from keytide.llm import vectors

    draw = np.random.default_rng(1)
    values = draw.integers(0, 2**63, 3000).astype(np.uint64)
    bounds = np.array([0, 0, 700, 705, 3000])
    whole = winnowed(values, bounds, 13, 5)
    monkeypatch.setattr(vectors, "SLICE", 100)
    cut = winnowed(values, bounds, 13, 5)

    def windows(found):
        return [(w, p, h) for a, b, p, h, _ in zip(*(x.tolist() for x in found)) for w in range(a, b + 1)]

    assert windows(whole) == windows(cut)
    assert len(windows(whole)) == 688 + 2283


def test_span_hashes_do_not_depend_on_place():
    text = b"ab  cd ab\tcd" + b" " * 50 + b"x" * 100 + b"\ncd"
    buffer = np.frombuffer(text, np.uint8)
    starts, ends = word_spans(buffer)
    words = [text[a:b] for a, b in zip(starts, ends)]
    assert words == WORD.findall(text)
    by_word: dict = {}
    for word, value in zip(words, span_hashes(buffer, starts, ends).tolist()):
        assert by_word.setdefault(word, value) == value
    assert len(set(by_word.values())) == len(by_word)


def test_answering_holds_little_beside_the_messages():
    """A bucket's stretches are worked on a few shares at a time, and told in one array."""
    import tracemalloc

    from keytide.llm import blocks, repeats

    draw = np.random.default_rng(2)
    size, many = 70, 60_000
    texts = draw.integers(97, 123, (many, size), dtype=np.uint8)
    texts[1::2] = texts[::2]  # each stretch in two documents
    message = blocks.packed(
        ids=np.arange(many), sizes=np.full(many, size, np.uint32), offsets=np.full(many, 20, np.uint16),
        shares=np.repeat(draw.integers(0, 256, many // 2).astype(np.uint8), 2), bytes=texts.ravel(),
    )
    answer = repeats._stretches_answered(repeats.Method(50, 16, substrings._read, substrings._compare))
    answer([message])  # powers are kept between calls
    tracemalloc.start()
    flags = np.unpackbits(np.frombuffer(answer([message])[0], np.uint8)).reshape(many, size - 49)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert flags[1::2].all() and not flags[::2].any()
    assert peak < 60 << 20, peak


def test_a_message_of_few_keys_is_small():
    """Every block sends every bucket a message, so what each costs beside its arrays counts."""
    held = {
        "ids": np.arange(5) * 977,
        "sizes": np.full(5, 80, np.uint32),
        "offsets": np.arange(5, dtype=np.uint16),
        "flags": np.arange(5, dtype=np.uint8),
        "none": np.zeros(0, np.int64),
    }
    message = blocks.packed(**held)
    told = blocks.unpacked(message)
    assert len(message) < 250
    assert list(told) == list(held) and all(told[k].dtype == v.dtype and np.array_equal(told[k], v) for k, v in held.items())
