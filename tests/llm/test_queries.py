"""The registered queries against their SQL, and against the libraries where SQL cannot say them."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest

from keytide.llm import queries
from tests.compare import database, differences


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, data, name):
    base = database(data, ("documents", "pages", "conversations", "embeddings"))
    assert differences(queries.QUERIES[name](spark, data), base, queries.ORACLES[name]) == []


@pytest.fixture(scope="module")
def texts(spark, data):
    return sorted((r.doc_id, r.text or "") for r in queries.documents(spark, data).collect())


def test_pieces_equal_library(spark, data, texts):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r.doc_id: r for r in queries.op3_pieces(spark, data).collect()}
    for key, text in texts:
        ids = model.encode(text)
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert (got[key].n_pieces, got[key].ids_sha256, got[key].round_trip) == (len(ids), digest, True)


def test_token_counts_equal_library(spark, data, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.doc_id: r for r in queries.op8_token_counts(spark, data).collect()}
    for key, text in texts:
        n, size = len(library.encode(text, add_special_tokens=False).ids), len(text.encode())
        row = got[key]
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (size, n, n > 1024)
        assert row.fitting_bytes == size if n <= 1024 else row.fitting_bytes < size


def test_packing_is_whole_and_tight(spark, data, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = queries.op10_best_fit(spark, data).collect()
    want = {}
    for key, text in texts:
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 1], "<u4")
        for piece, low in enumerate(range(0, len(ids), 4096)):
            part = ids[low : low + 4096]
            want[key, piece] = (low, len(part), zlib.crc32(part.tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want
    assert len(rows) == len(want)
    sequences: dict = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in sequences.values():
        held.sort()
        ends = np.cumsum([length for _, length in held])
        assert [offset for offset, _ in held] == [0, *ends[:-1].tolist()] and ends[-1] <= 4096
    assert len(sequences) == -(-sum(r.length for r in rows) // 4096)


def test_fingerprints_rank_edits_before_strangers(spark, data, texts):
    got = {r.doc_id: r for r in queries.op4_fingerprints(spark, data).collect()}
    by_text: dict = {}
    for (key, text), (_, after) in zip(texts, texts[1:] + texts[:1]):
        row, half = got[key], len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert 0 <= row.near_next < row.near_edited <= 1
        assert by_text.setdefault(text, row.fingerprint) == row.fingerprint
