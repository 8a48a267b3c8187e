"""Substring dedup by winnowed seeds: words of passages that also start in an earlier document.

Documents meet on winnowed anchors of a few words (``repeats``). Matches are not extended word by word: for every place
that a shared anchor can have in a window, the windows are hashed and grouped, and equal hashes compared word by word.
Windows found in an earlier document join up to maximal repeats of at least the window's length.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from keytide.llm import blocks as B
from keytide.llm.repeats import Method, Symbols, cut
from keytide.llm.vectors import Prefixes, covered, mixed, words_of

WINDOW, SEED = 13, 5


def _read(texts: list[bytes]) -> Symbols:
    buffer, starts, ends, values, bounds = words_of(texts)
    return Symbols(buffer, starts, ends, values, bounds)


def _compare(symbols: Symbols, ids: np.ndarray, offsets: np.ndarray, window: int, seed: int) -> np.ndarray:
    """Flag every window of the stretches that starts in a document with a smaller id.

    For each reach ``back`` to the left of the anchor, stretches with the same words from there to the
    window's end are one class; every member is held against the words of the class's first.
    """
    values, bounds = symbols.values, symbols.bounds
    begin, end = bounds[:-1], bounds[1:]
    at, sums = begin + offsets, Prefixes(values)
    first_window = np.concatenate([[0], np.cumsum(end - begin - window + 1)])
    flags = np.zeros(first_window[-1], bool)
    for back in range(window - seed + 1):
        active = np.flatnonzero((at - back >= begin) & (at - back + window <= end))
        if not len(active):
            continue
        start = at[active] - back
        key = mixed(sums.of(start, start + window))
        order = np.lexsort((ids[active], key))
        fresh = np.ones(len(order), bool)
        fresh[1:] = key[order][1:] != key[order][:-1]
        head = order[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
        for step in range(window):
            if not np.array_equal(values[start[order] + step], values[start[head] + step]):
                raise RuntimeError("two passages share a hash")
        hit = active[order[ids[active][order] > ids[active][head]]]
        flags[first_window[hit] + offsets[hit] - back] = True
    return flags


def _finish(window: int, keep_text: bool):
    def rows(block: B.Block, symbols: Symbols, first: np.ndarray, last: np.ndarray) -> pa.RecordBatch:
        gone = covered(len(symbols.starts), first, last + window - 1)
        removed = np.concatenate([[0], np.cumsum(gone)])[symbols.bounds]
        raw, texts = symbols.buffer.tobytes(), []
        starts, ends = symbols.starts[~gone].tolist(), symbols.ends[~gone].tolist()
        upto = (symbols.bounds - removed).tolist()
        for low, high in zip(upto[:-1], upto[1:]):
            texts.append(b" ".join([raw[a:b] for a, b in zip(starts[low:high], ends[low:high])]))
        columns = {
            "doc_id": block.table["id"].combine_chunks(),
            "n_words": np.diff(symbols.bounds),
            "n_removed": np.diff(removed),
            "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
        }
        return pa.RecordBatch.from_pydict(columns | ({"kept": pa.array([t.decode() for t in texts])} if keep_text else {}))

    return rows


def remove_passages(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, keep_text: bool = False
) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256 (and ``kept``, the words that stay, joined by a space).

    A word goes if ``window`` consecutive words that cover it also start in a document with a smaller id.
    Words are runs of bytes other than space and tab to carriage return. A null text has none. A null id
    is larger than any other and stays null; rows that share an id do not shorten each other. Other columns of
    ``docs`` are not looked at. Empty tables give no rows. ``window`` must exceed 5 words.
    """
    if window <= SEED:
        raise ValueError(f"window must exceed {SEED}")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    schema += ", kept string" if keep_text else ""
    return cut(docs, Method(window, SEED, _read, _compare), _finish(window, keep_text), schema, id_col, text_col)


def cleaned(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    length_col: str | None = None,
) -> DataFrame:
    """``docs`` with the repeated words cut out of their texts, all other columns as they are.

    A text that loses nothing stays as it is, spaces and all; what is left of another is its stretches of kept words,
    a line each, and ``length_col`` (if given) is its new length. Documents that lose all their words go.
    """
    names = docs.columns
    text_at, length_at = names.index(text_col), names.index(length_col) if length_col else None

    def rows(block: B.Block, symbols: Symbols, first: np.ndarray, last: np.ndarray) -> pa.RecordBatch:
        gone = covered(len(symbols.starts), first, last + window - 1)
        upto, raw = symbols.bounds.tolist(), symbols.buffer.tobytes()
        removed = np.concatenate([[0], np.cumsum(gone)])[symbols.bounds]
        lost, words = np.diff(removed), np.diff(symbols.bounds)
        columns = [block.table[f"c{i}"].combine_chunks() for i in range(len(names))]
        texts = columns[text_at].to_pylist()
        for i in np.flatnonzero(lost).tolist():
            own = np.flatnonzero(~gone[upto[i] : upto[i + 1]]) + upto[i]
            breaks = np.flatnonzero(np.diff(own) > 1) + 1
            parts = [(run[0], run[-1]) for run in np.split(own, breaks) if len(run)]
            texts[i] = "\n".join(raw[symbols.starts[a] : symbols.ends[b]].decode() for a, b in parts)
        if length_at is not None:
            sizes = columns[length_at].to_pylist()
            for i in np.flatnonzero(lost).tolist():
                sizes[i] = len(texts[i])
            columns[length_at] = pa.array(sizes, columns[length_at].type)
        columns[text_at] = pa.array(texts, columns[text_at].type)
        return pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array((lost == 0) | (lost < words)))

    return cut(docs, Method(window, SEED, _read, _compare), rows, docs.schema, id_col, text_col, carry=names)
