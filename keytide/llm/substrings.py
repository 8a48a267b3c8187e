"""Suffix-array dedup: bytes covered by a string that also starts in an earlier document.

Suffixes are compared by hashes of their prefixes: a binary search over the length finds how far
two agree, so a comparison takes a logarithmic number of steps, and a mergesort over all groups
at once orders them. Neighbours are then compared byte by byte, which rules collisions out.

Sorting every suffix of the corpus would move many times its size. Only the suffixes at the seeds
that windows select (``repeats``) are sorted, forwards and backwards; a window that reaches ``o``
bytes back from its seed equals another exactly if their backward suffixes agree over ``o`` bytes and the
forward ones over the rest.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from keytide.llm import blocks as B
from keytide.llm.repeats import Method, Symbols, cut, gathered
from keytide.llm.vectors import BASE, BYTE_VALUES, Prefixes, covered, joined

WINDOW, SEED = 50, 16
BASES = (BASE, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
NONE = np.zeros(0, np.int64)


class Suffixes:
    """Stretches of a buffer that begin at given places and have given lengths."""

    def __init__(self, buffer: np.ndarray, start: np.ndarray, length: np.ndarray, base: int):
        self.buffer, self.start, self.length = buffer, start, length
        self.prefixes = Prefixes(BYTE_VALUES[buffer], base)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many first bytes the suffixes a[i] and b[i] share."""
        x, y = self.start[a], self.start[b]
        low, high = np.zeros(len(a), np.int64), np.minimum(self.length[a], self.length[b])
        for _ in range(int(high.max(initial=0)).bit_length()):
            middle = (low + high + 1) >> 1
            same = self.prefixes.of(x, x + middle) == self.prefixes.of(y, y + middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def less(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        shared = self.common(a, b)
        last = len(self.buffer) - 1
        in_a, in_b = shared < self.length[a], shared < self.length[b]
        at_a = np.where(in_a, self.buffer[np.minimum(self.start[a] + shared, last)].astype(np.int16), -1)
        at_b = np.where(in_b, self.buffer[np.minimum(self.start[b] + shared, last)].astype(np.int16), -1)
        return at_a < at_b

    def sort(self, group: np.ndarray) -> np.ndarray:
        """Order by group and then by suffix: a bottom-up mergesort of all groups together."""
        order = np.argsort(group, kind="stable")
        ranked = group[order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = ranked[1:] != ranked[:-1]
        starts = np.flatnonzero(fresh)
        sizes = np.diff(np.append(starts, len(order)))
        start, size = np.repeat(starts, sizes), np.repeat(sizes, sizes)
        run = 1
        while run < int(sizes.max(initial=0)):
            places = np.flatnonzero(size > run)
            base, within = start[places], places - start[places]
            number = within // run
            low = np.minimum((number ^ 1) * run, size[places])
            high = np.minimum(low + run, size[places])
            sibling, right = low.copy(), number % 2 == 1
            own = order[places]
            while (open_ := np.flatnonzero(low < high)).size:
                middle = (low[open_] + high[open_]) >> 1
                other = order[base[open_] + middle]
                mine, late = own[open_], right[open_]
                first, second = np.where(late, mine, other), np.where(late, other, mine)
                before = self.less(first, second) != late  # other < mine, or other <= mine from the right
                low[open_] = np.where(before, middle + 1, low[open_])
                high[open_] = np.where(before, high[open_], middle)
            moved = order.copy()
            moved[base + (number // 2) * 2 * run + (within - number * run) + (low - sibling)] = own
            order, run = moved, run * 2
        return order

    def agreement(self, order: np.ndarray, group: np.ndarray) -> np.ndarray | None:
        """What each suffix shares with the one before it (-1 in a new group); None on a collision."""
        a, b = order[:-1], order[1:]
        shared = self.common(a, b)
        left = gathered(self.buffer, self.start[a], shared)
        right = gathered(self.buffer, self.start[b], shared)
        if not np.array_equal(left, right):
            return None
        shared[group[a] != group[b]] = -1
        return np.append(-1, shared) if len(order) else NONE


def _compare(symbols: Symbols, ids: np.ndarray, offsets: np.ndarray, window: int, seed: int) -> np.ndarray:
    """Flag every window of the stretches that starts in a document with a smaller id."""
    buffer, bounds = symbols.buffer, symbols.bounds
    begin, end = bounds[:-1], bounds[1:]
    at = begin + offsets
    for base in BASES:
        forward = Suffixes(buffer, at, end - at, base)
        group = np.unique(forward.prefixes.of(at, at + seed), return_inverse=True)[1]
        backward = Suffixes(buffer[::-1], len(buffer) - at, at - begin, base)
        orders = forward.sort(group), backward.sort(group)
        shares = forward.agreement(orders[0], group), backward.agreement(orders[1], group)
        if shares[0] is not None and shares[1] is not None:
            break
    else:
        raise RuntimeError("every base gave colliding hashes")
    first_window = np.concatenate([[0], np.cumsum(end - begin - window + 1)])
    flags = np.zeros(first_window[-1], bool)
    for back in range(window - seed + 1):
        active = np.flatnonzero((at - back >= begin) & (at - back + window <= end))
        if not len(active):
            continue
        classes = []
        for order, share, length in zip(orders, shares, (window - back, back)):
            named = np.empty(len(order), np.int64)
            named[order] = np.cumsum(share < length)
            classes.append(named)
        key = (classes[0] * (len(ids) + 1) + classes[1])[active]
        order = np.argsort(key, kind="stable")
        fresh = np.ones(len(order), bool)
        fresh[1:] = key[order][1:] != key[order][:-1]
        owner = ids[active][order]
        least = np.minimum.reduceat(owner, np.flatnonzero(fresh))[np.cumsum(fresh) - 1]
        hit = active[order[owner > least]]
        flags[first_window[hit] + offsets[hit] - back] = True
    return flags


def _read(texts: list[bytes]) -> Symbols:
    buffer, bounds = joined(texts)
    return Symbols(buffer, NONE, NONE, BYTE_VALUES[buffer], bounds)


def _finish(window: int, keep_text: bool):
    def rows(block: B.Block, symbols: Symbols, first: np.ndarray, last: np.ndarray) -> pa.RecordBatch:
        gone = covered(len(symbols.buffer), first, last + window - 1)
        fresh = gone.copy()
        fresh[1:] &= ~gone[:-1]
        inner = symbols.bounds[:-1][np.diff(symbols.bounds) > 0]
        fresh[inner] |= gone[inner]
        removed = np.concatenate([[0], np.cumsum(gone)])[symbols.bounds]
        spans = np.concatenate([[0], np.cumsum(fresh)])[symbols.bounds]
        kept = symbols.buffer[~gone].tobytes()
        upto = (symbols.bounds - removed).tolist()
        texts = [kept[a:b] for a, b in zip(upto[:-1], upto[1:])]
        columns = {
            "doc_id": block.table["id"].combine_chunks(),
            "n_bytes": np.diff(symbols.bounds),
            "n_removed": np.diff(removed),
            "n_spans": np.diff(spans),
            "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
        }
        return pa.RecordBatch.from_pydict(columns | ({"kept": pa.array(texts, pa.binary())} if keep_text else {}))

    return rows


def remove_repeats(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, keep_text: bool = False
) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and ``kept``, the bytes that stay).

    A byte goes if a ``window``-byte string that covers it also starts in a document with a smaller
    id. A null text is empty. A null id is larger than any other and stays null; rows that share an id do not
    shorten each other. Other columns of ``docs`` are not looked at. Empty tables give no rows. ``window`` must
    exceed 16 bytes.
    """
    if window <= SEED:
        raise ValueError(f"window must exceed {SEED}")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    schema += ", kept binary" if keep_text else ""
    return cut(docs, Method(window, SEED, _read, _compare), _finish(window, keep_text), schema, id_col, text_col)
