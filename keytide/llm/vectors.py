"""Whole-array text helpers: words, polynomial prefix hashes, winnowed windows.

Hashes are sums of random 64-bit symbol values times powers of an odd base, modulo 2^64. The
powers have inverses, so the hash of any stretch follows from two prefix sums.
"""

from __future__ import annotations

import numpy as np

SLICE = 1 << 16  # symbols worked on at a time: arrays that fit the cache, whatever a text's length
BASE = 0x9E3779B97F4A7C15
BYTE_VALUES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

_powers: dict[int, np.ndarray] = {}


def powers(n: int, base: int = BASE) -> np.ndarray:
    """base^0 .. base^(n-1), kept between calls."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(n, SLICE + 1024)
        known = np.full(size, base, np.uint64)
        known[0] = 1
        known = _powers[base] = np.multiply.accumulate(known)
    return known[:n]


def inverse(base: int = BASE) -> int:
    return pow(base, -1, 1 << 64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread all bits of a hash over all bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class Prefixes:
    """Prefix hashes of an array of symbol values."""

    def __init__(self, values: np.ndarray, base: int = BASE):
        n = len(values)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * powers(n, base), out=self.sums[1:])
        self.back = powers(n + 1, inverse(base))

    def of(self, start, end) -> np.ndarray:
        """Hash of values[start:end], wherever it stands."""
        return (self.sums[end] - self.sums[start]) * self.back[start]


def word_spans(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes other than space and tab to carriage return."""
    inside = np.zeros(len(buffer) + 2, np.int8)
    inside[1:-1] = ~_IS_SPACE[buffer]
    change = np.diff(inside)
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def span_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; spans are in order and do not overlap."""
    out, done = np.empty(len(starts), np.uint64), 0
    while done < len(starts):
        low = int(starts[done])
        upto = max(done + 1, int(np.searchsorted(ends, low + SLICE, "right")))
        high = int(ends[upto - 1])
        if high - low <= 2 * SLICE:
            sums = Prefixes(BYTE_VALUES[buffer[low:high]])
            out[done:upto] = sums.of(starts[done:upto] - low, ends[done:upto] - low)
        else:  # one span of enormous length, by pieces
            value = 0
            for at in range(low, high, SLICE):
                piece = Prefixes(BYTE_VALUES[buffer[at : min(at + SLICE, high)]])
                value = (value * 0x100000001B3 + int(piece.sums[-1])) % (1 << 64)
            out[done] = value
        done = upto
    return mixed(out + (ends - starts).astype(np.uint64))


def joined(texts: list[bytes], separator: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
    """One buffer of all texts, and where each begins (one entry more than texts)."""
    sizes = np.fromiter((len(t) + len(separator) for t in texts), np.int64, len(texts))
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    return np.frombuffer(separator.join([*texts, b""]) if texts else b"", np.uint8), bounds


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buffer, word starts, word ends, word hashes, and the first word of each text (one entry more)."""
    buffer, bounds = joined(texts, b"\n")
    starts, ends = word_spans(buffer)
    return buffer, starts, ends, span_hashes(buffer, starts, ends), np.searchsorted(starts, bounds)


def winnowed(values: np.ndarray, bounds: np.ndarray, window: int, seed: int):
    """The windows of every document, grouped by the seed that each selects.

    Each window of ``window`` symbols selects its seed of ``seed`` symbols with the least hash
    (the first of equals), so equal windows select the same place. Windows in a row that select
    the same seed make a run. Returns arrays: first window, last window, seed position, seed hash,
    hash of all symbols of the run. A long run may come in pieces.
    """
    parts, n = [], len(values)
    document = np.repeat(np.arange(len(bounds) - 1, dtype=np.int32), np.diff(bounds))
    step, reach = max(SLICE - window + 1, window), window - seed + 1
    for low in range(0, max(n - window + 1, 0), step):
        high = min(low + step + window - 1, n)
        part, owner = values[low:high], document[low:high]
        sums = Prefixes(part)
        places = np.arange(len(part) - seed + 1)
        hashes = mixed(sums.of(places, places + seed))
        bits = np.uint64(max(len(part), 2).bit_length())
        least = ((hashes >> bits) << bits) | places.astype(np.uint64)
        count, span = len(part) - window + 1, 1
        while span * 2 <= reach:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        rest = reach - span
        least = np.minimum(least[:count], least[rest : rest + count])
        chosen = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        whole = owner[:count] == owner[window - 1 :]
        fresh = np.ones(count, bool)
        fresh[1:] = (chosen[1:] != chosen[:-1]) | (whole[1:] != whole[:-1])
        first = np.flatnonzero(fresh)
        last = np.append(first[1:], count) - 1
        first, last = first[whole[first]], last[whole[first]]
        at = chosen[first]
        whole_run = mixed(sums.of(first, last + window) + (last - first).astype(np.uint64))
        parts.append((first + low, last + low, at + low, hashes[at], whole_run))
    if not parts:
        none, blank = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        return none, none, none, blank, blank
    return tuple(np.concatenate(column) for column in zip(*parts))


def covered(length: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Which of ``length`` places lie in one of the closed stretches first..last."""
    change = np.zeros(length + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, last + 1, -1)
    return np.cumsum(change[:-1]) > 0
