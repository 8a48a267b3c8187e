"""Token counts of every prefix of a text under byte-level BPE, by prefix dynamic programming.

Within a pre-token, the encoding of each prefix ends in exactly one token that is compatible with the
encoding before it: undoing the merges of both on either side of the joint finds no merge across the joint that
would have come first. So the last token and the count of every prefix follow from those of shorter
prefixes. Pre-tokens are worked on together, one column of prefixes at a time, each distinct one
once per batch. Whole texts add up; a budget is answered from the stored counts without encoding again.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F

from keytide.llm.vectors import BYTE_VALUES, inverse, mixed, powers

PIECE_BYTES = 4 << 20
LIMIT = 1024
LONG = 256  # longer pre-tokens are done one by one
# Fixed value: how the vocabulary's pre-tokenizer cuts a text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NO_TOKEN = -1


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class _Table:
    """From 64-bit keys to numbers, a few array reads each."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(len(keys) * 8).bit_length())
        self.shift, size = np.uint64(64 - bits), 1 << bits
        self.keys, self.values = np.zeros(size, np.uint64), np.full(size, NO_TOKEN, np.int32)
        slots = (keys >> self.shift).astype(np.int64)
        left, self.probes = np.arange(len(keys)), 0
        while len(left):
            at = (slots[left] + self.probes) % size
            free = self.values[at] == NO_TOKEN
            first = np.zeros(len(left), bool)
            first[np.unique(at, return_index=True)[1]] = True
            put = free & first
            self.keys[at[put]], self.values[at[put]] = keys[left[put]], values[left[put]]
            left, self.probes = left[~put], self.probes + 1

    def find(self, keys: np.ndarray) -> np.ndarray:
        slots, size = (keys >> self.shift).astype(np.int64), len(self.keys)
        found = np.where(self.keys[slots] == keys, self.values[slots], NO_TOKEN)
        open_ = np.flatnonzero((found == NO_TOKEN) & (self.values[slots] != NO_TOKEN))
        for probe in range(1, self.probes):
            if not len(open_):
                break
            at = (slots[open_] + probe) % size
            hit = self.keys[at] == keys[open_]
            found[open_[hit]] = self.values[at[hit]]
            open_ = open_[~hit & (self.values[at] != NO_TOKEN)]
        return found


class Vocabulary:
    """A byte-level BPE file: its tokens, the merge that makes each, and which may stand side by side."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        letters, model = byte_letters(), told["model"]
        self.special = [t["content"] for t in told["added_tokens"]]
        ids = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        # Rank tokens by the merge that makes them; single bytes come first.
        singles = sorted((t for t in ids if len(t) == 1), key=ids.__getitem__)
        rank = {token: i for i, token in enumerate(singles)}
        for left, right in pairs:
            rank.setdefault(left + right, len(rank))
        self.tokens = {bytes(letters[c] for c in token): number for token, number in rank.items()}
        size = len(rank)
        self.left, self.right = np.arange(size, dtype=np.int32), np.arange(size, dtype=np.int32)
        merged = np.array([rank[a + b] for a, b in pairs], np.int32)
        self.left[merged] = [rank[a] for a, b in pairs]
        self.right[merged] = [rank[b] for a, b in pairs]
        lefts, rights = self.left[merged], self.right[merged]
        self.pairs = _Table(self._pair_key(lefts, rights), merged)
        self.longest = max(map(len, self.tokens))
        names = list(self.tokens)
        numbers = np.fromiter(self.tokens.values(), np.int32, len(names))
        self.by_hash = _Table(np.array([self.text_key(name) for name in names], np.uint64), numbers)
        # A token is ever used only if its own bytes are merged into it.
        self.alone = np.ones(size, bool)
        order = np.sort(merged)
        for low in range(0, len(order), 4096):  # parts have smaller ranks, so a few rounds settle each slice
            part = order[low : low + 4096]
            fits = self.joins(self.left[part], self.right[part], part)
            for _ in range(8):
                self.alone[part] = fits & self.alone[self.left[part]] & self.alone[self.right[part]]
        self.known: dict[tuple[int, int], bool] = {}

    @staticmethod
    def _pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mixed((a.astype(np.uint64) << np.uint64(32)) + b.astype(np.uint64) + np.uint64(1))

    @staticmethod
    def text_key(text: bytes) -> int:
        values = BYTE_VALUES[np.frombuffer(text, np.uint8)]
        return int(mixed(np.sum(values * powers(len(text)), keepdims=True) + np.uint64(len(text)))[0])

    def joins(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether tokens a[i] and b[i] stay apart when their bytes are encoded together.

        Take both back merge by merge, the latest first. A merge across the joint that ranks before
        the one just undone would have been made instead.
        """
        ok = np.ones(len(a), bool)
        rows = np.arange(len(a))
        x, y = a.astype(np.int64), b.astype(np.int64)
        most = np.full(len(a), 1 << 40, np.int64) if limit is None else limit.astype(np.int64)
        while len(rows):
            across = self.pairs.find(self._pair_key(x, y))
            broken = (across != NO_TOKEN) & (across < most)
            ok[rows[broken]] = False
            # Undo the later merge; of two equal tokens the right one was made later.
            can_x, can_y = self.left[x] != x, self.left[y] != y
            take_x = can_x & ((x > y) | ~can_y)
            take_y = can_y & ~take_x
            most = np.where(take_x, x, np.where(take_y, y + 1, most))
            x, y = np.where(take_x, self.right[x], x), np.where(take_y, self.left[y], y)
            go = ~broken & (take_x | take_y)
            rows, x, y, most = rows[go], x[go], y[go], most[go]
        return ok

    def prefix_counts(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Counts of all prefixes (1 .. length) of all words, end to end, and where each word's begin."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        first = np.concatenate([[0], np.cumsum(sizes)])
        out = np.zeros(first[-1], np.int32)
        order = np.argsort(sizes, kind="stable")
        short = order[sizes[order] <= LONG]
        for low in range(0, len(short), 1 << 15):
            rows = short[low : low + (1 << 15)]
            most = int(sizes[rows].max())
            if not most:
                continue
            counts = self._columns([words[i] for i in rows.tolist()], sizes[rows], most)
            inside = np.arange(most)[None, :] < sizes[rows][:, None]
            place = first[rows][:, None] + np.arange(most)[None, :]
            out[place[inside]] = counts[:, 1:][inside]
        for row in order[sizes[order] > LONG].tolist():
            out[first[row] : first[row + 1]] = self._one(words[row])
        return out, first

    def _columns(self, words: list[bytes], sizes: np.ndarray, most: int) -> np.ndarray:
        n = len(words)
        grid = np.frombuffer(b"".join(w.ljust(most, b"\0") for w in words), np.uint8).reshape(n, most)
        sums = np.zeros((n, most + 1), np.uint64)
        np.cumsum(BYTE_VALUES[grid] * powers(most)[None, :], axis=1, out=sums[:, 1:])
        back = powers(most + 1, inverse())
        last = np.full((n, most + 1), NO_TOKEN, np.int32)
        counts = np.zeros((n, most + 1), np.int32)
        for end in range(1, most + 1):
            rows = np.arange(np.searchsorted(sizes, end), n)
            for length in range(min(end, self.longest), 0, -1):
                if not len(rows):
                    break
                begin = end - length
                hashes = mixed((sums[rows, end] - sums[rows, begin]) * back[begin] + np.uint64(length))
                token = self.by_hash.find(hashes)
                some = np.flatnonzero(token != NO_TOKEN)
                if not len(some):
                    continue
                tried, new = rows[some], token[some]
                fits = self.alone[new]
                if begin:
                    fits &= self.joins(last[tried, begin], new)
                tried, new = tried[fits], new[fits]
                last[tried, end], counts[tried, end] = new, counts[tried, begin] + 1
                left = np.ones(len(rows), bool)
                left[some[fits]] = False
                rows = rows[left]
        return counts

    def _one(self, word: bytes) -> np.ndarray:
        """The same for a single long word."""
        last, counts = [NO_TOKEN], [0]
        for end in range(1, len(word) + 1):
            for length in range(min(end, self.longest), 0, -1):
                token = self.tokens.get(word[end - length : end])
                if token is None or not self.alone[token]:
                    continue
                before = last[end - length]
                if before != NO_TOKEN:
                    fits = self.known.get((before, token))
                    if fits is None:
                        if len(self.known) > 1 << 18:
                            self.known.clear()
                        fits = self.known[before, token] = bool(self.joins(np.array([before]), np.array([token]))[0])
                    if not fits:
                        continue
                last.append(token)
                counts.append(counts[end - length] + 1)
                break
        return np.array(counts[1:], np.int32)


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


class _Counted:
    """Some texts as pre-tokens, and the counts of all their prefixes."""

    def __init__(self, known: Vocabulary, texts: list[str]):
        cut = regex.compile(PATTERN)
        apart = regex.compile("|".join(map(regex.escape, known.special))) if known.special else None
        number: dict[str, int] = {}
        rows, upto = [], [0]
        for text in texts:
            rest = 0
            for found in apart.finditer(text) if apart else ():
                rows.extend([number.setdefault(w, len(number)) for w in cut.findall(text, rest, found.start())])
                rows.append(number.setdefault(found.group(), len(number)))
                rest = found.end()
            if rest < len(text):
                rows.extend([number.setdefault(w, len(number)) for w in cut.findall(text, rest)])
            upto.append(len(rows))
        special = set(known.special)
        words = [w.encode() for w in number]
        self.counts, self.first = known.prefix_counts([b"" if w in special else b for w, b in zip(number, words)])
        self.sizes = np.fromiter(map(len, words), np.int64, len(words))
        self.special = np.fromiter((w in special for w in number), bool, len(words))
        totals = np.ones(len(words), np.int64)
        plain = np.flatnonzero(~self.special)
        totals[plain] = self.counts[self.first[plain + 1] - 1]
        self.rows, self.upto = np.array(rows, np.int64), np.array(upto, np.int64)
        self.tokens = np.concatenate([[0], np.cumsum(totals[self.rows])])
        self.bytes = np.concatenate([[0], np.cumsum(self.sizes[self.rows])])

    def prefixes(self, i: int) -> np.ndarray:
        """Token counts of every prefix of text i, by bytes from none to all."""
        low, high = self.upto[i], self.upto[i + 1]
        out = np.zeros(self.bytes[high] - self.bytes[low] + 1, np.int32)
        for at in range(low, high):
            row, begin = self.rows[at], self.bytes[at] - self.bytes[low]
            inner = np.ones(self.sizes[row], np.int32) if self.special[row] else self.counts[self.first[row] : self.first[row + 1]]
            out[begin + 1 : begin + 1 + len(inner)] = self.tokens[at] - self.tokens[low] + inner
        return out

    def fitting(self, i: int, limit: int) -> int:
        """Bytes of the longest prefix of text i with at most ``limit`` tokens."""
        low, high = self.upto[i], self.upto[i + 1]
        used = self.tokens[low:high] - self.tokens[low]
        at = low + int(np.searchsorted(used, limit)) - 1  # the last pre-token that begins below the limit
        if at < low:
            return 0
        row = self.rows[at]
        inner = np.ones(self.sizes[row], np.int64) if self.special[row] else self.counts[self.first[row] : self.first[row + 1]]
        fits = np.flatnonzero(self.tokens[at] - self.tokens[low] + inner <= limit)
        return int(self.bytes[at] - self.bytes[low] + (fits[-1] + 1 if len(fits) else 0))


def _pieces(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[list, list[str]]]:
    for frame in frames:
        ids, texts, size = [], [], 0
        for key, text in zip(frame.iloc[:, 0], frame.iloc[:, 1]):
            ids.append(key)
            texts.append(text if isinstance(text, str) else "")
            size += len(texts[-1])
            if size >= PIECE_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
        if ids:
            yield ids, texts


def token_counts(
    docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, prefixes: bool = False
) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit, fitting_bytes (and ``prefixes``).

    ``path`` names a byte-level BPE file. Its special strings count as one token wherever they stand.
    ``fitting_bytes`` is the length of the longest prefix with at most ``limit`` tokens, and ``prefixes`` the
    count of every prefix by bytes, from none to all; prefixes keep the pre-tokens of the whole text. A null text
    is empty. A null id stays null; rows that share an id are counted each. Empty tables give no rows.
    """

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = vocabulary(path)
        for ids, texts in _pieces(frames):
            found = _Counted(known, texts)
            tokens = np.diff(found.tokens[found.upto])
            rows = {
                "doc_id": pd.Series(ids, dtype="Int64"),
                "n_bytes": np.diff(found.bytes[found.upto]),
                "n_tokens": tokens,
                "over_limit": tokens > limit,
                "fitting_bytes": [found.fitting(i, limit) for i in range(len(texts))],
            }
            yield pd.DataFrame(rows | ({"prefixes": [found.prefixes(i) for i in range(len(texts))]} if prefixes else {}))

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fitting_bytes long"
    schema += ", prefixes array<int>" if prefixes else ""
    chosen = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return chosen.mapInPandas(counted, schema)


def fitting(prefixes, limit):
    """Bytes of the longest prefix within ``limit`` tokens, from a column of stored counts."""
    within = F.transform(prefixes, lambda count, at: F.when(count <= limit, at).otherwise(F.lit(0)))
    return F.array_max(within)
