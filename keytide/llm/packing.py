"""Best-fit packing of token sequences by bin completion.

What is packed is the histogram of lengths, which has at most ``capacity`` entries however many
pieces there are. Best fit gives a first solution, which most often meets the bound on the number of bins. If not,
branch and bound looks for fewer bins: it takes the largest length left, enumerates the undominated ways
to fill up its bin, each for as many bins at once as its lengths last or fewer, and leaves a branch as soon as the waste so
far rules out a gain. Pieces then take the slots of their length by rank.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from hashlib import blake2b
from heapq import heappop, heappush
from itertools import combinations, islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from keytide.llm.blocks import kept, released
from keytide.settings import written_table

CAPACITY, END = 4096, 1
NODES = 1000  # nodes that a search visits beside its first packing; the best solution so far stands
STEPS = 2_000_000  # steps of all searches of one packing together, some seconds
FILLINGS, FILLING_STEPS = 16, 1000  # fillings tried at a node, the fullest first, and steps to find them
SEARCHED_ITEMS = 200  # pieces of the patterns that are packed anew at a time, however many bins have them
RANK_ROWS = 20_000
KEPT_UNITS = 1_000_000  # units whose ids a worker remembers, some 200 MB
PIECE_BYTES = 2 << 20  # of text worked on at a time; its units take some ten times that

# Fixed value: how a file cuts words from marks, as it stands there.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""
# A unit that may be lower-cased, and ASCII marks at its end after a letter or digit (ASCII or Latin-1). An apostrophe may
# belong to letters after it, "<" may begin a special token, and a mark of U+0300 to U+037F may combine with the letter
# before, which then has another lower case: units with one of these are left whole.
_MARKED = re.compile(
    rb"([^'<\xcc\xcd]*(?:[0-9A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]))([!-&(-/:;=-@\[-`{-~]*)"
)

Pattern = tuple[int, ...]
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def best_fit(counts: Mapping[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best fit decreasing over a histogram: patterns of lengths and how many bins have each."""
    open_: dict[int, list[list]] = {}
    gaps: list[int] = []

    def put(pattern: Pattern, bins: int) -> None:
        gap = capacity - sum(pattern)
        if gap not in open_:
            open_[gap] = []
            insort(gaps, gap)
        open_[gap].append([pattern, bins])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                times = capacity // length
                if left >= times:
                    put((length,) * times, left // times)
                if left % times:
                    put((length,) * (left % times), 1)
                break
            gap = gaps[at]
            pattern, bins = open_[gap].pop()
            if not open_[gap]:
                del open_[gap]
                gaps.pop(at)
            times = min(gap // length, left)
            filled = min(bins, left // times)
            put(pattern + (length,) * times, filled)
            if bins > filled:
                put(pattern, bins - filled)
            left -= filled * times
    return [(pattern, bins) for group in open_.values() for pattern, bins in group]


def least_bins(counts: Mapping[int, int], capacity: int) -> int:
    """A bound: total length, and for each t what lengths over capacity - t leave for those from t up."""
    lengths = np.array(sorted(counts), np.int64)
    return _least(lengths, np.array([counts[int(x)] for x in lengths], np.int64), capacity)


def _least(lengths: np.ndarray, number: np.ndarray, capacity: int) -> int:
    if not len(lengths):
        return 0
    pieces = np.concatenate([[0], np.cumsum(number)])
    sums = np.concatenate([[0], np.cumsum(lengths * number)])
    half = int(np.searchsorted(lengths, capacity // 2, "right"))  # the lengths before it are small
    at = np.arange(half)  # t is one of the small lengths; t = 0 is the case at = 0 without lengths over the capacity
    big = np.searchsorted(lengths, capacity - lengths[:half], "right")
    spare = (pieces[big] - pieces[half]) * capacity - (sums[big] - sums[half])
    over = np.maximum(0, sums[half] - sums[at] - spare)
    whole = -(-int(sums[-1]) // capacity)
    found = pieces[-1] - pieces[half] - (-over // capacity)
    return max(whole, int(pieces[-1] - pieces[half]), int(found.max(initial=0)))


@dataclass
class Effort:
    """What searches may spend: ``nodes`` for each beside its first packing, ``steps`` for all together.

    Without a number of nodes nothing is bounded: every filling and every node counts, and the search ends with the
    least number of bins.
    """

    nodes: int | None = NODES
    steps: int = STEPS

    def spent(self, steps: int) -> bool:
        self.steps -= steps
        return self.nodes is not None and self.steps <= 0


def _dominated(filling: Pattern, gap: int, left: Mapping[int, int], lengths: list[int]) -> bool:
    """Whether a length left over (``lengths``: all, rising) could take the place of one or two smaller ones and fit."""
    spare, held = gap - sum(filling), Counter(filling)
    parts = {0, *held, *(2 * x for x, n in held.items() if n > 1), *map(sum, combinations(held, 2))}
    for part in parts:
        for at in range(bisect_right(lengths, part), bisect_right(lengths, part + spare)):
            if left[lengths[at]] > held[lengths[at]]:
                return True
    return False


def fillings(gap: int, left: Mapping[int, int], effort: Effort | None = None) -> list[Pattern]:
    """Undominated ways to fill a gap from the lengths left, the fullest first: FILLINGS of those that FILLING_STEPS steps
    lead to, or all if the effort is not bounded."""
    effort = effort or Effort()
    lengths = sorted(x for x, n in left.items() if n and x <= gap)
    most_steps = math.inf if effort.nodes is None else FILLING_STEPS
    wanted = None if effort.nodes is None else FILLINGS
    found: set[Pattern] = set()
    steps = 0

    def extend(room: int, below: int, chosen: Pattern) -> None:
        nonlocal steps
        went = False
        for at in range(bisect_right(lengths, room, 0, below) - 1, -1, -1):
            length = lengths[at]
            most = min(left[length], room // length)
            for times in range(most, 0 if at else most - 1, -1):  # nothing follows the smallest length
                went, steps = True, steps + 1
                extend(room - times * length, at, chosen + (length,) * times)
                if steps > most_steps:
                    return
        if not went:
            found.add(chosen)

    extend(gap, len(lengths), ())
    ranked = sorted(found, key=lambda filling: (-sum(filling), len(filling), filling))
    undominated = (filling for filling in ranked if not _dominated(filling, gap, left, lengths))
    effort.spent(steps + len(lengths) // 8 + 1)
    return list(islice(undominated, wanted)) or [()]


def search(counts: Mapping[int, int], capacity: int, fewest: int, effort: Effort) -> list[tuple[Pattern, int]] | None:
    """A packing in less than ``fewest`` bins, by bin completion, as far as the effort leads; None if none is found.

    A branch repeats a filling as often as its lengths last, half as often, and so on down to once, so that any numbers
    of bins are reached. Nodes are visited by how far they deviate from the fullest filling repeated the most; nodes of
    the packing without a deviation count among the steps only.
    """
    lengths = np.array(sorted(x for x, n in counts.items() if n), np.int64)
    number = np.array([counts[int(x)] for x in lengths], np.int64)
    place = {int(x): i for i, x in enumerate(lengths)}
    bound, total = _least(lengths, number, capacity), int((lengths * number).sum())
    best, serial, seen, nodes = None, 0, {}, effort.nodes
    # Deviations, minus the depth, a serial number; lengths left and bins before this entry; what was chosen.
    queue: list[tuple] = [(0, 0, 0, number, 0, None)]
    while queue and fewest > bound and not effort.spent(0):
        far, depth, _, left, used, chosen = heappop(queue)
        if far and nodes is not None:
            if not nodes:
                break
            nodes -= 1
        if chosen:
            (pattern, times), _ = chosen
            left, used = left.copy(), used + times
            for x, n in Counter(pattern).items():
                left[place[x]] -= n * times
        at = np.flatnonzero(left)
        if not len(at):
            if used < fewest:
                fewest, best = used, []
                while chosen:
                    entry, chosen = chosen
                    best.append(entry)
            continue
        state = blake2b(left.tobytes(), digest_size=16).digest()
        if seen.get(state, fewest) <= used or used + _least(lengths[at], left[at], capacity) >= fewest:
            continue
        seen[state] = used
        allowed = (fewest - 1) * capacity - total  # more waste than this is no gain
        waste = used * capacity - total + int((lengths * left).sum())
        rest = dict(zip(lengths[at].tolist(), left[at].tolist()))
        largest = int(lengths[at[-1]])
        for turn, filling in enumerate(fillings(capacity - largest, {**rest, largest: rest[largest] - 1}, effort)):
            pattern = (largest, *filling)
            times = min(rest[x] // n for x, n in Counter(pattern).items())
            halved = 0
            while times:
                if waste + times * (capacity - sum(pattern)) <= allowed:
                    serial += 1
                    entry = (far + turn + halved, depth - 1, serial, left, used, ((pattern, times), chosen))
                    heappush(queue, entry)
                times, halved = times // 2, halved + 1
    return best


def _windows(packing: list[tuple[Pattern, int]]) -> Iterator[list[int]]:
    """Entries of a packing some at a time, those with the most waste first; a window overlaps half of the one before."""
    order = sorted(range(len(packing)), key=lambda i: sum(packing[i][0]))
    ends = np.cumsum([len(packing[i][0]) for i in order])
    low = 0
    while low < len(order):
        begin = int(ends[low - 1]) if low else 0
        high = max(low + 1, int(np.searchsorted(ends, begin + SEARCHED_ITEMS, "right")))
        yield order[low:high]
        if high == len(order):
            break
        low = max(low + 1, int(np.searchsorted(ends, begin + SEARCHED_ITEMS // 2, "right")))


def _total(packing: list[tuple[Pattern, int]]) -> tuple[dict[int, int], int]:
    counts: dict[int, int] = {}
    for pattern, bins in packing:
        for x in pattern:
            counts[x] = counts.get(x, 0) + bins
    return counts, sum(bins for _, bins in packing)


def pack(
    counts: Mapping[int, int], capacity: int = CAPACITY, nodes: int | None = NODES, steps: int = STEPS
) -> list[tuple[Pattern, int]]:
    """Patterns of lengths and their bins, as few bins as the search finds; lengths lie in 1 .. capacity.

    Best fit is the first incumbent. If it has more bins than the bound, the whole histogram is searched. While the bound
    is not met, patterns with all their bins are then emptied and packed anew, patterns of SEARCHED_ITEMS pieces at a
    time, the most waste first, until no such lot of patterns gains. ``steps`` bounds all of that together, whatever the
    histogram; the best packing so far stands. With ``nodes`` None nothing is bounded, and the whole histogram is searched
    to the end: the result is the least number of bins, in a time that grows exponentially at worst.
    """
    counts = {int(x): int(n) for x, n in counts.items() if n > 0}
    if any(not 0 < x <= capacity for x in counts):
        raise ValueError("lengths must lie between 1 and the capacity")
    effort = Effort(nodes, steps)
    best, bound = best_fit(counts, capacity), least_bins(counts, capacity)
    bins = sum(n for _, n in best)
    if bins > bound:
        best = search(counts, capacity, bins, effort) or best
    if nodes is None:
        return best
    failed: set[tuple] = set()  # lots without a gain are not tried again
    gained = True
    while gained:
        gained, rest, fresh = False, dict(enumerate(best)), []
        for window in _windows(best):
            if effort.spent(0) or sum(n for _, n in rest.values()) + sum(n for _, n in fresh) == bound:
                break
            if any(i not in rest for i in window):  # half of it has just been packed anew
                continue
            lot = [best[i] for i in window]
            name = tuple(sorted(lot))
            if name in failed:
                continue
            opened, emptied = _total(lot)
            found = search(opened, capacity, emptied, effort)
            if found is None:
                failed.add(name)
                continue
            for i in window:
                del rest[i]
            fresh += found
            gained = True
        best = [*rest.values(), *fresh]
        gained = gained and not effort.spent(0)
    return best


class Slots:
    """Where the pieces of each length go, by rank: rows (length, first rank, bins, sequence, offset)."""

    def __init__(self, patterns: list[tuple[Pattern, int]]):
        used: dict[int, int] = {}
        rows, sequence = [], 0
        for pattern, bins in patterns:
            offset = 0
            for length in pattern:
                first = used.get(length, 0)
                rows.append((length, first, sequence, offset))
                used[length] = first + bins
                offset += length
            sequence += bins
        table = np.array(sorted(rows), np.int64).reshape(-1, 4)
        self.key = (table[:, 0] << 44) + table[:, 1]
        self.first, self.sequence, self.offset = table[:, 1], table[:, 2], table[:, 3]

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, (length << 44) + rank, "right") - 1
        return self.sequence[at] + rank - self.first[at], self.offset[at]


class _Encoder:
    """Token ids of texts, unit by unit between ASCII spaces, which the pre-tokenizer never crosses.

    Where the file lower-cases and cuts words from marks (SPLIT), a unit is lower-cased and its marks at the end go apart, so
    that far fewer are encoded. Words then go to the library by the hundred, between spaces; with an end-of-word suffix the
    last token of each shows. Units of which more than that is to be thought go one by one.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        # Texts on either side of a special token are encoded apart, so one can stand between units.
        plain = [
            (number, token.content)
            for number, token in self.library.get_added_tokens_decoder().items()
            if token.special and not (token.normalized or token.lstrip or token.rstrip or token.single_word)
        ]
        self.between, self.mark = plain[-1] if plain else (None, "")
        file = json.loads(self.library.to_str())
        suffix = file["model"].get("end_of_word_suffix") if file["model"]["type"] == "BPE" else None
        self.folds = _kinds(file["normalizer"]) == ["NFC", "Replace", "Lowercase"] and SPLIT in json.dumps(
            file["pre_tokenizer"], ensure_ascii=False
        ).replace("\\\\", "\\")
        self.last = np.zeros(0, bool)  # which ids end a word
        if suffix and self.folds:
            vocab = self.library.get_vocab()
            self.last = np.zeros(max(vocab.values()) + 1, bool)
            self.last[[number for token, number in vocab.items() if token.endswith(suffix)]] = True

    def _alone(self, units: list[bytes]) -> list[bytes]:
        texts = [unit.decode() for unit in units]
        found = self.library.encode_batch_fast(texts, add_special_tokens=False) if texts else []
        return [np.array(one.ids, "<u4").tobytes() for one in found]

    def _together(self, units: list[bytes]) -> list[bytes]:
        whole = self.library.encode(self.mark.join(unit.decode() for unit in units), add_special_tokens=False)
        ids = np.array(whole.ids, "<u4")
        cuts = np.flatnonzero(ids == self.between)
        raw = ids.tobytes()
        return [raw[4 * a : 4 * b] for a, b in zip([0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)])]

    def _words(self, units: list[bytes]) -> list[bytes] | None:
        """Ids of units that are one word each; None if one of them turns out to be more."""
        ids = np.array(self.library.encode(b" ".join(units).decode(), add_special_tokens=False).ids, "<u4")
        ends = (4 * (np.flatnonzero(self.last[ids]) + 1)).tolist()
        if len(ends) != len(units):  # each has one end at least
            return None
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def _encoded(self, units: list[bytes]) -> dict[bytes, bytes]:
        out: dict[bytes, bytes] = {}
        words = [unit for unit in units if unit.decode().isalpha()] if len(self.last) else []
        for low in range(0, len(words), 512):
            part = words[low : low + 512]
            found = self._words(part)
            if found is not None:
                out.update(zip(part, found))
        # What could hold a special token itself goes by itself.
        simple = [unit for unit in units if unit not in out and b"<" not in unit] if self.between is not None else []
        for low in range(0, len(simple), 512):
            part = simple[low : low + 512]
            out.update(zip(part, self._together(part), strict=True))
        rest = [unit for unit in units if unit not in out]
        for low in range(0, len(rest), 8192):
            out.update(zip(rest[low : low + 8192], self._alone(rest[low : low + 8192])))
        return out

    def _folded(self, units: list[bytes]) -> dict[bytes, bytes]:
        """As ``_encoded``, by the words and the marks that units are made of."""
        heads, tails = [], []
        for unit in units:
            found = _MARKED.fullmatch(unit)
            heads.append(found[1].lower() if found else unit)
            tails.append(found[2] if found else b"")
        wanted = {*heads, *tails} - {b""}
        fresh = self._encoded([part for part in wanted if part not in self.known])
        fresh.update((part, self.known[part]) for part in wanted if part in self.known)
        fresh[b""] = b""
        ids = [fresh[head] + fresh[tail] if tail else fresh[head] for head, tail in zip(heads, tails)]
        fresh.update(zip(units, ids))
        return fresh

    def encode(self, texts: list[bytes]) -> list[bytes]:
        units = [text.split() for text in texts]
        new = list(set().union(*units).difference(self.known))
        fresh = self._folded(new) if self.folds else self._encoded(new)
        beyond = [*islice((part for part in fresh if part not in self.known), max(0, KEPT_UNITS - len(self.known)), None)]
        self.known.update(fresh)
        out = [b"".join(map(self.known.__getitem__, line)) for line in units]
        for part in beyond:  # what a worker has no room for goes after the texts that need it
            del self.known[part]
        return out


def _kinds(part) -> list[str]:
    """The types of the steps of a normalizer."""
    return [one["type"] for one in part["normalizers"]] if part and part["type"] == "Sequence" else [part["type"]] if part else []


def _encoder(path: str) -> _Encoder:
    return kept(path, lambda: _Encoder(path))


def tokenized(
    docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, ids: bool = False
) -> DataFrame:
    """The pieces of all documents: doc_id, piece, start, length, ids_crc32 (and ``ids``).

    A document is its ids by the ``tokenizers`` file at ``path``, without added special tokens, then END. Longer ones are
    cut into pieces of ``capacity``. A null text is empty, so its one piece is END alone.
    """

    def cut(key, held: bytes) -> Iterator[tuple]:
        whole = held + np.array([END], "<u4").tobytes()
        for number, low in enumerate(range(0, len(whole), 4 * capacity)):
            part = whole[low : low + 4 * capacity]
            row = (key, number, low // 4, len(part) // 4, zlib.crc32(part))
            yield (*row, np.frombuffer(part, "<u4").astype(np.int32)) if ids else row

    def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        encoder, names = _encoder(path), ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if ids else [])]

        def frame(keys: list, texts: list[bytes]) -> pd.DataFrame:
            rows = [row for key, held in zip(keys, encoder.encode(texts)) for row in cut(key, held)]
            out = pd.DataFrame(rows, columns=names)
            out["doc_id"] = out["doc_id"].astype("Int64")
            return out

        for part in frames:
            keys, texts, size = [], [], 0
            for key, text in zip(part.iloc[:, 0].astype("Int64"), part.iloc[:, 1]):
                keys.append(key)
                texts.append(text.encode() if isinstance(text, str) else b"")
                size += len(texts[-1])
                if size >= PIECE_BYTES:
                    yield frame(keys, texts)
                    keys, texts, size = [], [], 0
                    released(path)
            if keys:
                yield frame(keys, texts)
            released(path)

    chosen = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return chosen.mapInPandas(pieces, PIECES + (", ids array<int>" if ids else ""))


def placed(pieces: DataFrame, capacity: int = CAPACITY, nodes: int | None = NODES, steps: int = STEPS) -> DataFrame:
    """Written pieces with ``sequence_id`` and ``offset``. Pieces are ranked within their length,
    hot lengths in parts of about RANK_ROWS rows, and take that slot of the packed histogram.
    """
    counts = {row["length"]: row["count"] for row in pieces.groupBy("length").count().collect()}  # at most capacity rows
    slots = Slots(pack(counts, capacity, nodes, steps))
    parts = [F.lit(x) for length, n in counts.items() if n > RANK_ROWS for x in (length, -(-n // RANK_ROWS))]
    salts = F.coalesce(F.try_element_at(F.create_map(*parts), "length"), F.lit(1)) if parts else F.lit(1)
    dealt = pieces.withColumn("_part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), salts))
    sizes = dealt.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first"))
    order = Window.partitionBy("length", "_part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = dealt.withColumn("_rank", F.row_number().over(order) - 1).join(starts, ["length", "_part"])
    ranked = ranked.withColumn("sequence_id", F.col("_first") + F.col("_rank"))
    names = [*pieces.columns, "sequence_id"]

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sequence, offset = slots.place(frame["length"].to_numpy(), frame["sequence_id"].to_numpy())
            yield frame.assign(sequence_id=sequence, offset=offset, doc_id=frame["doc_id"].astype("Int64"))

    kinds = ", ".join(f"`{name}` {kind}" for name, kind in pieces.dtypes)
    return ranked.select(*names).mapInPandas(place, f"{kinds}, sequence_id long, offset long")


def packed(
    docs: DataFrame,
    path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    nodes: int | None = NODES,
    steps: int = STEPS,
    ids: bool = False,
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ``ids``).

    Every piece lies whole in one sequence of at most ``capacity`` ids, gapless from offset 0. ``nodes`` and ``steps`` bound
    the search as in ``pack``. Other columns of
    ``docs`` are not looked at. Rows that share an id are documents of their own; a null id stays null. Empty
    tables give no rows.
    """
    pieces = written_table(tokenized(docs, path, id_col=id_col, text_col=text_col, capacity=capacity, ids=ids), "pieces")
    return placed(pieces, capacity, nodes, steps)


def sequences(packed_pieces: DataFrame) -> DataFrame:
    """The token ids of every sequence (sequence_id, ids), from pieces packed with ``ids``."""
    parts = packed_pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids"))
