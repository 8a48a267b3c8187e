"""Alignment of the tokens of two tokenizers, by inverted bitmaps of token pairs.

Both encode the same bytes (a space, then the text). Where tokens of both end, the text is cut into groups; the two tokens
that end there are a link. Texts are cut before single spaces between other characters, which no token of either kind
crosses, so every distinct unit is encoded and aligned once per container and not once per occurrence.

Documents stay in containers of at most 65,536. A container holds, for every pair of ids linked in it, which of its
documents have the pair and how often: one bitmap per binary digit of the number (a multiplicity plane), each compressed as
a list of positions or as bits, whichever is shorter. The planes OR-ed and counted give a pair's documents, the counts of
the planes weighted by their digits its links. Counts of all containers are summed by pair; what a pair scores comes back to
every container that holds it and goes to the documents along the bitmaps. A pair that all documents hold costs a row per
container.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from keytide.llm.blocks import packed, unpacked
from keytide.llm.token_counts import byte_letters
from keytide.settings import written_table

MOST_DOCS = 1 << 16
CONTAINER_BYTES = 24 << 20  # of text, as long as it ends with a document
SLICE = 1 << 20  # characters worked on at a time
MOST_UNITS = 300_000  # distinct units remembered
BATCH_UNITS = 10_000
SPACE = "▁"
# Between two characters that are no white space, a token of either kind begins at a space.
_CUT = re.compile(r"(?<=\S) (?=\S)")
CONTAINERS = "container long, documents binary, postings binary"


@lru_cache(maxsize=1)
def _libraries(path_a: str, path_b: str) -> tuple:
    """Both tokenizers, and the bytes of every id."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(path_a)
    a.encode_special_tokens = True
    letters = byte_letters()
    bytes_a = [b""] * a.get_vocab_size(with_added_tokens=True)
    for token, number in a.get_vocab(with_added_tokens=True).items():
        bytes_a[number] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
    b = sentencepiece.SentencePieceProcessor(model_file=path_b)
    bytes_b = []
    for number in range(b.vocab_size()):
        piece = b.id_to_piece(number)
        bytes_b.append(bytes([int(piece[3:5], 16)]) if b.is_byte(number) else piece.replace(SPACE, " ").encode())
    return a, b, bytes_a, bytes_b


class Units:
    """Distinct units with their tokens' numbers, links and groups, in arrays that grow."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b, self.bytes_a, self.bytes_b = _libraries(path_a, path_b)
        self.size_b = len(self.bytes_b)
        self.width_a, self.width_b = (np.array([len(t) for t in known], np.int64) for known in (self.bytes_a, self.bytes_b))
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.fresh: list[str] = []
        self.groups: list[bytes] = []
        self.counts = np.zeros((0, 4), np.int64)  # tokens of a, tokens of b, links, whether both give the bytes
        self.pairs, self.first = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def numbers(self, units: list[str]) -> np.ndarray:
        """Numbers of units; what new ones hold is there once ``settle`` has run."""
        number = self.number
        for unit in units:
            if unit not in number:
                number[unit] = len(number)
                self.fresh.append(unit)
        return np.fromiter(map(number.__getitem__, units), np.int32, len(units))

    def settle(self) -> None:
        """Encode and align the units that are new, together."""
        for low in range(0, len(self.fresh), BATCH_UNITS):
            self._add(self.fresh[low : low + BATCH_UNITS])
        self.fresh = []

    def _add(self, fresh: list[str]) -> None:
        given = [b" " + unit.encode() for unit in fresh]
        ids_a = [e.ids for e in self.a.encode_batch_fast([" " + unit for unit in fresh], add_special_tokens=False)]
        ids_b = self.b.encode(fresh, num_threads=1)
        n_a, n_b, same = [], [], []
        for text, one, two in zip(given, ids_a, ids_b):
            n_a.append(len(one))
            n_b.append(len(two))
            there = b"".join([self.bytes_a[i] for i in one]) == text == b"".join([self.bytes_b[i] for i in two])
            same.append(there)
        flat_a, flat_b = (np.array([i for ids in many for i in ids], np.int64) for many in (ids_a, ids_b))
        end_a, end_b = np.cumsum(self.width_a[flat_a]), np.cumsum(self.width_b[flat_b])
        owner_a, owner_b = np.repeat(np.arange(len(fresh)), n_a), np.repeat(np.arange(len(fresh)), n_b)
        begin = np.concatenate([[0], np.cumsum([len(text) for text in given])])
        # Ends count from the unit's begin; a unit whose bytes differ is not linked at all.
        good = np.array(same, bool)
        end_a, end_b = (_from_begin(end, owner, len(fresh)) for end, owner in ((end_a, owner_a), (end_b, owner_b)))
        at_a, at_b = (begin[owner] + end for owner, end in ((owner_a, end_a), (owner_b, end_b)))
        ok_a, ok_b = np.flatnonzero(good[owner_a]), np.flatnonzero(good[owner_b])
        _, x, y = np.intersect1d(at_a[ok_a], at_b[ok_b], assume_unique=True, return_indices=True)
        x, y = ok_a[x], ok_b[y]
        links = np.bincount(owner_a[x], minlength=len(fresh))
        self.pairs = np.concatenate([self.pairs, flat_a[x] * self.size_b + flat_b[y]])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(links)])
        self.counts = np.concatenate([self.counts, np.stack([n_a, n_b, links, good], 1).astype(np.int64)])
        text_a, text_b = list(map(str, flat_a.tolist())), list(map(str, flat_b.tolist()))
        ends = list(zip((x + 1).tolist(), (y + 1).tolist()))
        begin_a, begin_b = (np.concatenate([[0], np.cumsum(n)]).tolist() for n in (n_a, n_b))
        done = 0
        for unit, more in enumerate(links.tolist()):
            low_a, low_b, said = begin_a[unit], begin_b[unit], []
            for high_a, high_b in ends[done : done + more]:
                said.append(",".join(text_a[low_a:high_a]) + "|" + ",".join(text_b[low_b:high_b]))
                low_a, low_b = high_a, high_b
            done += more
            self.groups.append(";".join(said).encode())


def _from_begin(ends: np.ndarray, owner: np.ndarray, owners: int) -> np.ndarray:
    """Running ends as ends within each owner."""
    last = np.zeros(owners, np.int64)
    last[owner] = ends  # the last of equal owners stays
    last = np.maximum.accumulate(last)
    return ends - np.concatenate([[0], last[:-1]])[owner]


def slices(text: str) -> Iterator[str]:
    """A long text in parts that end where units end."""
    low = 0
    while low < len(text):
        cut = _CUT.search(text, low + SLICE) if len(text) - low > SLICE else None
        high = cut.start() if cut else len(text)
        yield text[low:high]
        low = high + 1


def packed_bitmaps(pair: np.ndarray, doc: np.ndarray, pairs: int, docs: int) -> dict[str, np.ndarray]:
    """The documents of every pair (entries in order of pair, then document): positions, or bits where these are fewer."""
    counts = np.bincount(pair, minlength=pairs)
    dense = counts * 16 > docs
    listed = doc[~dense[pair]].astype(np.uint16)
    number = np.cumsum(dense) - 1
    rows = np.zeros((int(dense.sum()), (docs + 7) // 8), np.uint8)
    inside = dense[pair]
    np.bitwise_or.at(rows, (number[pair[inside]], doc[inside] >> 3), (128 >> (doc[inside] & 7)).astype(np.uint8))
    return {"listed": listed, "held": np.where(dense, 0, counts).astype(np.uint16), "dense": np.flatnonzero(dense).astype(np.uint32), "bits": rows.ravel()}


class Postings:
    """The bitmaps of a container as they were packed: ``pairs`` ascending, planes by binary digit."""

    def __init__(self, message: bytes):
        told = unpacked(message)
        self.pairs, self.docs = told["pairs"], int(told["docs"][0])
        self.planes = []
        for digit in range(int(told["planes"][0])):
            self.planes.append({name: told[f"{name}{digit}"] for name in ("listed", "held", "dense", "bits")})

    def _rows(self, plane: dict) -> np.ndarray:
        return plane["bits"].reshape(len(plane["dense"]), (self.docs + 7) // 8)

    def counts(self, plane: dict) -> np.ndarray:
        """How many documents of each pair a plane holds."""
        found = plane["held"].astype(np.int64)
        found[plane["dense"]] = np.bitwise_count(self._rows(plane)).sum(1)
        return found

    def entries(self, plane: dict) -> tuple[np.ndarray, np.ndarray]:
        """Pair number and document of every bit set."""
        row, doc = np.nonzero(np.unpackbits(self._rows(plane), axis=1, count=self.docs)) if len(plane["dense"]) else (np.zeros(0, int),) * 2
        pair = np.repeat(np.arange(len(self.pairs)), plane["held"])
        return np.concatenate([pair, plane["dense"][row].astype(np.int64)]), np.concatenate([plane["listed"].astype(np.int64), doc])

    def links(self) -> np.ndarray:
        """Links of each pair: the planes' counts by their digits."""
        return sum((self.counts(plane) << digit for digit, plane in enumerate(self.planes)), np.zeros(len(self.pairs), np.int64))

    def documents(self) -> np.ndarray:
        """Documents of each pair: the planes OR-ed, then counted."""
        if len(self.planes) == 1:
            return self.counts(self.planes[0])
        held = [pair << 16 | doc for pair, doc in map(self.entries, self.planes)]
        merged = np.unique(np.concatenate([np.zeros(0, np.int64), *held]))
        return np.bincount(merged >> 16, minlength=len(self.pairs))


def packed_postings(key: np.ndarray, times: np.ndarray, docs: int) -> bytes:
    """Postings from entries: ``key`` is pair << 16 | document, repeated keys add up."""
    order = np.argsort(key)
    key, times = key[order], times[order]
    begins = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    key = key[begins]
    times = np.add.reduceat(times, begins) if len(begins) else times
    pairs, number = np.unique(key >> 16, return_inverse=True)
    doc, planes = key & 0xFFFF, int(times.max(initial=0)).bit_length()
    told = {"pairs": pairs, "docs": np.array([docs]), "planes": np.array([planes])}
    for digit in range(planes):
        there = (times >> digit) & 1 == 1
        plane = packed_bitmaps(number[there], doc[there], len(pairs), docs)
        told |= {f"{name}{digit}": column for name, column in plane.items()}
    return packed(**told)


class _Container:
    """Documents taken in one after the other."""

    def __init__(self, units: Units):
        self.units, self.ids, self.size = units, [], 0
        self.key: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.totals: list[np.ndarray] = []  # tokens of a, of b, links
        self.digests: list = []  # None for a text without tokens
        self.waiting: list[tuple[int, np.ndarray]] = []
        self.waiting_size = 0

    def take(self, doc_id: int | None, text: str | None) -> None:
        number, units = len(self.ids), self.units
        self.ids.append(doc_id)
        self.totals.append(np.zeros(3, np.int64))
        self.digests.append(hashlib.sha256() if text else None)
        for part in slices(text or ""):
            self.waiting.append((number, units.numbers(_CUT.split(part))))
            self.waiting_size += len(part)
            if self.waiting_size >= SLICE:
                self._count()
        self.size += len(text or "")

    def _count(self) -> None:
        """Settle what waits: counts and groups by document, distinct units of a document to links."""
        units, held = self.units, []
        units.settle()
        for number, at in self.waiting:
            digest, told = self.digests[number], units.counts[at]
            if digest is None:
                continue
            if not told[:, 3].all():
                self._lose(number)
                held = [one for one in held if one[0] != number]
                continue
            if self.totals[number][2]:
                digest.update(b";")
            digest.update(b";".join([units.groups[i] for i in at.tolist()]))
            self.totals[number] += told[:, :3].sum(0)
            held.append((number, at))
        if held:
            doc = np.repeat(np.array([number for number, _ in held], np.int64), [len(at) for _, at in held])
            unit, times = np.unique(doc << 32 | np.concatenate([at for _, at in held]), return_counts=True)
            doc, unit = unit >> 32, unit & 0xFFFFFFFF
            begin, links = units.first[unit], units.counts[unit, 2]
            place = np.arange(links.sum()) + np.repeat(begin - (np.cumsum(links) - links), links)
            self.key.append(units.pairs[place] << 16 | np.repeat(doc, links))
            self.times.append(np.repeat(times, links))
        self.waiting, self.waiting_size = [], 0
        if len(units.number) >= MOST_UNITS:
            units.forget()

    def _lose(self, number: int) -> None:
        """A text that turns out to have no tokens leaves nothing behind, whatever its earlier slices brought."""
        if self.totals[number].any():
            self.times = [times * ((key & 0xFFFF) != number) for key, times in zip(self.key, self.times)]
        self.digests[number], self.totals[number] = None, np.zeros(3, np.int64)

    def full(self) -> bool:
        return len(self.ids) >= MOST_DOCS or self.size >= CONTAINER_BYTES

    def packed(self) -> tuple[bytes, bytes]:
        self._count()
        none = np.zeros(0, np.int64)
        key, times = np.concatenate([none, *self.key]), np.concatenate([none, *self.times])
        counts = np.stack(self.totals)
        hashes = [digest.hexdigest() if digest else "" for digest in self.digests]
        documents = packed(
            null=np.array([i is None for i in self.ids]),
            ids=np.array([i or 0 for i in self.ids], np.int64),
            n_a=counts[:, 0].copy(),
            n_b=counts[:, 1].copy(),
            n_links=counts[:, 2].copy(),
            hashes=np.frombuffer("".join(h.ljust(64) for h in hashes).encode(), np.uint8),
        )
        return documents, packed_postings(key[times > 0], times[times > 0], len(self.ids))


def containers(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents as containers of postings, written once."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        units = Units(path_a, path_b)
        held = _Container(units)

        def done() -> pa.RecordBatch:
            told, postings = held.packed()
            values = [pa.array([task << 32 | made]), pa.array([told], pa.binary()), pa.array([postings], pa.binary())]
            return pa.record_batch(values, names=["container", "documents", "postings"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                held.take(doc_id, text.as_py())
                if held.full():
                    yield done()
                    made, held = made + 1, _Container(units)
        if held.ids:
            yield done()

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return written_table(rows.mapInArrow(work, CONTAINERS), "containers")


def _told(held: DataFrame) -> DataFrame:
    """What each container says of its pairs: documents and links."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, message in zip(batch.column(0).to_pylist(), batch.column(1)):
                postings = Postings(message.as_py())
                values = [np.full(len(postings.pairs), number), postings.pairs, postings.documents(), postings.links()]
                yield pa.record_batch([pa.array(v) for v in values], names=["container", "pair", "n_docs", "n_links"])

    return held.select("container", "postings").mapInArrow(work, "container long, pair long, n_docs long, n_links long")


def pair_counts(held: DataFrame, pieces_b: int) -> DataFrame:
    """a, b, n_docs, n_links and best (whether no other a is linked to b more often) of every pair of ids in containers.

    ``pieces_b`` is the number of ids of the second tokenizer; the highest counts, a row per such id at most, are broadcast.
    """
    sums = _told(held).groupBy("pair").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links"))
    split = sums.select(F.expr(f"pair div {pieces_b}").alias("a"), (F.col("pair") % pieces_b).alias("b"), "n_docs", "n_links")
    split = written_table(split, "pairs")
    most = split.groupBy("b").agg(F.max("n_links").alias("_most"))
    return split.join(F.broadcast(most), "b").select("a", "b", "n_docs", "n_links", (F.col("n_links") == F.col("_most")).alias("best"))


def _by_doc(doc: np.ndarray, values: np.ndarray, docs: int) -> np.ndarray:
    """Exact sums of 64-bit numbers: doubles hold the sums of either half."""
    low, high = (np.bincount(doc, part, docs).astype(np.int64) for part in (values & 0xFFFFFF, values >> 24))
    return low + (high << 24)


_SCORED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _scored(left: pa.Table, right: pa.Table) -> pa.Table:
    """A container's documents with what the pairs' scores add up to along the bitmaps."""
    columns: dict[str, list] = {name.split()[0]: [] for name in _SCORED.split(", ")}
    for message, postings in zip(left["documents"], left["postings"]):
        told, posted = unpacked(message.as_py()), Postings(postings.as_py())
        score = np.zeros((2, len(posted.pairs)), np.int64)
        at = np.searchsorted(posted.pairs, right["pair"].to_numpy())
        score[0, at] = right["n_links"].to_numpy()
        score[1, at] = right["best"].to_numpy(zero_copy_only=False)
        sums = np.zeros((2, posted.docs), np.int64)
        for digit, plane in enumerate(posted.planes):
            pair, doc = posted.entries(plane)
            for i in range(2):
                sums[i] += _by_doc(doc, score[i, pair], posted.docs) << digit
        hashes = told["hashes"].tobytes().decode()
        columns["doc_id"].append(pa.array(told["ids"], mask=told["null"]))
        columns["n_a"].append(pa.array(told["n_a"]))
        columns["n_b"].append(pa.array(told["n_b"]))
        columns["n_groups"].append(pa.array(told["n_links"]))
        columns["n_links"].append(pa.array(told["n_links"]))
        columns["n_best"].append(pa.array(sums[1]))
        columns["count_sum"].append(pa.array(sums[0]))
        columns["groups_sha256"].append(pa.array([hashes[i * 64 : i * 64 + 64].strip() for i in range(posted.docs)]))
    return pa.table({name: pa.chunked_array(parts) for name, parts in columns.items()})


def pieces(path_b: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path_b).vocab_size()


def scored(held: DataFrame, pairs: DataFrame, pieces_b: int) -> DataFrame:
    """A row per document of the containers, with the counts of its links' pairs."""
    answers = pairs.select((F.col("a") * pieces_b + F.col("b")).alias("pair"), "n_links", "best")
    replies = _told(held).select("container", "pair").join(answers, "pair")
    return held.groupBy("container").cogroup(replies.groupBy("container")).applyInArrow(_scored, _SCORED)


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of ``docs``, repeated rows too.

    ``path_a`` is a byte-level BPE file, ``path_b`` a SentencePiece model that puts a space before a text and has no piece
    with a space behind another character. A pair's count is its number of links in all rows; n_best counts links whose pair
    has its second id's highest count, ties included. Texts that are null or empty, or that one of the tokenizers does not
    give back byte by byte, have no tokens: zeros, and '' for the hash. A null id stays null. An empty table gives no rows;
    other columns play no part.
    """
    size = pieces(path_b)
    held = containers(docs, path_a, path_b, id_col, text_col)
    return scored(held, written_table(pair_counts(held, size), "pair-counts"), size)


def groups(text: str, path_a: str, path_b: str) -> list[tuple[Sequence[int], Sequence[int]]]:
    """The ids of both tokenizers by group, for one text."""
    units, found = Units(path_a, path_b), []
    for unit in _CUT.split(text) if text else []:
        number = int(units.numbers([unit])[0])
        units.settle()
        if not units.counts[number, 3]:
            return []
        for group in units.groups[number].decode().split(";"):
            one, two = group.split("|")
            found.append((tuple(map(int, one.split(","))), tuple(map(int, two.split(",")))))
    return found
