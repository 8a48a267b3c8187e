"""Which windows of a document also start in a document with a smaller id, over all documents.

Two exchanges (see ``blocks``). In the first, blocks tell the buckets which seeds they hold and
learn which are shared. In the second, they send the symbols around shared seeds, each
distinct stretch once, and learn which of its windows start in an earlier document. What "equal"
means, and how a bucket compares, is the caller's: ``substrings`` sorts suffixes of bytes,
``passages`` extends seeds of words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from keytide.llm import blocks as B
from keytide.llm.vectors import winnowed


SHARE_BYTES = 1 << 18  # stretches compared at a time; their hashes, suffixes and windows take some hundred times that


@dataclass
class Symbols:
    """Texts as symbol values, with the bytes that each symbol stands for."""

    buffer: np.ndarray
    starts: np.ndarray  # byte range of each symbol; empty for single bytes
    ends: np.ndarray
    values: np.ndarray
    bounds: np.ndarray  # first symbol of each text, one entry more than texts


@dataclass(frozen=True)
class Method:
    """``read`` makes symbols; ``compare`` flags the windows of stretches, given their ids."""

    window: int
    seed: int
    read: Callable[[list[bytes]], Symbols]
    compare: Callable[..., np.ndarray]


@dataclass
class _Runs:
    """The windows of a block by the seed they select; ``keys`` are its distinct seeds by bucket."""

    symbols: Symbols
    owner: np.ndarray
    first: np.ndarray
    last: np.ndarray
    place: np.ndarray
    seed: np.ndarray
    stretch: np.ndarray
    keys: np.ndarray
    key_bucket: np.ndarray
    local: np.ndarray  # seeds that two documents of this block hold


def _runs(method: Method, block: B.Block, n_buckets: int) -> _Runs:
    symbols = method.read(block.texts)
    first, last, place, seed, stretch = winnowed(symbols.values, symbols.bounds, method.window, method.seed)
    owner = np.searchsorted(symbols.bounds, first, "right") - 1
    short = seed >> np.uint64(16)  # six bytes travel; a false share costs a comparison, no error
    keys = np.unique(short)
    bucket = (keys % np.uint64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    which = np.searchsorted(keys, short)
    low = np.full(len(keys), B.NO_ID)
    high = np.full(len(keys), np.iinfo(np.int64).min)
    ids = block.ids[owner] if len(owner) else np.zeros(0, np.int64)
    np.minimum.at(low, which, ids)
    np.maximum.at(high, which, ids)
    return _Runs(symbols, owner, first, last, place, seed, stretch, keys[order], bucket[order], keys[low < high])


def _shared(runs: _Runs, replies: dict[int, bytes]) -> np.ndarray:
    """Which runs have a seed that another document holds."""
    mark = np.zeros(len(runs.keys), bool)
    for bucket, low, high in B.pieces(runs.key_bucket):
        mark[low:high] = np.unpackbits(np.frombuffer(replies[bucket], np.uint8), count=high - low)
    shared = np.unique(np.concatenate([runs.keys[mark], runs.local]))
    short = runs.seed >> np.uint64(16)
    at = np.searchsorted(shared, short)
    return (shared[np.minimum(at, len(shared) - 1)] == short) if len(shared) else np.zeros(len(short), bool)


@dataclass
class _Stretches:
    """The distinct stretches of shared runs, by bucket, each from its smallest document."""

    runs: np.ndarray  # the shared runs, sorted
    stretch_of: np.ndarray  # the stretch of each
    head: np.ndarray  # the run that stands for each stretch
    bucket: np.ndarray


def _stretches(runs: _Runs, ids: np.ndarray, shared: np.ndarray, n_buckets: int) -> _Stretches:
    own = np.flatnonzero(shared)
    seed, stretch, offset = runs.seed[own], runs.stretch[own], (runs.place - runs.first)[own]
    bucket = ((seed >> np.uint64(16)) % np.uint64(n_buckets)).astype(np.int64)
    order = np.lexsort((ids[runs.owner[own]], offset, stretch, seed, bucket))
    own = own[order]
    fresh = np.ones(len(own), bool)
    fresh[1:] = (
        (seed[order][1:] != seed[order][:-1])
        | (stretch[order][1:] != stretch[order][:-1])
        | (offset[order][1:] != offset[order][:-1])
    )
    head = np.flatnonzero(fresh)
    return _Stretches(own, np.cumsum(fresh) - 1, own[head], bucket[order][head])


def gathered(buffer: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes of many ranges, end to end."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return buffer[np.repeat(starts - (ends - sizes), sizes) + np.arange(total)]


def _seeds_sent(method: Method, n_buckets: int):
    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for number, payload in zip(frame["block"], frame["payload"]):
                runs = _runs(method, B.Block(payload), n_buckets)
                rows = []
                for bucket, low, high in B.pieces(runs.key_bucket):
                    six = np.ascontiguousarray(runs.keys[low:high]).view(np.uint8).reshape(-1, 8)[:, :6]
                    rows.append((bucket, number, np.ascontiguousarray(six).tobytes()))
                yield pd.DataFrame(rows, columns=["bucket", "block", "message"])
                B.released()

    return send


def _seeds_answered(messages: list[bytes]) -> list[bytes]:
    sizes = [len(m) // 6 for m in messages]
    wide = np.zeros((sum(sizes), 8), np.uint8)
    wide[:, :6] = np.frombuffer(b"".join(messages), np.uint8).reshape(-1, 6)
    keys = wide.view(np.uint64).ravel()
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    twice = np.zeros(len(keys), bool)
    same = ranked[1:] == ranked[:-1]
    twice[1:] |= same
    twice[:-1] |= same
    mark = np.empty(len(keys), bool)
    mark[order] = twice
    return [np.packbits(part).tobytes() for part in np.split(mark, np.cumsum(sizes)[:-1])]


def _stretches_sent(method: Method, n_buckets: int):
    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for number, payload, reply in zip(frame["block"], frame["payload"], frame["reply0"]):
                block = B.Block(payload)
                runs = _runs(method, block, n_buckets)
                found = _stretches(runs, block.ids, _shared(runs, B.by_bucket(reply)), n_buckets)
                symbols, rows, within = runs.symbols, [], runs.place - runs.first
                message = head = begin = end = None
                for bucket, low, high in B.pieces(found.bucket):
                    head = found.head[low:high]
                    begin, end = runs.first[head], runs.last[head] + method.window
                    if len(symbols.starts):
                        begin, end = symbols.starts[begin], symbols.ends[end - 1]
                    message = B.packed(
                        ids=block.ids[runs.owner[head]],
                        sizes=(end - begin).astype(np.uint32),
                        offsets=within[head].astype(np.uint16),
                        shares=(runs.seed[head] >> np.uint64(56)).astype(np.uint8),
                        bytes=gathered(symbols.buffer, begin, end - begin),
                    )
                    rows.append((bucket, number, message))
                yield pd.DataFrame(rows, columns=["bucket", "block", "message"])
                del block, runs, found, symbols, rows, within, message, head, begin, end  # before the next block is read
                B.released()

    return send


def _stretches_answered(method: Method):
    def answer(messages: list[bytes]) -> list[bytes]:
        parts = [B.unpacked(message) for message in messages]
        ids, sizes, offsets, shares, data = (
            np.concatenate([part[k] for part in parts]) for k in ("ids", "sizes", "offsets", "shares", "bytes")
        )
        upto = np.cumsum([0, *(len(part["ids"]) for part in parts)]).tolist()
        del parts
        sizes = sizes.astype(np.int64)
        begin = np.cumsum(sizes) - sizes
        # Stretches of one seed lie in one share; a few shares at a time bound the work's memory.
        order = np.argsort(shares, kind="stable")
        sized = np.cumsum(sizes[order])
        flags, low, symbols = [np.zeros(0, bool)], 0, None
        windows = np.zeros(len(sizes), np.int64)
        for _, _, high in B.pieces(shares[order]):
            if sized[high - 1] - (sized[low - 1] if low else 0) >= SHARE_BYTES or high == len(order):
                rows = order[low:high]
                symbols = method.read([data[b : b + s].tobytes() for b, s in zip(begin[rows].tolist(), sizes[rows].tolist())])
                flags.append(method.compare(symbols, ids[rows], offsets[rows].astype(np.int64), method.window, method.seed))
                windows[rows] = np.diff(symbols.bounds) - method.window + 1
                low = high
        del data, symbols
        found, first = np.concatenate(flags), np.empty_like(windows)
        first[order] = np.cumsum(windows[order]) - windows[order]
        return [np.packbits(gathered(found, first[a:b], windows[a:b])).tobytes() for a, b in zip(upto[:-1], upto[1:])]

    return answer


def flagged_windows(method: Method, block: B.Block, n_buckets: int, reply0, reply1):
    """The symbols of a block, and first and last of each stretch of windows that start earlier."""
    runs = _runs(method, block, n_buckets)
    found = _stretches(runs, block.ids, _shared(runs, B.by_bucket(reply0)), n_buckets)
    count = runs.last[found.head] - runs.first[found.head] + 1
    begin = np.concatenate([[0], np.cumsum(count)])
    flags, replies = np.zeros(begin[-1], bool), B.by_bucket(reply1)
    for bucket, low, high in B.pieces(found.bucket):
        size = begin[high] - begin[low]
        flags[begin[low] : begin[high]] = np.unpackbits(np.frombuffer(replies[bucket], np.uint8), count=size)
    ids = block.ids[runs.owner]
    copy = ids[found.runs] > ids[found.head][found.stretch_of]
    whole = found.runs[copy]
    rest, of = found.runs[~copy], found.stretch_of[~copy]
    size = count[of]
    ends = np.cumsum(size)
    within = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size, size)
    hit = flags[np.repeat(begin[of], size) + within]
    single = (np.repeat(runs.first[rest], size) + within)[hit]
    return runs.symbols, np.concatenate([runs.first[whole], single]), np.concatenate([runs.last[whole], single])


def cut(
    docs: DataFrame, method: Method, finish, schema: str | StructType, id_col: str, text_col: str, carry: Sequence[str] = ()
) -> DataFrame:
    """What ``finish(block, symbols, first, last)`` makes of each block: a record batch of ``schema``."""
    blocks, total = B.in_blocks(docs, id_col, text_col, carry)
    n_buckets = B.buckets_for(total)
    seeds = blocks.mapInPandas(_seeds_sent(method, n_buckets), B.MESSAGE)
    shared = B.answered(seeds, _seeds_answered, total, "seeds")
    sent = B.with_replies(blocks, [shared], total).mapInPandas(_stretches_sent(method, n_buckets), B.MESSAGE)
    earlier = B.answered(sent, _stretches_answered(method), total, "stretches")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads, *replies = (batch.column(name) for name in ("payload", "reply0", "reply1"))
            for payload, reply0, reply1 in zip(payloads, *replies):
                block = B.Block(payload.as_py())
                yield finish(block, *flagged_windows(method, block, n_buckets, reply0.as_py(), reply1.as_py()))
                B.released()

    return B.with_replies(blocks, [shared, earlier], total).mapInArrow(rows, schema)
