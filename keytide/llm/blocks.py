"""Documents in blocks, and the exchange of packed arrays between blocks and hash buckets.

A block holds some megabytes of documents as one compressed row. Every block sends each bucket
one packed message about the keys it holds and gets one packed reply. A key that a third of all
documents share costs one entry per block, never one per document, and no row of the exchange
grows with the data. Blocks are a written table, so a lost executor costs the tasks it ran.
"""

from __future__ import annotations

import ctypes
import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from keytide.settings import written_table

LEAST_BYTES = 2 << 20  # of text; a block holds half of a share and a bucket two
BLOCK_ROWS = 1 << 16
BROADCAST_BYTES, ROW_BYTES = 48 << 20, 100  # the most that replies may hold to be broadcast, counting this per reply
MESSAGE_KEYS = 1800  # text bytes times text bytes over all text, for about 100 keys in a message
NO_ID = np.iinfo(np.int64).max

try:
    _libc = ctypes.CDLL("libc.so.6")
except OSError:  # another C library
    _libc = None

MESSAGE = "bucket long, block long, message binary"
REPLY = "block long, bucket long, reply binary"


def packed(**arrays: np.ndarray) -> bytes:
    """Arrays of any lengths as one compressed message; they are compressed together, since each call has a cost of its own."""
    held = [np.ascontiguousarray(v) for v in arrays.values()]
    head = " ".join(f"{k}:{v.dtype.str}:{v.size}" for k, v in zip(arrays, held)).encode()
    parts = [head, b"\n", *(part for v in held for part in (v.tobytes(), bytes(-v.nbytes % 8)))]
    parts[1] = parts[1].rjust(-len(head) % 8 or 8)  # so that arrays begin at multiples of 8
    raw = b"".join(parts)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpacked(message: bytes) -> dict[str, np.ndarray]:
    size = int.from_bytes(message[:8], "little")
    raw = pa.decompress(memoryview(message)[8:], decompressed_size=size, codec="zstd", asbytes=True)
    at = raw.index(b"\n") + 1
    found = {}
    for told in raw[: at - 1].split():
        key, kind, count = told.decode().split(":")
        found[key] = np.frombuffer(raw, np.dtype(kind), int(count), at)
        at += -(-found[key].nbytes // 8) * 8
    return found


class Block:
    """The documents of one block: ids (NO_ID for null), texts as UTF-8 (empty for null), and what was carried."""

    def __init__(self, payload: bytes):
        self.table = pa.ipc.open_stream(payload).read_all().combine_chunks()
        self.null = self.table["id"].is_null().to_numpy()
        self.ids = self.table["id"].fill_null(int(NO_ID)).to_numpy()
        self.texts: list[bytes] = [text or b"" for text in self.table["text"].to_pylist()]


def _payload(slices: list[pa.RecordBatch]) -> bytes:
    table = pa.Table.from_batches(slices)
    table = table.set_column(1, "text", table["text"].cast(pa.large_binary()))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def share_bytes(total: int) -> int:
    """Grows with the root of all text, so that messages between blocks and buckets keep their size."""
    return max(LEAST_BYTES, math.isqrt(MESSAGE_KEYS * total))


_kept: dict[str, object] = {}


def kept(name: str, make: Callable[[], object]):
    """What a worker keeps from one task to the next, until one of another kind says ``released``."""
    if name not in _kept:
        _kept[name] = make()
    return _kept[name]


def released(*names: str) -> None:
    """Give freed memory back, so that a worker does not keep the peaks of earlier blocks, nor what tasks of another kind
    have left there: only what is kept under these names stays."""
    for name in _kept.keys() - {*names}:
        del _kept[name]
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


def portions(texts: pa.Array, size: int) -> Iterator[tuple[int, list[bytes]]]:
    """The first place and the texts of stretches of about ``size`` bytes, as UTF-8 (empty for null)."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    low, base = 0, 0
    while low < len(texts):
        high = min(int(np.searchsorted(upto, base + size)) + 1, len(texts))
        yield low, [text or b"" for text in texts.slice(low, high - low).cast(pa.large_binary()).to_pylist()]
        low, base = high, int(upto[high - 1])


def in_blocks(
    docs: DataFrame, id_col: str, text_col: str, carry: Sequence[str] = (), shares: float = 0.5
) -> tuple[DataFrame, int]:
    """Write documents as blocks (block, payload) of some shares; also the total size of all texts.

    The columns named in ``carry`` travel along as c0, c1 and so on.
    """
    chosen = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(text_col).cast("string").alias("text"),
        *[F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(carry)],
    )
    total = chosen.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    block_bytes = int(share_bytes(total) * shares)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held, size, rows = TaskContext.get().partitionId() << 32, [], 0, 0

        def full() -> pa.RecordBatch:
            return pa.record_batch([pa.array([number]), pa.array([_payload(held)], pa.binary())], names=["block", "payload"])

        for batch in batches:
            upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(), dtype=np.int64)
            low, base = 0, 0
            while low < batch.num_rows:
                high = min(int(np.searchsorted(upto, base + block_bytes - size)) + 1, low + BLOCK_ROWS - rows, batch.num_rows)
                held.append(batch.slice(low, high - low))
                size, rows = size + int(upto[high - 1]) - base, rows + high - low
                low, base = high, int(upto[high - 1])
                if size >= block_bytes or rows >= BLOCK_ROWS:
                    yield full()
                    number, held, size, rows = number + 1, [], 0, 0
                    released()
        if held:
            yield full()
        released()

    return written_table(chosen.mapInArrow(gather, "block long, payload binary"), "blocks"), total


def buckets_for(total: int) -> int:
    return max(1, -(-total // (2 * share_bytes(total))))


def spread(df: DataFrame, total: int, key: str) -> DataFrame:
    """Deal rows by key over partitions of a few blocks or buckets each."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, total // (4 * share_bytes(total))), key)


def with_replies(blocks: DataFrame, replies: list[DataFrame], total: int) -> DataFrame:
    """Blocks, each with a column reply0, reply1 ... of (bucket, reply) pairs.

    Replies are written tables. Those that are measured to be small go to the blocks, which then do not
    move; with larger ones the blocks meet by a shuffle.
    """
    out = blocks
    for i, reply in enumerate(replies):
        held, rows = reply.agg(F.coalesce(F.sum(F.octet_length("reply").cast("long")), F.lit(0)), F.count(F.lit(1))).first()
        gathered = reply.groupBy("block").agg(F.collect_list(F.struct("bucket", "reply")).alias(f"reply{i}"))
        if held + ROW_BYTES * rows <= BROADCAST_BYTES:
            out = out.join(F.broadcast(gathered), "block", "left")
        else:
            out = spread(out, total, "block").join(spread(gathered, total, "block"), "block", "left")
    return out


def answered(messages: DataFrame, answer: Callable[[list[bytes]], list[bytes]], total: int, name: str) -> DataFrame:
    """Write the replies: ``answer`` turns the messages to one bucket into one reply to each sender."""

    def group(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("block")
        replies = answer(list(rows["message"]))
        released()
        return pd.DataFrame({"block": rows["block"], "bucket": rows["bucket"], "reply": replies})

    return written_table(spread(messages, total, "bucket").groupBy("bucket").applyInPandas(group, REPLY), name)


def by_bucket(pairs) -> dict[int, bytes]:
    """The replies to one block, as collected by ``with_replies``."""
    return {} if pairs is None else {int(p["bucket"]): p["reply"] for p in pairs}


def pieces(keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Value, start and end of each run of equal values in a sorted array."""
    if len(keys):
        cuts = np.flatnonzero(np.diff(keys)) + 1
        for low, high in zip(np.append(0, cuts), np.append(cuts, len(keys))):
            yield int(keys[low]), int(low), int(high)
