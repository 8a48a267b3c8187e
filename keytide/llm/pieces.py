"""SentencePiece encoding and decoding over a relational lattice.

Texts are cut into units that no piece crosses, and the distinct ones between characters that no piece has beside each other. Of the distinct units all substrings up to the longest piece's
length are exploded and joined to the piece table; the matches are a unit's edges. Grouped by unit, they are
folded by a higher-order ``aggregate`` in the way of the file's model: for a unigram model the path of the best
total score (Viterbi), for a BPE model the merges, best piece first, since there the best path is not what the
model means. The ids of the units go back to the blocks of documents (see ``blocks``).
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from keytide.llm import blocks as B
from keytide.settings import written_table

SPACE = "▁"
BITS = 60  # units up to so many characters are folded with their cuts in one number
BLOCK_SHARES = 4  # large blocks repeat fewer units
LATTICE_UNITS = 40_000  # units per task, so that their edges stay in memory
PAIRS = 1 << 22  # places for pairs of characters
UNKNOWN_PENALTY = 10.0  # fixed value: what an unknown character costs beyond the worst piece


def _pairs(codes: np.ndarray) -> np.ndarray:
    """Of each character and the next a place below PAIRS."""
    return (codes[:-1] * np.uint32(0x9E3779B1) >> np.uint32(7) ^ codes[1:]) & np.uint32(PAIRS - 1)


@dataclass(frozen=True)
class Model:
    """What the encoder needs of a model file: the ordinary pieces, byte pieces and the kind of model."""

    unigram: bool
    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    ordinary: tuple[bool, ...]
    bytes: tuple[int, ...]
    unknown: int
    dummy_prefix: bool

    @cached_property
    def longest(self) -> int:
        return max((len(p) for p, ok in zip(self.pieces, self.ordinary) if ok), default=1)

    @cached_property
    def _joining(self) -> str:
        found = {c for p, ok in zip(self.pieces, self.ordinary) if ok and len(p) > 1 for c in p} - {SPACE}
        return "".join(re.escape(c) for c in sorted(found))

    @cached_property
    def units(self) -> re.Pattern:
        """Spaces with what follows; a character that is in no longer piece is a unit of its own."""
        if not self._joining:
            return re.compile(f"{SPACE}+|[^{SPACE}]")
        return re.compile(f"{SPACE}*[{self._joining}]+|{SPACE}+|[^{SPACE}{self._joining}]")

    @cached_property
    def _beside(self) -> np.ndarray:
        """Which pairs of characters some piece has beside each other, by hash: others may seem so, which only spares a cut."""
        text = " ".join(p for p, ok in zip(self.pieces, self.ordinary) if ok)
        held = np.zeros(PAIRS, bool)
        held[_pairs(np.frombuffer(text.encode("utf-32-le"), np.uint32))] = True
        return held

    def split(self, units: list[str]) -> tuple[list[str], np.ndarray]:
        """The units cut between characters that are beside each other in no piece: the parts, and where each unit's begin."""
        text = "".join(units)
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        starts = np.cumsum([0, *map(len, units)])
        fresh = np.ones(len(codes) + 1, bool)
        fresh[1:-1] = ~self._beside[_pairs(codes)]
        fresh[starts] = True
        at = np.flatnonzero(fresh)
        return [text[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())], np.searchsorted(at, starts)

    def cut(self, text: str) -> list[str]:
        if not text:
            return []
        return self.units.findall((SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE))

    def fallback(self, text: str) -> list[int]:
        """Ids of characters that are no piece."""
        if not self.bytes:
            return [self.unknown] * len(text)
        return [self.bytes[b] for b in text.encode()]


def read_model(path: str) -> Model:
    """The model at ``path``; its normalizer must be the identity that keeps all spaces."""
    from sentencepiece import sentencepiece_model_pb2

    told = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        told.ParseFromString(file.read())
    if told.normalizer_spec.name != "identity" or told.normalizer_spec.remove_extra_whitespaces:
        raise ValueError("only models whose normalizer keeps the text as it is")
    if any(SPACE in p.piece.lstrip(SPACE) for p in told.pieces if p.type == 1):
        raise ValueError("only models whose pieces have spaces at their beginning")
    spelt = {p.piece: i for i, p in enumerate(told.pieces) if p.type == 6}
    names = [f"<0x{b:02X}>" for b in range(256)]
    return Model(
        unigram=told.trainer_spec.model_type == 1,
        pieces=tuple(p.piece for p in told.pieces),
        scores=tuple(p.score for p in told.pieces),
        ordinary=tuple(p.type == 1 for p in told.pieces),
        bytes=tuple(spelt[n] for n in names) if spelt else (),
        unknown=next(i for i, p in enumerate(told.pieces) if p.type == 2),
        dummy_prefix=told.normalizer_spec.add_dummy_prefix,
    )


def piece_table(spark: SparkSession, model: Model) -> DataFrame:
    """(piece, id, rank, score) of the ordinary pieces; rank 0 has the best score. As large as the model file."""
    rows = [(p, i, s) for i, (p, s, ok) in enumerate(zip(model.pieces, model.scores, model.ordinary)) if ok]
    frame = pd.DataFrame(rows, columns=["piece", "id", "score"])
    frame["rank"] = frame["score"].rank(method="dense", ascending=False).astype("int64") - 1
    return spark.createDataFrame(frame[["piece", "id", "rank", "score"]], "piece string, id long, rank long, score double")


def lattice(units: DataFrame, table: DataFrame, longest: int) -> DataFrame:
    """The edges of units (node, unit): every substring that is a piece, grouped by unit.

    An edge is a struct of rank, start, length, id and score; edges are in that order.
    """
    size = F.length("unit")
    starts = units.select("node", "unit", F.explode(F.sequence(F.lit(0), size - 1)).alias("start"))
    spans = starts.select(
        "node", "unit", "start", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), size - F.col("start")))).alias("length")
    )
    parts = spans.select("node", "start", "length", F.substring("unit", F.col("start") + 1, F.col("length")).alias("piece"))
    # A number as the only key is met much faster than text; the text is compared after that, in a form that is no key.
    keyed = table.withColumnRenamed("piece", "known").withColumn("key", F.xxhash64("known"))
    same = (F.xxhash64("piece") == F.col("key")) & (F.col("piece") >= F.col("known")) & (F.col("piece") <= F.col("known"))
    edges = parts.join(F.broadcast(keyed), same).select("node", F.struct("rank", "start", "length", "id", "score").alias("e"))
    return edges.groupBy("node").agg(F.sort_array(F.collect_list("e")).alias("edges"))


def _bits(start: Column, length: Column) -> tuple[Column, Column]:
    """The cuts at both ends of an edge, and those strictly inside."""
    one = F.lit(1).cast("long")
    low, high = F.call_function("shiftleft", one, start), F.call_function("shiftleft", one, start + length)
    return low.bitwiseOR(high), (high - 1).bitwiseXOR(low * 2 - 1)


def merged(edges: Column, size: Column) -> Column:
    """The cuts (bit i: before character i) that BPE merges leave.

    Each step takes the first edge, by rank and then place, that joins just two neighbours. Edges whose
    ends are no longer cuts never come back.
    """
    one = F.lit(1).cast("long")
    whole = F.call_function("shiftleft", one, size + 1) - 1

    def long(e: Column) -> Column:
        ends, inner = _bits(e["start"], e["length"])
        return F.struct(ends.alias("ends"), inner.alias("inner"))

    longer = F.transform(F.filter(edges, lambda e: e["length"] > 1), long)

    def step(state: Column, _: Column) -> Column:
        cuts, left = state["cuts"], state["left"]
        first = F.get(F.filter(left, lambda e: F.bit_count(cuts.bitwiseAND(e["inner"])) == 1), 0)
        after = F.coalesce(cuts.bitwiseAND(F.bitwise_not(first["inner"])), cuts)
        alive = F.filter(
            left, lambda e: (after.bitwiseAND(e["ends"]) == e["ends"]) & (after.bitwiseAND(e["inner"]) != 0)
        )
        return F.struct(after.alias("cuts"), alive.alias("left"))

    begin = F.struct(whole.alias("cuts"), longer.alias("left"))
    steps = F.when(size > 1, F.sequence(F.lit(2), size)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, begin, step, lambda state: state["cuts"])


def best_path(edges: Column, size: Column, unknown: float) -> Column:
    """The cuts of the path with the best total score; an unknown character costs ``unknown``."""
    one = F.lit(1).cast("long")

    def step(state: Column, end: Column) -> Column:
        ending = F.filter(edges, lambda e: e["start"] + e["length"] == end)
        single = F.exists(ending, lambda e: e["length"] == 1)
        tail = F.struct((end - 1).alias("start"), F.lit(unknown).alias("score"))  # of equal totals the last start wins
        held = F.transform(ending, lambda e: F.struct(e["start"].alias("start"), e["score"].alias("score")))
        ways = F.when(single, held).otherwise(F.concat(held, F.array(tail)))
        bit = F.call_function("shiftleft", one, end)
        reached = F.transform(
            ways,
            lambda w: F.struct(
                (F.get(state, w["start"])["score"] + w["score"]).alias("score"),
                w["start"].alias("start"),
                F.get(state, w["start"])["cuts"].bitwiseOR(bit).alias("cuts"),
            ),
        )
        return F.concat(state, F.array(F.array_max(reached)))

    begin = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("start"), one.alias("cuts")))
    return F.aggregate(F.sequence(F.lit(1), size), begin, step, lambda state: F.element_at(state, -1)["cuts"])


def ids_of(cuts: Column, edges: Column, unit: Column, model: Model) -> Column:
    """Ids between the cuts; a character that is no piece gives those of its bytes."""
    size = F.length(unit)
    places = F.filter(F.sequence(F.lit(0), size), lambda i: F.call_function("getbit", cuts, i) == 1)
    spans = F.transform(F.sequence(F.lit(0), F.size(places) - 2), lambda k: F.struct(F.get(places, k).alias("a"), F.get(places, k + 1).alias("b")))

    def ids(span: Column) -> Column:
        edge = F.get(F.filter(edges, lambda e: (e["start"] == span["a"]) & (e["start"] + e["length"] == span["b"])), 0)
        if not model.bytes:
            return F.coalesce(F.array(edge["id"]), F.array(F.lit(model.unknown).cast("long")))
        spelt = F.hex(F.encode(F.substring(unit, span["a"] + 1, span["b"] - span["a"]), "utf-8"))
        raw = F.transform(
            F.sequence(F.lit(0), (F.length(spelt) / 2).cast("int") - 1),
            lambda i: F.conv(F.substring(spelt, i * 2 + 1, F.lit(2)), 16, 10).cast("long") + model.bytes[0],
        )
        return F.when(edge.isNull(), raw).otherwise(F.array(edge["id"]))

    return F.flatten(F.transform(spans, ids))


def folded_in_place(unit: str, known: dict[str, tuple[int, int, float]], model: Model) -> list[int]:
    """The same for one unit of more than BITS characters: the lattice as a dictionary of pieces."""
    n, out = len(unit), []
    if model.unigram:
        floor = min(s for s, ok in zip(model.scores, model.ordinary) if ok) - UNKNOWN_PENALTY
        best, back = [0.0] + [-np.inf] * n, [0] * (n + 1)
        for start in range(n):
            for end in range(start + 1, min(n, start + model.longest) + 1):
                held = known.get(unit[start:end])
                score = held[2] if held else floor if end == start + 1 else None
                if score is not None and best[start] + score >= best[end]:
                    best[end], back[end] = best[start] + score, start
        at, spans = n, []
        while at:
            spans.append((back[at], at))
            at = back[at]
        spans.reverse()
    else:
        ends, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive, queue = [True] * n, []

        def offer(a: int) -> None:
            b = ends[a]
            if b < n:
                held = known.get(unit[a : ends[b]]) if ends[b] - a <= model.longest else None
                if held:
                    heapq.heappush(queue, (held[1], a, b, ends[b]))

        for a in range(n):
            offer(a)
        while queue:
            _, a, b, end = heapq.heappop(queue)
            if not (alive[a] and alive[b] and ends[a] == b and ends[b] == end):
                continue
            alive[b], ends[a] = False, end
            if end < n:
                before[end] = a
            offer(a)
            if before[a] >= 0:
                offer(before[a])
        spans = [(a, ends[a]) for a in range(n) if alive[a]]
    for a, b in spans:
        held = known.get(unit[a:b])
        out.extend([held[0]] if held else model.fallback(unit[a:b]))
    return out


def _bucket_of(units: list[str], n_buckets: int) -> np.ndarray:
    return pd.util.hash_array(np.array(units, object)).astype(np.uint64) % np.uint64(n_buckets)


def _own_units(block: B.Block, model: Model, n_buckets: int) -> tuple[list[np.ndarray], list[np.ndarray], list[str], np.ndarray]:
    """The documents as numbers of units, of each unit the numbers of its parts, and the distinct parts in that order, which is
    by bucket."""
    number: dict[str, int] = {}
    lines = []
    for text in block.texts:
        units = model.cut(text.decode())
        lines.append(np.fromiter((number.setdefault(unit, len(number)) for unit in units), np.int32, len(units)))
    if not number:
        return lines, [], [], np.zeros(0, np.int64)
    parts, starts = model.split([*number])
    known: dict[str, int] = {}
    own = np.fromiter((known.setdefault(part, len(known)) for part in parts), np.int32, len(parts))
    distinct = np.array([*known], object)
    bucket = _bucket_of(list(known), n_buckets).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    return lines, np.split(place[own], starts[1:-1]), distinct[order].tolist(), bucket[order]


def _strings(units: list[str]) -> bytes:
    batch = pa.record_batch([pa.array(units, pa.string())], names=["u"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _listed(message: bytes) -> list[str]:
    return pa.ipc.open_stream(message).read_all()["u"].to_pylist()


def unit_ids(units: DataFrame, model: Model) -> DataFrame:
    """(bucket, unit, ids) of distinct units (bucket, unit)."""
    spark = units.sparkSession
    numbered = written_table(units.withColumn("node", F.monotonically_increasing_id()), "units")
    table = piece_table(spark, model)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(least, numbered.count() // LATTICE_UNITS)
    short = numbered.where(F.length("unit") <= BITS).repartition(tasks, "node")
    floor = min(s for s, ok in zip(model.scores, model.ordinary) if ok) - UNKNOWN_PENALTY
    edges = lattice(short, table, min(model.longest, BITS))
    joined = short.join(edges, "node", "left")
    held = F.coalesce("edges", F.array().cast(dict(edges.dtypes)["edges"]))
    joined = joined.withColumn("edges", held)
    size = F.length("unit")
    cuts = best_path(F.col("edges"), size, floor) if model.unigram else merged(F.col("edges"), size)
    found = joined.withColumn("cuts", cuts).select("bucket", "unit", ids_of(F.col("cuts"), F.col("edges"), F.col("unit"), model).alias("ids"))

    def whole(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _known(model)
        for frame in frames:
            yield frame.assign(ids=[folded_in_place(unit, known, model) for unit in frame["unit"]])

    long = numbered.where(F.length("unit") > BITS).select("bucket", "unit")
    return found.unionByName(long.mapInPandas(whole, "bucket long, unit string, ids array<long>"))


def _known(model: Model) -> dict[str, tuple[int, int, float]]:
    order = {s: r for r, s in enumerate(sorted({s for s, ok in zip(model.scores, model.ordinary) if ok}, reverse=True))}
    return {p: (i, order[s], s) for i, (p, s, ok) in enumerate(zip(model.pieces, model.scores, model.ordinary)) if ok}


def _decoded(ids: np.ndarray, spelt: list[bytes], model: Model) -> str:
    text = b"".join([spelt[i] for i in ids.tolist()]).decode(errors="replace").replace(SPACE, " ")
    return text[1:] if model.dummy_prefix and text.startswith(" ") else text


def spellings(model: Model) -> list[bytes]:
    byte = {i: bytes([b]) for b, i in enumerate(model.bytes)}
    return [byte.get(i, p.encode() if ok else b"") for i, (p, ok) in enumerate(zip(model.pieces, model.ordinary))]


def encoded(
    docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", ids: bool = False
) -> DataFrame:
    """Per document: doc_id, n_pieces, ids_sha256, n_chars, round_trip (and ``ids``).

    ``ids_sha256`` is the digest of the ids as little-endian 32-bit numbers; ``round_trip`` says whether decoding them
    gives the text (it does not if the text holds the space mark itself). A null text is empty and has no
    pieces. A null id stays null; rows that share an id are encoded each. Other columns are not looked at; empty
    tables give no rows.
    """
    model = read_model(path)
    blocks, total = B.in_blocks(docs, id_col, text_col, shares=BLOCK_SHARES)
    n_buckets = B.buckets_for(total)

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for number, payload in zip(frame["block"], frame["payload"]):
                _, _, distinct, bucket = _own_units(B.Block(payload), model, n_buckets)
                rows = [(b, number, _strings(distinct[low:high])) for b, low, high in B.pieces(bucket)]
                yield pd.DataFrame(rows, columns=["bucket", "block", "message"])
                B.released()

    def distinct_units(rows: pd.DataFrame) -> pd.DataFrame:
        units = sorted({unit for message in rows["message"] for unit in _listed(message)})
        return pd.DataFrame({"bucket": rows["bucket"].iloc[0], "unit": units})

    messages = written_table(blocks.mapInPandas(send, B.MESSAGE), "unit-messages")
    units = B.spread(messages.select("bucket", "message"), total, "bucket").groupBy("bucket")
    known = unit_ids(units.applyInPandas(distinct_units, "bucket long, unit string"), model)
    known = known.select(F.col("bucket").alias("b"), "unit", "ids")

    def answer(asked: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        held = {u: np.asarray(i, "<u4").tobytes() for u, i in zip(told["unit"], told["ids"])}
        replies, narrow = [], "<u2" if len(model.pieces) <= 1 << 16 else "<u4"
        for message in asked["message"]:
            found = [held[unit] for unit in _listed(message)]
            sizes = np.fromiter((len(f) // 4 for f in found), np.uint32, len(found))
            replies.append(B.packed(sizes=sizes, ids=np.frombuffer(b"".join(found), "<u4").astype(narrow)))
        return pd.DataFrame({"block": asked["block"], "bucket": asked["bucket"], "reply": replies})

    both = B.spread(messages, total, "bucket").groupBy("bucket").cogroup(B.spread(known, total, "b").groupBy("b"))
    replies = written_table(both.applyInPandas(answer, B.REPLY), "unit-ids")
    spelt = spellings(model)

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for payload, reply in zip(frame["payload"], frame["reply0"]):
                block, got = B.Block(payload), B.by_bucket(reply)
                lines, made, distinct, bucket = _own_units(block, model, n_buckets)
                told: list[bytes] = [b""] * len(distinct)
                for bucket_number, low, high in B.pieces(bucket):
                    parts = B.unpacked(got[bucket_number])
                    ends = (np.cumsum(parts["sizes"], dtype=np.int64) * 4).tolist()
                    raw = parts["ids"].astype("<u4").tobytes()
                    told[low:high] = [raw[a:b] for a, b in zip([0, *ends[:-1]], ends)]
                whole = [b"".join([told[i] for i in own]) for own in made]
                out = [b"".join([whole[i] for i in line.tolist()]) for line in lines]
                texts = [np.frombuffer(o, "<u4") for o in out]
                held = {
                    "doc_id": pd.Series(block.ids, dtype="Int64").mask(block.null),
                    "n_pieces": [len(t) for t in texts],
                    "ids_sha256": [hashlib.sha256(o).hexdigest() for o in out],
                    "n_chars": [len(t.decode()) for t in block.texts],
                    "round_trip": [_decoded(t, spelt, model) == b.decode() for t, b in zip(texts, block.texts)],
                }
                yield pd.DataFrame(held | ({"ids": [t.astype(np.int32) for t in texts]} if ids else {}))
                B.released()

    schema = "doc_id long, n_pieces long, ids_sha256 string, n_chars long, round_trip boolean"
    schema += ", ids array<int>" if ids else ""
    return B.with_replies(blocks, [replies], total).mapInPandas(rows, schema)


def decoded(encoded_docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of documents encoded with ``ids``."""
    model = read_model(path)
    spelt = spellings(model)

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "text": [_decoded(np.asarray(i), spelt, model) for i in frame["ids"]]})

    return encoded_docs.select("doc_id", "ids").mapInPandas(rows, "doc_id long, text string")
