"""Document fingerprints by randomised edit embedding.

A text is walked character by character under a random walk that all texts share: at step t the current
character is put out, and a random bit for (t, character) says whether to move on. Two texts walk together until
they differ and soon fall in step again, so a few edits change few of the steps' outputs: edit distance
becomes Hamming distance. A fingerprint holds the outputs at every s-th step, s a power of two by the
length, so that fingerprints of different lengths compare at common steps. Near-duplicate search hashes
samples of a fingerprint into bands and verifies who meets there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from keytide.llm.components import components
from keytide.settings import written_table

SAMPLES = 128  # the most steps that a fingerprint holds
PERIOD = 4096  # the walk's bits repeat after so many steps
BANDS, BAND_SAMPLES, BAND_FROM = 32, 4, 40
LEADER_ROUNDS = 2
PIECE_CHARS = 8 << 20
RANGE_BYTES = 32 << 20

_random = np.random.default_rng(20240611)
_WALK = _random.integers(0, 2, (PERIOD, 256)).astype(np.int64)
_WALK[:, 0] = 0  # 0 stands for the end of a text, where a walk stays
_PLACES = np.array([np.sort(_random.choice(BAND_FROM, BAND_SAMPLES, replace=False)) for _ in range(BANDS)])

ROW = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string"
ROW += ", near_edited double, near_next double"


def _codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    return (1 + (points * np.uint32(2654435761) >> np.uint32(16)) % np.uint32(255)).astype(np.uint8)


def _stride(length: int) -> int:
    """log2 of the steps between samples: a walk takes at most 3 steps a character."""
    return max(0, -(-3 * length // SAMPLES) - 1).bit_length()


def fingerprints(texts: list[str]) -> list[str]:
    """Two digits for the stride, then two hex digits for every sampled step."""
    out = [""] * len(texts)
    by_stride: dict[int, list[int]] = {}
    for i, text in enumerate(texts):
        by_stride.setdefault(_stride(len(text)), []).append(i)
    for exponent, rows in by_stride.items():
        rows.sort(key=lambda i: -len(texts[i]))
        codes = [_codes(texts[i]) for i in rows]
        buffer = np.zeros(sum(map(len, codes)) + len(codes), np.uint8)
        sizes = np.array([len(c) for c in codes], np.int64)
        place = np.cumsum(sizes + 1) - sizes - 1
        for at, code in zip(place.tolist(), codes):
            buffer[at : at + len(code)] = code
        held = np.zeros((len(rows), SAMPLES), np.uint8)
        active, step = np.arange(len(rows)), 0
        last = np.minimum(3 * sizes, SAMPLES << exponent)
        while len(active):
            now = buffer[place]
            if step & ((1 << exponent) - 1) == 0:
                held[active, step >> exponent] = now
            if step & 63 == 0:  # leave out those that have ended
                on = (now > 0) & (step < last[active])
                if not on.all():
                    active, place, now = active[on], place[on], now[on]
            place = place + _WALK[step % PERIOD][now]
            step += 1
            if step >> exponent >= SAMPLES:
                break
        count = SAMPLES - np.argmax(held[:, ::-1] > 0, axis=1)
        count[~held.any(axis=1)] = 0
        for row, samples, n in zip(rows, held, count.tolist()):
            out[row] = f"{exponent:02d}{samples[:n].tobytes().hex()}"
    return out


def likeness(a: str, b: str) -> float:
    """Share of common steps at which two fingerprints agree, from 0 to 1; the longer one counts."""
    strides = int(a[:2]), int(b[:2])
    x, y = (np.frombuffer(bytes.fromhex(f[2:]), np.uint8)[:: 1 << max(strides) - s] for f, s in zip((a, b), strides))
    longest = max(len(x), len(y))
    if not longest:
        return 1.0
    both = min(len(x), len(y))
    return float(np.count_nonzero(x[:both] == y[:both]) / longest)


def edited(text: str, following: str) -> str:
    """The last half of the characters replaced by as many first ones of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _rows(ids: list, texts: list[str]) -> pd.DataFrame:
    """All but the last text, each with the one after it."""
    changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
    own, other = fingerprints(texts), fingerprints(changed)
    return pd.DataFrame(
        {
            "doc_id": pd.Series(ids[:-1], dtype="Int64"),
            "n_chars": [len(t) for t in texts[:-1]],
            "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
            "fingerprint": own[:-1],
            "edited_fingerprint": other,
            "near_edited": [likeness(a, b) for a, b in zip(own, other)],
            "near_next": [likeness(a, b) for a, b in zip(own, own[1:])],
        }
    )


def _whole(rows, kind: str, part: int) -> pd.DataFrame:
    """Rows with every column, null where they say nothing."""
    size = len(rows["doc_id"])
    blank = [None] * size
    held = {name: rows[name] if name in rows else blank for name in _COLUMNS} | {"kind": [kind] * size, "part": [part] * size}
    return pd.DataFrame({name: pd.Series(v, dtype="Int64" if name == "doc_id" else object) for name, v in held.items()})


def _walked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of one range of documents; its first and last text are left for their neighbours."""
    from pyspark import TaskContext

    part, ids, texts, size, first = TaskContext.get().partitionId(), [], [], 0, True

    def end(kind: str) -> pd.DataFrame:
        return _whole({"doc_id": pd.Series(ids[-1:], dtype="Int64"), "text": texts[-1:]}, kind, part)

    for frame in frames:
        for key, text in zip(frame.iloc[:, 0].astype("Int64"), frame.iloc[:, 1]):
            ids.append(key)
            texts.append(text if isinstance(text, str) else "")
            size += len(texts[-1])
            if first:
                yield end("first")
                first = False
            if size >= PIECE_CHARS:
                yield _whole(_rows(ids, texts), "inner", part)
                ids, texts, size = ids[-1:], texts[-1:], len(texts[-1])
    if ids:
        if len(ids) > 1:
            yield _whole(_rows(ids, texts), "inner", part)
        yield end("last")


def _stitched(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for key, text, following in zip(frame["doc_id"].astype("Int64"), frame["text"], frame["following"]):
            yield _rows([key, None], [text, following])


_COLUMNS = ["kind", "part", *(field.split()[0] for field in ROW.split(", ")), "text"]


def fingerprinted(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last half of its characters replaced by the first as many of the next document by id
    (after the last, the first). Rows that share an id follow each other by a hash of their text, then the text; null ids
    come first. A null text is empty; two empty texts are alike. Other columns are not looked at; an empty
    table gives no rows.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    total = chosen.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // RANGE_BYTES)
    order = ["doc_id", F.xxhash64("text")]
    ranged = chosen.repartitionByRange(ranges, *order).sortWithinPartitions(*order, "text")
    rows = written_table(ranged.mapInPandas(_walked, f"kind string, part long, {ROW}, text string"), "fingerprints")
    inner = rows.where("kind = 'inner'").drop("kind", "part", "text")

    # Ranges are in order, so the document after a range's last is the first of the next range.
    parts = rows.where("kind = 'first'").select("part")  # a number for each range, no texts
    start = parts.agg(F.min("part")).first()[0]
    later = F.coalesce(F.lead("part").over(Window.orderBy("part")), F.lit(start).cast("long"))
    after = parts.select("part", later.alias("later"))
    firsts = rows.where("kind = 'first'").select(F.col("part").alias("later"), F.col("text").alias("following"))
    lasts = rows.where("kind = 'last'").select("part", "doc_id", "text")
    stitched = lasts.join(after, "part").join(firsts, "later").select("doc_id", "text", "following")
    return inner.unionByName(stitched.mapInPandas(_stitched, ROW))


def _band_keys(fingerprint: pd.Series) -> pd.Series:
    out = []
    for text in fingerprint:
        exponent, keys = int(text[:2]), []
        samples = np.frombuffer(bytes.fromhex(text[2:]), np.uint8)
        for stride, held in ((exponent, samples), (exponent + 1, samples[::2])):  # a neighbour may be a stride coarser
            held = np.concatenate([held, np.zeros(max(0, BAND_FROM - len(held)), np.uint8)])
            for band, places in enumerate(_PLACES):
                keys.append(hashlib.blake2b(bytes([stride, band]) + held[places].tobytes(), digest_size=8).hexdigest())
        out.append(keys)
    return pd.Series(out)


def near_documents(prints: DataFrame, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Near duplicates among fingerprints (doc_id, fingerprint): verified links and membership.

    Equal fingerprints are one class, named by its smallest id. Classes that agree on a band of sampled steps, of BANDS
    bands, are candidates. They are verified against the smallest class of the band first; classes that this leaves in
    different components are verified against the next one and then pair by pair, so that every candidate pair is
    verified or lies in one component. Returns links (a, b, likeness) between classes, as many as join
    the components, and, per document, (doc_id, class_id, component_id). The search is approximate: two classes with
    likeness p share a band with probability 1 - (1 - p^BAND_SAMPLES)^BANDS.
    """
    known = prints.select("doc_id", "fingerprint").where("doc_id is not null")
    classes = written_table(known.groupBy("fingerprint").agg(F.min("doc_id").alias("class_id")), "classes")
    keys = F.pandas_udf(_band_keys, "array<string>")
    held = classes.select(F.col("class_id").alias("a"), F.col("fingerprint").alias("fa"))
    other = classes.select(F.col("class_id").alias("b"), F.col("fingerprint").alias("fb"))
    alike = F.pandas_udf(lambda x, y: pd.Series([likeness(p, q) for p, q in zip(x, y)], dtype=float), "double")
    links = prints.sparkSession.createDataFrame([], "a long, b long, likeness double")
    roots = prints.sparkSession.createDataFrame([], "node long, root long")
    left = classes.select("class_id", F.explode(keys("fingerprint")).alias("band")).withColumn("root", F.col("class_id"))
    for turn in range(LEADER_ROUNDS + 1):
        first = F.min(F.struct("class_id", "root")).alias("first")
        heads = left.groupBy("band").agg(first, F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y")
        heads = heads.select("band", F.col("first.class_id").alias("a"), F.col("first.root").alias("a_root"))
        met = written_table(left.join(heads, "band"), "met")
        if met.isEmpty():
            break
        if turn < LEADER_ROUNDS:
            pairs = met.where("class_id <> a and root <> a_root").select("a", F.col("class_id").alias("b"))
        else:  # everything that is still apart, pair by pair
            own = met.select("band", F.col("class_id").alias("a"), F.col("root").alias("a_root"))
            pairs = own.join(met.select("band", F.col("class_id").alias("b"), "root"), "band")
            pairs = pairs.where("a < b and root <> a_root").select("a", "b")
        scored = pairs.distinct().join(held, "a").join(other, "b").select("a", "b", alike("fa", "fb").alias("likeness"))
        links = links.unionByName(written_table(scored.where(F.col("likeness") >= threshold), "links"))
        roots = components(links.select("a", "b"))
        # A leader is done with its band; of the rest, bands that hold more than one component go on.
        rest = met.where("class_id <> a").select("class_id", "band")
        named = rest.join(roots, F.col("class_id") == F.col("node"), "left")
        left = named.select("class_id", "band", F.coalesce("root", "class_id").alias("root"))
    members = known.join(classes, "fingerprint").select("doc_id", "class_id")
    named = members.join(roots, F.col("class_id") == F.col("node"), "left")
    return links, named.select("doc_id", "class_id", F.coalesce("root", "class_id").alias("component_id"))
