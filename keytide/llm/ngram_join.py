"""N-gram Jaccard join: documents linked by the overlap of their sets of word n-grams.

The join is a sparse product of the document by n-gram matrix with its transpose, of which only the
entries that can reach the threshold are wanted. Rows that are equal are one row (a set). Two sets of
x <= y n-grams with Jaccard t or more differ in at most k = (x + y) (1 - t) / (1 + t) of them. Deal the n-grams into
more than k parts by hash: some part is the same in both. Sets meet in blocks on such a part. Pairs are discarded
whose sizes or whose parities (how many n-grams fall into each of some buckets, modulo 2) show that they differ in more than k;
the product of a block with its first row counts the overlaps of the others.

Components need no more links than join them. So each block is first multiplied with one
row; rows of one component are done with each other. Rows whose blocks still hold several components after
that make families (rows that blocks of one size class lead to). Sizes and parities of a family's rows are compared first:
all with each other in tiles of bounded size, or block by block where that sends less. Rows that these allow
to link make new families, mostly far smaller, which are multiplied with themselves in tiles. N-grams
are taken a range at a time, overlap counts accumulate, pairs go as soon as their sizes and the n-grams to come cannot
reach the threshold, and of the links those stay that join two components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from keytide.llm import blocks as B
from keytide.llm.blocks import released
from keytide.llm.components import components
from keytide.llm.vectors import LOWER, Prefixes, mixed, words_of
from keytide.settings import written_table

PIECE_BYTES = 1 << 20  # of text worked on at a time; its n-grams and parts take some ten times that
LEADER_ROUNDS = 2
CHUNK_ROWS, CHUNK_BYTES = 4096, 32 << 20  # sets multiplied with one leader in one go, and their n-grams
TILE_SETS, TILE_BYTES = 2048, 8 << 20  # of a family, compared or multiplied with another tile in one go
STEP_ROWS, STEP_ENTRIES = 256, 1 << 21  # rows of a tile, and products of entries, counted at a time
STEP_PAIRS, STEP_WORDS = 1 << 18, 1 << 19  # pairs of sets, and words of their parities, compared at a time
ROW_BYTES = 64  # of a set that goes to a tile, besides its parities
RANGES = 4  # of n-gram hashes, one after the other

KIND_BITS = 8  # the uppermost of a part's key tell the size class it was dealt for

SIEVE_BITS = 1 << 26  # of the fixed-size filter that spares shuffling rows without a partner

PROFILE = "doc_id long, text_hash long, n_shingles long, node long, proof long, level int, odd array<long>, odder array<long>"
PARTS = "part long, node long"
ENDS = "bucket long, message binary"
HASHES = "node long, shingles binary"
MET = ["large", "bin", "low", "high"]


def _pieces(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, list[bytes]]]:
    """Rows without their texts, and the lower-cased texts, a piece at a time."""
    for frame in frames:
        rows, texts, size, low = frame.drop(columns="text"), [], 0, 0
        for text in frame.pop("text"):
            texts.append(text.encode().translate(LOWER) if isinstance(text, str) else b"")
            size += len(texts[-1])
            if size >= PIECE_BYTES:
                yield rows.iloc[low : low + len(texts)], texts
                released()
                low, texts, size = low + len(texts), [], 0
        if texts:
            yield rows.iloc[low:], texts
            released()


def _shingles(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of all texts, sorted within each, and where each text's begin."""
    _, _, _, values, bounds = words_of(texts)
    sums, length = Prefixes(values), np.diff(bounds)
    count = np.where(length >= words, length - words + 1, np.minimum(length, 1))
    owner = np.repeat(np.arange(len(texts)), count)
    start = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(bounds[:-1], count)
    size = np.minimum(words, length)[owner]
    hashes = mixed(sums.of(start, start + size) + size.astype(np.uint64))
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[fresh], owner[fresh]
    return hashes, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))])


def _segment_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _set_ids(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that name a set, whatever the order of its members."""
    return _segment_sums(mixed(hashes ^ np.uint64(0x5851F42D4C957F2D)), bounds).view(np.int64), _segment_sums(
        mixed(hashes ^ np.uint64(0x14057B7EF767814F)), bounds
    ).view(np.int64)


def size_classes(most: int, per: int, of: int) -> np.ndarray:
    """Upper ends of classes of set sizes, one class more than ``most`` needs; a set pairs within its class or the next.

    Ends follow from each other alone, so that rows worked on apart, with another ``most``, have the same classes.
    """
    ends = [1]
    more = True
    while more:
        more = ends[-1] < most
        ends.append(max(ends[-1] + 1, ends[-1] * of // per, ends[-1] * 5 // 4))
    return np.array(ends)


def _of_kind(keys: np.ndarray, kind) -> np.ndarray:
    """Keys that tell the size class; classes beyond the last number share it."""
    tag = np.minimum(kind, (1 << KIND_BITS) - 1).astype(np.uint64) << np.uint64(64 - KIND_BITS)
    return keys >> np.uint64(KIND_BITS) | tag


def _parts(hashes: np.ndarray, bounds: np.ndarray, per: int, of: int) -> list[np.ndarray]:
    """For each set the keys of its parts, in its size class and, near the upper end, the next.

    Some part that is the same in both sets must not be empty: with more than k parts that are not,
    it isn't. A set with fewer adds its least n-grams instead, as many as differ and one more; of two
    such sets some of these are the same.
    """
    size = np.diff(bounds)
    ends = size_classes(int(size.max(initial=1)), per, of)
    own = np.searchsorted(ends, size)
    found: list[list[np.ndarray]] = [[] for _ in size]
    spread, weight = mixed(hashes ^ np.uint64(0x2545F4914F6CDD1D)), mixed(hashes ^ np.uint64(0x9FB21C651E98DF25))
    for ahead in (0, 1):
        chosen = np.flatnonzero((size > 0) & ((ahead == 0) | (size * of // per > ends[own])))
        if not len(chosen):
            continue
        kind = own[chosen] + ahead
        differ = 2 * ends[kind] * (of - per) // (of + per)
        parts = differ + 1 + (differ + 1) // 16
        first = np.cumsum(parts) - parts
        length = size[chosen]
        place = np.repeat(bounds[chosen] - (np.cumsum(length) - length), length) + np.arange(length.sum())
        part = (spread[place] % np.repeat(parts, length).astype(np.uint64)).astype(np.int64)
        slot = part + np.repeat(first, length)
        sums = np.zeros(int(parts.sum()), np.uint64)
        np.add.at(sums, slot, weight[place])
        filled = np.zeros(len(sums), bool)
        filled[slot] = True
        tag = np.repeat(kind, parts).astype(np.uint64) << np.uint64(32)
        number = np.arange(len(sums)) - np.repeat(first, parts)
        keys = _of_kind(mixed(sums + mixed(tag + number.astype(np.uint64))), np.repeat(kind, parts))
        enough = np.add.reduceat(filled, first) > differ
        for i, row in enumerate(chosen):
            low, high = first[i], first[i] + parts[i]
            found[row].append(keys[low:high][filled[low:high]])
            if not enough[i]:
                least = int(size[row] - -(-size[row] * per // of) + 1)
                members = hashes[bounds[row] : bounds[row] + least]
                found[row].append(_of_kind(mixed(members ^ mixed(np.uint64([kind[i]]) + np.uint64(1 << 40))), kind[i]))
    return [np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64) for keys in found]


def _parities(hashes: np.ndarray, bounds: np.ndarray, per: int, of: int) -> tuple[np.ndarray, list, list]:
    """For each set a level, and the parities of how many n-grams fall into 64 * 2^level buckets and twice as many.

    An n-gram that only one of two sets has changes one parity, so sets differ in at least as many n-grams as
    parities. Buckets are some times as many as two linked sets may differ in; the level follows the size, so
    that sets that may link are at most one level apart.
    """
    size = np.diff(bounds)
    differ = 2 * size * (of - per) // (of + per)
    level = np.array([max(0, -(-int(d + 1) // 8) - 1).bit_length() for d in differ], np.int32)
    spread = mixed(hashes ^ np.uint64(0x8CB92BA72F3D8DD7))
    out: list[list[np.ndarray]] = []
    for more in (0, 1):
        words = np.int64(1) << (level.astype(np.int64) + more)
        first = np.concatenate([[0], np.cumsum(words)])
        owner = np.repeat(np.arange(len(size)), size)
        bucket = (spread & (words[owner] * 64 - 1).astype(np.uint64)).astype(np.int64)
        bits = np.zeros(int(first[-1]), np.uint64)
        np.bitwise_xor.at(bits, first[owner] + (bucket >> 6), np.uint64(1) << (bucket & 63).astype(np.uint64))
        held = bits.view(np.int64)
        out.append([held[a:b] for a, b in zip(first[:-1].tolist(), first[1:].tolist())])
    return level, out[0], out[1]


def _profiled(words: int, per: int, of: int):
    def profile(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, texts in _pieces(frames):
            hashes, bounds = _shingles(texts, words)
            node, proof = _set_ids(hashes, bounds)
            level, odd, odder = _parities(hashes, bounds, per, of)
            yield pd.DataFrame(
                {
                    "doc_id": rows["doc_id"].astype("Int64").to_numpy(),
                    "text_hash": rows["text_hash"].to_numpy(),
                    "n_shingles": np.diff(bounds),
                    "node": node,
                    "proof": proof,
                    "level": level,
                    "odd": odd,
                    "odder": odder,
                }
            )

    return profile


def _parted(words: int, per: int, of: int):
    def parted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, texts in _pieces(frames):
            hashes, bounds = _shingles(texts, words)
            parts = _parts(hashes, bounds, per, of)
            node = np.repeat(_set_ids(hashes, bounds)[0], [len(own) for own in parts])
            del hashes, bounds, texts
            yield pd.DataFrame({"part": np.concatenate(parts), "node": node})
            del parts, node

    return parted


def _ends(part: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct parts, and the least and the largest node of each."""
    order = np.lexsort((node, part))
    part, node = part[order], node[order]
    fresh = np.ones(len(part) + 1, bool)
    fresh[1:-1] = part[1:] != part[:-1]
    at = np.flatnonzero(fresh)
    return part[at[:-1]], node[at[:-1]], node[at[1:] - 1]


def _ends_sent(words: int, per: int, of: int, n_buckets: int):
    """Of each piece of texts one message to a bucket: its parts, and the least and the largest node of each."""
    parted = _parted(words, per, of)

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in parted(frames):
            part, low, high = _ends(frame["part"].to_numpy(), frame["node"].to_numpy())
            twice = np.flatnonzero(low != high)
            part, node = np.concatenate([part, part[twice]]), np.concatenate([low, high[twice]])
            bucket = (part.view(np.uint64) % np.uint64(n_buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            both = np.stack([part, node])[:, order]
            rows = [(b, both[:, x:y].tobytes()) for b, x, y in B.pieces(bucket[order])]
            yield pd.DataFrame(rows, columns=["bucket", "message"])

    return send


def _met(rows: pd.DataFrame) -> pd.DataFrame:
    """The parts of a bucket that two sets share, and the least node of each."""
    told = [np.frombuffer(message, np.int64).reshape(2, -1) for message in rows["message"]]
    part, low, high = _ends(*np.concatenate(told, axis=1))
    shared = low != high
    return pd.DataFrame({"part": part[shared], "leader": low[shared]})


def _hashed(words: int):
    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, texts in _pieces(frames):
            hashes, bounds = _shingles(texts, words)
            held = [hashes[x:y].tobytes() for x, y in zip(bounds[:-1], bounds[1:])]
            yield pd.DataFrame({"node": _set_ids(hashes, bounds)[0], "shingles": held})

    return hashed


def _place(name: str) -> tuple[Column, Column]:
    """Slot and bit of a key in the filter."""
    place = F.pmod(F.xxhash64(name), F.lit(SIEVE_BITS))
    return F.shiftright(place, 6), F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63).cast("int"))


def _sieve(keys: DataFrame, name: str) -> DataFrame:
    """Which bits the keys set: at most SIEVE_BITS / 64 rows of two numbers, however many keys."""
    slot, bit = _place(name)
    return written_table(keys.select(slot.alias("slot"), bit.alias("bit")).groupBy("slot").agg(F.bit_or("bit").alias("mask")), "sieve")


def _sifted(rows: DataFrame, name: str, sieve: DataFrame) -> DataFrame:
    """The rows whose key may be among those of the sieve; a full sieve lets all through."""
    slot, bit = _place(name)
    marked = rows.withColumn("_slot", slot).withColumn("_bit", bit)
    passed = marked.join(F.broadcast(sieve), F.col("_slot") == F.col("slot")).where(F.col("mask").bitwiseAND(F.col("_bit")) != 0)
    return passed.select(*rows.columns)


def _products(per: int, of: int):
    def product(leaders: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        """Overlaps of each member with its leader: entries of a bucket's two incidence matrices that match."""
        nodes = leaders["leader"].to_numpy()
        column = pd.Series(np.arange(len(nodes)), nodes)
        own = column.reindex(members["with"]).to_numpy()
        sizes = np.array([len(x) // 8 for x in leaders["shingles"]], np.int64)
        counts = np.array([len(x) // 8 for x in members["held"]], np.int64)
        salt = mixed(np.arange(len(nodes), dtype=np.uint64) + np.uint64(1))
        left = np.frombuffer(b"".join(leaders["shingles"]), np.uint64) ^ np.repeat(salt, sizes)
        row = np.repeat(np.arange(len(own)), counts)
        right = np.frombuffer(b"".join(members["held"]), np.uint64) ^ salt[own[row]]
        overlap = np.bincount(row[np.isin(right, left)], minlength=len(own))
        union = counts + sizes[own] - overlap
        linked = of * overlap >= per * union
        return pd.DataFrame({"a": members["with"].to_numpy()[linked], "b": members["member"].to_numpy()[linked]})

    return product


def _linked(pairs: DataFrame, hashes: DataFrame, per: int, of: int) -> DataFrame:
    """The pairs (leader, node, n: n-grams of the node) whose overlap reaches the threshold, as (a, b)."""
    session = pairs.sparkSession
    rows, grams = pairs.agg(F.count(F.lit(1)), F.sum("n")).first()
    buckets = max(int(session.conf.get("spark.sql.shuffle.partitions")), rows // 20_000, 8 * grams // CHUNK_BYTES)
    # Few leaders have many members; their chunks, and so their copies, follow the number and size of the members.
    chunks = F.ceil(F.greatest(F.count(F.lit(1)) / CHUNK_ROWS, 8 * F.sum("n") / CHUNK_BYTES))
    per_leader = pairs.groupBy("leader").agg(chunks.alias("chunks"))
    chunked = pairs.join(per_leader.hint("merge"), "leader").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")))
    bucket = F.pmod(F.xxhash64("leader", "chunk"), F.lit(buckets)).alias("bucket")
    leaders = per_leader.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    leaders = leaders.join(hashes.withColumnRenamed("node", "leader").hint("merge"), "leader")
    # A leader may have several chunks in one bucket; its hashes are needed there once.
    leaders = leaders.select(bucket, "leader", "shingles").dropDuplicates(["bucket", "leader"])
    members = chunked.join(hashes, "node").select(
        bucket.alias("b"), F.col("leader").alias("with"), F.col("node").alias("member"), F.col("shingles").alias("held")
    )
    product = leaders.groupBy("bucket").cogroup(members.groupBy("b"))
    return written_table(product.applyInPandas(_products(per, of), "a long, b long"), "overlaps")


class _Labels:
    """Components of the rows of two tiles as links are found."""

    def __init__(self, roots: np.ndarray):
        names, self.of = np.unique(roots, return_inverse=True)
        self.up = list(range(len(names)))

    def top(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def joined(self, a: np.ndarray, b: np.ndarray) -> list[int]:
        """Which of the links between rows join two components."""
        _, one_each = np.unique(np.stack([self.of[a], self.of[b]]), axis=1, return_index=True)
        fresh = []
        for i in one_each.tolist():
            x, y = self.top(int(self.of[a[i]])), self.top(int(self.of[b[i]]))
            if x != y:
                self.up[x] = y
                fresh.append(i)
        if fresh:
            self.of = np.array([self.top(x) for x in range(len(self.up))])[self.of]
        return fresh


@dataclass
class _Incidence:
    """Sets as rows of a matrix: entries by row, each row's n-grams ascending, told apart by family."""

    row: np.ndarray
    gram: np.ndarray
    range_of: np.ndarray
    size: np.ndarray

    @staticmethod
    def of(held: list[bytes], family: np.ndarray) -> _Incidence:
        size = np.array([len(x) // 8 for x in held], np.int64)
        row = np.repeat(np.arange(len(held)), size)
        gram = np.frombuffer(b"".join(held), np.uint64)
        # Ranges go by the n-gram itself, so that equal ones of two rows are in the same.
        return _Incidence(row, gram ^ mixed(family.view(np.uint64))[row], (gram % np.uint64(RANGES)).astype(np.int64), size)


def _tile_product(left: _Incidence, right: _Incidence, allowed, found, per: int, of: int) -> None:
    """Tell ``found`` the pairs (rows of left, rows of right) that reach the threshold among those ``allowed(low, high)``,
    a mask of some rows of right by all of left."""
    ahead = [np.bincount(side.row * RANGES + side.range_of, minlength=len(side.size) * RANGES) for side in (left, right)]
    to_come = [side.reshape(-1, RANGES)[:, ::-1].cumsum(1)[:, ::-1] for side in ahead]
    columns = []
    for k in range(RANGES):
        own = np.flatnonzero(left.range_of == k)
        own = own[np.argsort(left.gram[own], kind="stable")]
        columns.append((left.gram[own], left.row[own]))
    begin = np.concatenate([[0], np.cumsum(right.size)])
    width = len(left.size)
    for low in range(0, len(right.size), STEP_ROWS):
        high = min(low + STEP_ROWS, len(right.size))
        total = right.size[low:high, None] + left.size
        need = -(-per * total // (of + per))
        alive = allowed(low, high) & (np.minimum(right.size[low:high, None], left.size) >= need)
        counts = np.zeros(alive.shape, np.int64)
        entries = slice(begin[low], begin[high])
        row, gram, part = right.row[entries] - low, right.gram[entries], right.range_of[entries]
        for k, (grams, owners) in enumerate(columns):
            own = np.flatnonzero((part == k) & alive.any(1)[row])
            start = np.searchsorted(grams, gram[own], "left")
            many = np.searchsorted(grams, gram[own], "right") - start
            upto = np.cumsum(many)
            done = 0
            while done < len(own):  # an entry meets at most one of each row of left
                stop = max(done + 1, int(np.searchsorted(upto, (upto[done - 1] if done else 0) + STEP_ENTRIES, "right")))
                size = many[done:stop]
                at = np.repeat(start[done:stop] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                met = np.repeat(row[own[done:stop]] * width, size) + owners[at]
                counts += np.bincount(met, minlength=counts.size).reshape(counts.shape)
                done = stop
            if k + 1 < RANGES:
                alive &= counts + np.minimum(to_come[1][low:high, None, k + 1], to_come[0][:, k + 1]) >= need
            if not alive.any():
                break
        b, a = np.nonzero(alive & (counts >= need))
        if len(a):
            found(a, b + low)


def _tile_links(per: int, of: int):
    def links(rows: pd.DataFrame) -> pd.DataFrame:
        """The links between two tiles, or within one, that join components."""
        tile, node, family = (rows[name].to_numpy() for name in ("tile", "node", "family"))
        labels, out, held = _Labels(rows["root"].to_numpy()), [], rows["shingles"].to_numpy()
        common = np.bincount(labels.of).argmax()
        left, right = np.flatnonzero(tile == rows["low"].iloc[0]), np.flatnonzero(tile == rows["high"].iloc[0])
        frequent = labels.of == common
        # Rows of the most frequent component are not multiplied with each other.
        for x, y in ((left, right[~frequent[right]]), (left[~frequent[left]], right[frequent[right]])):
            if not len(x) or not len(y):
                continue

            def allowed(low: int, high: int) -> np.ndarray:
                own = y[low:high, None]
                return (labels.of[own] != labels.of[x]) & (family[own] == family[x])

            def found(a: np.ndarray, b: np.ndarray) -> None:
                fresh = labels.joined(x[a], y[b])
                out.extend(zip(node[x[a[fresh]]].tolist(), node[y[b[fresh]]].tolist()))

            sides = (_Incidence.of(held[side].tolist(), family[side]) for side in (x, y))
            _tile_product(*sides, allowed, found, per, of)
        return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)

    return links


def _folded(bits: np.ndarray, level: int) -> np.ndarray:
    """Parities of 64 * 2^level buckets, from rows of those of more: a bucket holds the sums of the buckets it is made of."""
    return np.bitwise_xor.reduce(bits.reshape(len(bits), -1, 1 << level), axis=1)


def _tile_reach(per: int, of: int):
    def reach(rows: pd.DataFrame) -> pd.DataFrame:
        """Pairs of sets of a family, but of two components, that sizes and parities allow to link (see ``_may_link``):
        as many as it takes to lead from each such set to all that it may link with."""
        rows = rows.sort_values(["family", "n"])
        tile, node, root, n, level = (rows[name].to_numpy() for name in ("tile", "node", "root", "n", "level"))
        family, base = np.unique(rows["family"].to_numpy(), return_inverse=True)[1], int(n.max()) + 1
        key, most = family * base + n, np.minimum(n * of // per, base - 1)
        if rows["low"].iloc[0] == rows["high"].iloc[0]:
            x = y = np.arange(len(rows))
            begin = x + 1
        else:
            x, y = np.flatnonzero(tile == rows["low"].iloc[0]), np.flatnonzero(tile == rows["high"].iloc[0])
            begin = np.searchsorted(key[y], family[x] * base - (-n[x] * per // of))
        many = np.maximum(np.searchsorted(key[y], family[x] * base + most[x], "right") - begin, 0)

        parities, held = {}, rows["bits"].to_numpy()
        for k in np.unique(level).tolist():
            place, own = np.zeros(len(rows), np.int64), []
            for more in np.unique(level[level >= k]).tolist():
                at = np.flatnonzero(level == more)
                place[at] = np.arange(len(at)) + sum(map(len, own))
                own.append(_folded(np.stack(held[at]).view(np.uint64), k))
            parities[k] = place, np.concatenate(own)

        def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            may, least = np.zeros(len(a), bool), np.minimum(level[a], level[b])
            for k in np.unique(least).tolist():
                at, (place, bits) = np.flatnonzero(least == k), parities[k]
                step = max(1, STEP_WORDS >> k)
                for low in range(0, len(at), step):
                    some = at[low : low + step]
                    one, other = a[some], b[some]
                    flips = np.bitwise_count(bits[place[one]] ^ bits[place[other]]).sum(1, dtype=np.int64)
                    may[some] = flips * (of + per) <= (n[one] + n[other]) * (of - per)
            return may

        labels, out, upto, done = _Labels(node), [], np.cumsum(many), 0
        while done < len(x):
            stop = max(done + 1, int(np.searchsorted(upto, (upto[done - 1] if done else 0) + STEP_PAIRS, "right")))
            size = many[done:stop]
            a = np.repeat(x[done:stop], size)
            b = y[np.repeat(begin[done:stop] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
            apart = (root[a] != root[b]) & (labels.of[a] != labels.of[b])
            a, b = a[apart], b[apart]
            may = near(a, b)
            a, b = a[may], b[may]
            if len(a):
                fresh = labels.joined(a, b)
                out.extend(zip(node[a[fresh]].tolist(), node[b[fresh]].tolist()))
            done = stop
        return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)

    return reach


def _tiles(sets: DataFrame, load: DataFrame) -> DataFrame:
    """The sets (family, node, root, bytes), each with its row of ``load`` (node ...), once for each tile of its family.

    Families of at most one tile share tiles. What a set brings along joins before its row is repeated: Spark would size the
    repeated rows by the single ones, and might broadcast them.
    """
    rows, held = sets.agg(F.count(F.lit(1)), F.sum("bytes")).first()
    bins = max(1, rows // TILE_SETS, (held or 0) // TILE_BYTES)
    size = F.ceil(F.greatest(F.count(F.lit(1)) / TILE_SETS, F.sum("bytes") / TILE_BYTES))
    tiled = sets.join(sets.groupBy("family").agg(size.alias("tiles")), "family")
    own_bin = F.when(F.col("tiles") == 1, F.pmod(F.xxhash64("family"), F.lit(bins))).otherwise(F.col("family"))
    tiled = tiled.withColumn("bin", own_bin).withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")))
    tiled = tiled.join(load.hint("merge"), "node")
    met = tiled.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    return met.select(
        (F.col("tiles") > 1).alias("large"),
        "bin",
        F.least("tile", "other").alias("low"),
        F.greatest("tile", "other").alias("high"),
        *("tile", "family", "node", "root"),
        *[name for name in load.columns if name != "node"],
    )


def _sketches(traits: DataFrame) -> DataFrame:
    """(node, n, level, bits, bytes): parities of at least four times as many buckets as two linked sets of a size differ in."""
    level, words = F.greatest(F.col("level").cast("int") - 1, F.lit(0)), F.size("odder") / F.when(F.col("level") > 0, 4).otherwise(2)
    part = lambda k: F.slice("odder", (words * k + 1).cast("int"), words.cast("int"))
    both = lambda a, b: F.zip_with(a, b, lambda x, y: x.bitwiseXOR(y))
    half = both(part(0), part(1))
    bits = F.when(F.col("level") > 0, both(half, both(part(2), part(3)))).otherwise(half)
    return traits.select("node", "n", level.alias("level"), bits.alias("bits"), (words * 8 + ROW_BYTES).cast("long").alias("bytes"))


def _family_links(left: DataFrame, traits: DataFrame, hashes, per: int, of: int) -> DataFrame:
    """Links (a, b) that join the components of ``left`` (part, node, root), as many as it takes.

    ``hashes(nodes)`` are the n-grams of a table of nodes. In a family of several tiles every tile meets every other, so that a
    set's size and parities are sent once for each. If that is more than once for each of its blocks, the blocks
    take the place of the family: what is sent follows the rows of ``left`` then, not their square. N-grams go to the tiles of
    the families that sets in reach of each other make, once for each tile.
    """
    # A set may have parts of two classes; sets that may link share one of the same class. Files hold repeated parts and nodes
    # in few bytes, by which Spark would take their rows for few enough to broadcast.
    own = left.select("part", "node", "root", F.xxhash64("node", F.shiftrightunsigned("part", 64 - KIND_BITS)).alias("member"))
    first = own.groupBy("part").agg(F.min("member").alias("a"))
    inside = own.join(first.hint("merge"), "part").select("a", F.col("member").alias("b")).where("a <> b").distinct()
    family = components(inside).withColumnsRenamed({"node": "member", "root": "family"})
    sketches = written_table(_sketches(traits.join(left.select("node").distinct(), "node", "left_semi")), "sketches")
    sets = own.groupBy("member", "node", "root").agg(F.count(F.lit(1)).alias("blocks"))
    sets = written_table(sets.join(family, "member").join(sketches.select("node", "bytes"), "node"), "apart")
    tiles = F.ceil(F.greatest(F.count(F.lit(1)) / TILE_SETS, F.sum("bytes") / TILE_BYTES))
    costs = sets.groupBy("family").agg((tiles * F.sum("bytes") > F.sum(F.col("bytes") * F.col("blocks"))).alias("by_part"))
    sets = sets.join(costs, "family")
    whole = sets.where("not by_part").select("family", "node", "root", "bytes")
    parted = own.join(sets.where("by_part").select("member", "bytes").hint("merge"), "member")
    met = whole.unionByName(parted.select(F.col("part").alias("family"), "node", "root", "bytes"))
    met = _tiles(written_table(met, "met"), sketches.drop("bytes"))
    reach = written_table(met.groupBy(*MET).applyInPandas(_tile_reach(per, of), "a long, b long"), "reach")
    if reach.isEmpty():
        return reach
    near = components(reach).withColumnRenamed("root", "family").join(left.select("node", "root").distinct(), "node")
    near = near.join(traits.select("node", (F.col("n") * 8).alias("bytes")), "node")
    near = written_table(near.select("family", "node", "root", "bytes"), "near")
    product = _tiles(near, hashes(near.select("node"))).groupBy(*MET)
    return written_table(product.applyInPandas(_tile_links(per, of), "a long, b long"), "links")


def _may_link(per: int, of: int) -> Column:
    """Sizes and parities of (n, level, odd, odder) and the same of the leader that allow the threshold."""
    smaller, larger = F.least("n", "leader_n"), F.greatest("n", "leader_n")

    def apart(a: str, b: str) -> Column:
        flips = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("long"))
        return F.aggregate(flips, F.lit(0).cast("long"), lambda total, x: total + x)

    least = (
        F.when(F.col("level") == F.col("leader_level"), apart("odd", "leader_odd"))
        .when(F.col("level") < F.col("leader_level"), apart("odder", "leader_odd"))
        .otherwise(apart("odd", "leader_odder"))
    )
    return (smaller * of >= larger * per) & (least * (of + per) <= (smaller + larger) * (of - per))


def near_documents(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    per: int = 80,
    of: int = 100,
) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, text_hash, component.

    Two documents link if of * |intersection| >= per * |union| for their sets of ``words``-word shingles of
    lower-cased (A-Z) words. A text with fewer words is one shingle; one without words or a null text has
    none and links with nothing. ``component_id`` is the smallest id that links lead to. A null id stays null and
    counts only if a component has no other. Rows that share an id are documents of their own: ``component`` numbers
    the components (null without shingles) and ``text_hash`` is Spark's xxhash64 of the text, to tell rows apart.
    Other columns of ``docs`` are not looked at. Empty tables give no rows.
    """
    if not 0 < per <= of:
        raise ValueError("the threshold must lie in (0, 1]")
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    hashed = chosen.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    profiles = written_table(hashed.mapInPandas(_profiled(words, per, of), PROFILE), "profiles")
    grouped = profiles.where("n_shingles > 0").groupBy("node")
    same_in_all = [F.max("n_shingles").alias("n"), F.min("proof").alias("low"), F.max("proof").alias("high")]
    sets = written_table(grouped.agg(F.min("doc_id").alias("first_id"), *same_in_all), "sets")
    if not sets.where("low <> high").isEmpty():
        raise RuntimeError("two sets have the same 64-bit name")

    # The parts are worked out twice: to see which two sets share, and to fetch the sets that share one. A row for each
    # part of each set fills an executor's memory before it leaves a task, so the first time they go to buckets in messages.
    total = 8 * (sets.agg(F.sum("n")).first()[0] or 0)  # bytes of n-grams
    ends = chosen.select("text").mapInPandas(_ends_sent(words, per, of, B.buckets_for(total)), ENDS)
    blocks = B.spread(ends, total, "bucket").groupBy("bucket").applyInPandas(_met, "part long, leader long")
    blocks = written_table(blocks, "blocks")
    keyed = chosen.select("text").mapInPandas(_parted(words, per, of), PARTS)
    members = _sifted(keyed, "part", _sieve(blocks, "part")).join(blocks.hint("merge"), "part").distinct()
    members = written_table(members, "members")
    meeting = written_table(members.select("node").distinct(), "meeting")
    traits = _sifted(profiles.where("n_shingles > 0"), "node", _sieve(meeting, "node")).join(meeting, "node", "left_semi")
    traits = traits.select("node", F.col("n_shingles").alias("n"), "level", "odd", "odder").dropDuplicates(["node"])
    traits = written_table(traits, "traits")
    leader_traits = traits.withColumnsRenamed({name: f"leader_{name}" for name in traits.columns[1:]} | {"node": "leader"})

    def hashes_of(nodes: DataFrame) -> DataFrame:
        needed = written_table(nodes.distinct(), "needed")
        every = chosen.select("text").mapInPandas(_hashed(words), HASHES)
        held = _sifted(every, "node", _sieve(needed, "node")).join(needed, "node", "left_semi")
        return written_table(held.dropDuplicates(["node"]), "shingles")

    roots = docs.sparkSession.createDataFrame([], "node long, root long")
    left = members.withColumn("root", F.col("node")).withColumn("leader_root", F.col("leader"))
    for _ in range(LEADER_ROUNDS):
        pairs = left.where("node <> leader and root <> leader_root").select("leader", "node").distinct()
        pairs = pairs.join(traits, "node").join(leader_traits, "leader").where(_may_link(per, of))
        pairs = written_table(pairs.select("leader", "node", "n"), "pairs")
        if not pairs.isEmpty():
            hashes = hashes_of(pairs.select("node").unionByName(pairs.select(F.col("leader").alias("node"))))
            links = _linked(pairs, hashes, per, of)
            roots = components(links.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))
        # A leader is done with its block; of the rest, blocks that hold more than one component go on.
        rest = left.where("node <> leader").select("part", "node").join(roots.hint("merge"), "node", "left")
        rest = rest.withColumn("root", F.coalesce("root", "node"))
        first = F.min(F.struct("node", "root"))
        apart = rest.groupBy("part").agg(F.min("root").alias("x"), F.max("root").alias("y"), first.alias("first"))
        apart = apart.where("x <> y").select(
            "part", F.col("first.node").alias("leader"), F.col("first.root").alias("leader_root")
        )
        left = written_table(rest.join(apart.hint("merge"), "part"), "left")
        if left.isEmpty():
            break
    else:
        links = _family_links(left.select("part", "node", "root"), traits, hashes_of, per, of)
        roots = components(links.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))

    named = sets.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("first_id").alias("least_id"))
    labelled = named.join(least, "root").select("node", "least_id", "root")
    out = profiles.select("doc_id", "text_hash", "n_shingles", "node").join(labelled, "node", "left")
    filled = F.col("n_shingles") > 0
    return out.select(
        "doc_id",
        "n_shingles",
        F.when(filled, F.col("least_id")).otherwise(F.col("doc_id")).alias("component_id"),
        "text_hash",
        F.when(filled, F.col("root")).alias("component"),
    )


def without_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The documents of ``docs``, of each component only the one with the smallest id, with all columns.

    Rows that repeat an id and a text are one document, of which one row stays. Documents without shingles stay.
    """
    found = near_documents(docs, id_col=id_col, text_col=text_col, **how)
    stays = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    alone = stays.where("component is null").select("doc_id", "text_hash")
    grouped = stays.where("component is not null").groupBy("component", "doc_id").agg(F.min("text_hash").alias("text_hash"))
    chosen = alone.unionByName(grouped.select("doc_id", "text_hash")).distinct()
    chosen = chosen.select(F.col("doc_id").alias("_kept_id"), F.col("text_hash").alias("_kept_hash"))
    own_id, own_hash = F.col(id_col).cast("long"), F.xxhash64(F.col(text_col).cast("string"))
    keyed = docs.withColumn("_own_id", own_id).withColumn("_own_hash", own_hash)
    same = F.col("_own_id").eqNullSafe(F.col("_kept_id")) & (F.col("_own_hash") == F.col("_kept_hash"))
    joined = keyed.join(chosen, same, "left_semi")
    return joined.dropDuplicates(["_own_id", "_own_hash"]).select(*docs.columns)
