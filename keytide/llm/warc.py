"""WARC archives as seekable Zstandard bundles.

Records are grouped into independent frames, and every bundle ends in a skippable frame that tells the sizes of
its frames (the seekable format), so a reader decompresses only the frame it needs. The index maps
each record to its frame and its place there. A payload that an earlier page has too is a revisit record, which
refers to that page and carries no payload.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, functions as F

from keytide.operators.joins import lookup
from keytide.settings import written_table

FRAME_BYTES, BUNDLE_BYTES = 512 << 10, 8 << 20
LEAST_SHARED = 100  # shorter payloads are never revisits
# Fixed values of the seekable Zstandard format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
# Fixed values of the WARC format.
VERSION = b"WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # pages carry no date

BUNDLE = "bundle string, n_records long, content binary, index array<struct<record_id:string,frame:int,offset:int,length:int>>"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def record_id(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(name: str):
    held = name[len("<urn:page:") : -1]
    return int(held) if held else None


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to=None) -> bytes:
    """One record: its header, the response's own header, and the payload unless it is a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    uri = (url or "").replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
    lines = [
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: {record_id(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """The record at a place: its header fields, its block, and where the next record begins."""
    end = data.index(b"\r\n\r\n", at)
    version, *lines = data[at:end].split(b"\r\n")
    if version != VERSION:
        raise ValueError("no record begins here")
    fields = dict(line.decode().split(": ", 1) for line in lines)
    begin = end + 4
    stop = begin + int(fields["Content-Length"])
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise ValueError("a record does not end where its length says")
    return fields, data[begin:stop], stop + 4


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """The last frame of a bundle: compressed and plain size of every other frame."""
    entries = b"".join(struct.pack("<II", *pair) for pair in sizes)
    footer = struct.pack("<IBI", len(sizes), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer


def frames_of(bundle: bytes) -> list[tuple[int, int]]:
    """Start and compressed size of every frame, from the footer."""
    number, _, magic = struct.unpack("<IBI", bundle[-9:])
    if magic != SEEKABLE:
        raise ValueError("the bundle has no seek table")
    table, places, at = bundle[-9 - 8 * number : -9], [], 0
    for i in range(number):
        size = struct.unpack_from("<I", table, 8 * i)[0]
        places.append((at, size))
        at += size
    return places


def frame(bundle: bytes, number: int) -> bytes:
    """One frame of a bundle, decompressed by itself."""
    start, size = frames_of(bundle)[number]
    return zstandard.ZstdDecompressor().decompress(bundle[start : start + size])


class _Bundle:
    def __init__(self, name: str):
        self.name, self.done, self.sizes, self.index = name, [], [], []
        self.open, self.filled = [], 0
        self.packer = zstandard.ZstdCompressor(level=3)

    def add(self, name: str, data: bytes) -> None:
        self.index.append({"record_id": name, "frame": len(self.sizes), "offset": self.filled, "length": len(data)})
        self.open.append(data)
        self.filled += len(data)
        if self.filled >= FRAME_BYTES:
            self.close()

    def close(self) -> None:
        if self.open:
            packed = self.packer.compress(b"".join(self.open))
            self.done.append(packed)
            self.sizes.append((len(packed), self.filled))
            self.open, self.filled = [], 0

    def size(self) -> int:
        return sum(size for size, _ in self.sizes)

    def row(self) -> pd.DataFrame:
        self.close()
        content = b"".join(self.done) + seek_table(self.sizes)
        return pd.DataFrame(
            {"bundle": [self.name], "n_records": [len(self.index)], "content": [content], "index": [self.index]}
        )


def _bundled(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyspark import TaskContext

    task, number = TaskContext.get().partitionId(), 0
    out = _Bundle(f"{task:06d}-{number:06d}")
    for rows in frames:
        refers = rows["refers_to"].astype("Int64")
        for page, url, html, digest, first in zip(
            rows["page_id"].astype("Int64"), rows["url"], rows["html"], rows["payload_digest"], refers
        ):
            page, first = (None if x is pd.NA else int(x) for x in (page, first))
            payload = html.encode() if isinstance(html, str) else b""
            out.add(record_id(page), record(page, url if isinstance(url, str) else None, payload, digest, first))
            if out.size() >= BUNDLE_BYTES:
                yield out.row()
                number += 1
                out = _Bundle(f"{task:06d}-{number:06d}")
    if out.index:
        yield out.row()


def archive(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write one record per page; returns the written bundles: bundle, n_records, content, index.

    Payloads are the texts in UTF-8, empty if null. Of pages with equal payloads of at least LEAST_SHARED bytes, the one
    with the smallest id is a response (all of them if rows repeat that id) and the others revisit it. A page
    with a null id is always a response and none refers to it. Other columns are not looked at.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    chosen = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html"))
    chosen = chosen.withColumn("payload_digest", F.sha2(F.col("html"), 256))
    # Roles are settled on thin rows; a payload that many pages share is spread by the lookup.
    thin = chosen.where(F.octet_length("html") >= LEAST_SHARED).select("page_id", "payload_digest")
    firsts = thin.groupBy(F.col("payload_digest").alias("digest")).agg(
        F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("rows")
    )
    firsts = written_table(firsts.where("rows > 1 and refers_to is not null").drop("rows"), "shared-payloads")
    revisits = lookup(thin, firsts, F.col("payload_digest"), "digest").where("page_id > refers_to").distinct()
    revisits = written_table(revisits, "revisits")
    rows = chosen.join(revisits, ["page_id", "payload_digest"], "left")
    rows = rows.select("page_id", "url", "html", "payload_digest", "refers_to")
    return written_table(rows.mapInPandas(_bundled, BUNDLE), "bundles")


def _records(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    reader = zstandard.ZstdDecompressor()
    for rows in frames:
        for bundle in rows["content"]:
            for start, size in frames_of(bundle):
                data, at, found = reader.decompress(bundle[start : start + size]), 0, []
                while at < len(data):
                    fields, block, at = parsed(data, at)
                    head, payload = block.split(b"\r\n\r\n", 1)
                    length = int(dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])[b"Content-Length"])
                    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha256:"), fields["WARC-Type"]
                    if kind == "response" and (len(payload), hashlib.sha256(payload).hexdigest()) != (length, digest):
                        raise ValueError(f"{fields['WARC-Record-ID']} does not hold its payload")
                    refers = fields.get("WARC-Refers-To")
                    found.append((page_of(fields["WARC-Record-ID"]), length, digest, kind, refers and page_of(refers)))
                out = pd.DataFrame(found, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
                yield out.astype({"page_id": "Int64", "refers_to": "Int64"})


def records(bundles: DataFrame) -> DataFrame:
    """Read all records back, frame by frame: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Lengths and digests are those of the full payload; a response's are held against what it carries.
    """
    return bundles.select("content").mapInPandas(_records, RECORD)


def fetched(bundles: DataFrame, wanted: DataFrame) -> DataFrame:
    """The records (record_id, data) named in ``wanted`` (page_id), decompressing only their frames."""
    names = wanted.select(F.concat(F.lit("<urn:page:"), F.col("page_id").cast("string"), F.lit(">")).alias("record_id"))
    index = bundles.select("bundle", F.explode("index").alias("at")).select("bundle", "at.*")
    found = index.join(names.distinct(), "record_id", "left_semi")
    places = found.groupBy("bundle").agg(F.collect_list(F.struct("record_id", "frame", "offset", "length")).alias("places"))

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in frames:
            for content, held in zip(rows["content"], rows["places"]):
                out, opened = [], {}
                for place in sorted(held, key=lambda p: (p["frame"], p["offset"])):
                    number = place["frame"]
                    if number not in opened:
                        opened = {number: frame(content, number)}
                    out.append((place["record_id"], opened[number][place["offset"] : place["offset"] + place["length"]]))
                yield pd.DataFrame(out, columns=["record_id", "data"])

    return bundles.select("bundle", "content").join(places, "bundle").select("content", "places").mapInPandas(
        read, "record_id string, data binary"
    )
