"""WARC archives as seekable Zstandard bundles.

Records are grouped into frames of about ``FRAME_BYTES``, each a Zstandard frame of its
own; a bundle is a file of frames with a seek table in a skippable frame at its end (the
layout of the seekable format that the Zstandard project publishes). The index maps a
record to its bundle, frame and offset in that frame, so one record costs one seek and
one frame. Other Zstandard tools read a bundle from start to end as one WARC file.

Of rows with equal payloads of ``least_bytes`` or more, that with the smallest page_id is
a response record and the others are revisit records that refer to it.

**Scale.** Payloads are compared by SHA-1 and length through an aggregate with map-side
combine. Only digests that occur more than once are joined to the pages; where those are too many
to be broadcast, whole pages meet them by digest, and adaptive execution splits a partition that
one payload fills. Every task
writes bundles of ``BUNDLE_BYTES`` at most, under a name that holds its attempt, to the
shared folder, through pyarrow's file systems (local paths, HDFS, object stores). The
index is saved, so a repeated attempt leaves an unused file, never a wrong index. Reading is
dealt by bundle to a number of tasks that follows from the bytes of the records, not of the index;
a task reads its bundles frame by frame, and records in order of place.

A null payload is empty. Rows that repeat a page_id with an equal payload are written
each; if it is the smallest, each is a response. A null page_id comes after all others; a
null url is an empty target. Further columns are ignored. An empty table makes no bundle.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from datetime import UTC, datetime
from uuid import uuid4

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import new_folder, require, saved

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 64 << 20
LEVEL = 3
#: Fixed values of the seekable format: skippable frame, footer, descriptor without checksums.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
INDEX = "page_id long, record_type string, refers_to long, bundle string, frame int, offset long, bytes long"


def file_system(path: str):
    """The file system of a folder's address and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def warc_record(page_id, url: str, payload: bytes, revisit_of, is_revisit: bool, date: str) -> bytes:
    headers = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {' '.join((url or '').split())}",
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
        "Content-Type: text/html; charset=utf-8",
    ]
    if is_revisit:
        headers += [f"WARC-Refers-To: {record_id(revisit_of)}",
                    "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    block = b"" if is_revisit else payload
    head = "\r\n".join([*headers, f"Content-Length: {len(block)}", "", ""]).encode()
    return head + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """The headers and the block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    size = int(headers["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("the record's length is wrong")
    return headers, rest[:size]


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The skippable frame with (compressed, decompressed) sizes of the frames before it."""
    body = b"".join(struct.pack("<II", *f) for f in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(file) -> list[tuple[int, int, int]]:
    """(start, compressed size, decompressed size) of each frame of an open bundle."""
    size = file.size()
    file.seek(size - 9)
    count, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("the file has no seek table")
    file.seek(size - 9 - 8 * count)
    table = file.read(8 * count)
    out, start = [], 0
    for k in range(count):
        compressed, plain = struct.unpack_from("<II", table, 8 * k)
        out.append((start, compressed, plain))
        start += compressed
    return out


class _Bundle:
    """One file in the making."""

    def __init__(self, system, path: str):
        self.path, self.out = path, system.open_output_stream(path, compression=None)
        self.frames: list[tuple[int, int]] = []
        self.buffer: list[bytes] = []
        self.filled = self.written = 0

    def add(self, record: bytes) -> tuple[int, int]:
        if self.filled and self.filled + len(record) > FRAME_BYTES:
            self.flush()
        place = len(self.frames), self.filled
        self.buffer.append(record)
        self.filled += len(record)
        return place

    def flush(self) -> None:
        if self.filled:
            data = zstandard.ZstdCompressor(level=LEVEL).compress(b"".join(self.buffer))
            self.out.write(data)
            self.frames.append((len(data), self.filled))
            self.written += len(data)
            self.buffer, self.filled = [], 0

    def close(self) -> None:
        self.flush()
        self.out.write(seek_table(self.frames))
        self.out.close()


def record_types(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """pages with sha1, payload_bytes and first: the smallest page_id of an equal payload, else null."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", "html", F.sha1(payload.cast("binary")).alias("sha1"), F.octet_length(payload).cast("long").alias("payload_bytes"))
    firsts = rows.groupBy(F.col("sha1").alias("s"), F.col("payload_bytes").alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first"))
    firsts = saved(firsts.where((F.col("n") > 1) & (F.col("b") >= least_bytes)), "firsts")
    return rows.join(firsts, (F.col("sha1") == F.col("s")) & (F.col("payload_bytes") == F.col("b")), "left").select(
        "page_id", "url", "html", "first")


def write_archives(pages: DataFrame, folder: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Writes the bundles and returns their saved index: page_id, record_type, refers_to, bundle, frame, offset, bytes."""
    require(pages, "page_id", "url", "html")
    folder = folder or new_folder(pages.sparkSession, "warc")
    date = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def written(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = file_system(folder)
        system.create_dir(root, recursive=True)
        bundle = None
        for batch in batches:
            rows = []
            for page, url, html, first in zip(batch["page_id"], batch["url"], batch["html"], batch["first"], strict=True):
                page, first = (None if pd.isna(x) else int(x) for x in (page, first))
                revisit = first is not None and page != first
                record = warc_record(page, url or "", (html or "").encode(), first, revisit, date)
                if bundle is None or bundle.written + bundle.filled >= BUNDLE_BYTES:
                    if bundle:
                        bundle.close()
                    bundle = _Bundle(system, f"{root}/{uuid4().hex}.warc.zst")
                frame, offset = bundle.add(record)
                rows.append((page, "revisit" if revisit else "response", first if revisit else None, bundle.path.rpartition("/")[2], frame, offset, len(record)))
            names = [c.split()[0] for c in INDEX.split(", ")]
            yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})
        if bundle:
            bundle.close()

    rows = record_types(pages, least_bytes)
    return saved(rows.mapInPandas(written, INDEX).withColumn("bundle", F.concat(F.lit(f"{folder}/"), F.col("bundle"))), "warc-index")


def read_records(index: DataFrame) -> DataFrame:
    """The records an index names: page_id, record_type, refers_to, digest (of the headers) and payload (null for revisits).

    A payload that differs from its digest is an error.
    """
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened, name, frames, at, data = None, None, [], -1, b""
        for batch in batches:
            rows = []
            for page, bundle, frame, offset, size in zip(batch["page_id"], batch["bundle"], batch["frame"], batch["offset"], batch["bytes"], strict=True):
                if bundle != name:
                    system, path = file_system(bundle)
                    opened, name, at = system.open_input_file(path), bundle, -1
                    frames = read_seek_table(opened)
                if frame != at:
                    start, compressed, plain = frames[frame]
                    opened.seek(start)
                    data, at = zstandard.ZstdDecompressor().decompress(opened.read(compressed), max_output_size=plain), frame
                headers, block = parse_record(data[offset:offset + size])
                page = None if pd.isna(page) else int(page)
                if headers["WARC-Record-ID"] != record_id(page):
                    raise ValueError(f"{name} holds another record than {page}")
                kind = headers["WARC-Type"]
                refers = headers.get("WARC-Refers-To", "").removeprefix("<urn:page:").removesuffix(">")
                digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                if kind == "response" and base32_sha1(block) != digest:
                    raise ValueError(f"the payload of {page} differs from its digest")
                rows.append((page, kind, int(refers) if refers else None, digest, block if kind == "response" else None))
            out = pd.DataFrame(rows, columns=["page_id", "record_type", "refers_to", "digest", "payload"])
            yield out.astype({"page_id": "Int64", "refers_to": "Int64"})

    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.LongType()),
                           T.StructField("digest", T.StringType()), T.StructField("payload", T.BinaryType())])
    size = index.agg(F.sum("bytes")).first()[0] or 0
    tasks = max(int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUNDLE_BYTES))
    rows = index.select("page_id", "bundle", "frame", "offset", "bytes").repartition(tasks, "bundle").sortWithinPartitions("bundle", "frame", "offset")
    return rows.mapInPandas(read, schema)


def archived_pages(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes the pages and reads the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Digests are computed anew from the payloads read (``read_records``); a revisit takes the size of the
    response it refers to, whose digest must be its own.
    """
    read = read_records(write_archives(pages, least_bytes=least_bytes))
    rows = saved(read.select("page_id", "record_type", "refers_to", "digest", F.octet_length("payload").cast("long").alias("size")), "records")
    responses = rows.where("record_type = 'response'").groupBy(F.col("page_id").alias("to"), F.col("digest").alias("to_digest")).agg(F.max("size").alias("to_size"))
    revisits = rows.where("record_type = 'revisit'").join(saved(responses, "responses"), (F.col("refers_to") == F.col("to")) & (F.col("digest") == F.col("to_digest")), "left")
    size = F.coalesce("to_size", F.raise_error(F.lit("a revisit's response is missing")).cast("long"))
    revisits = revisits.select("page_id", size.alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to")
    return rows.where("record_type = 'response'").select("page_id", F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to").union(revisits)
