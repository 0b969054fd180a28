"""WARC archives in seekable Zstandard bundles.

Records are grouped into frames that decompress by themselves, and frames into bundles; a bundle ends with a seek
table (a skippable frame, so any Zstandard reader reads the bundle as one stream of records).  The index maps the id of
a record to its bundle, its frame and its place within the frame's content, so a record is read by decompressing one
frame.

Layout of the seek table, integers little-endian: u32 skippable magic, u32 size of what follows; for each frame u32
compressed size, u32 size, u32 checksum (the low half of the XXH64 of the content); then u32 number of frames, u8 with
bit 7 set for checksums, u32 seekable magic.

Of records with equal payloads of at least ``LEAST`` bytes one is stored, the rest are revisits that name it.  Payloads
are told apart by length and sha256; a payload that a third of all pages have is counted before the shuffle, and its
pages are dealt in parts where they meet their first.

Bundles are the rows of a Parquet table in the shared store, because a cluster's store is reached through Spark only;
:func:`export` writes them as files.

Defined results: a null payload is an empty one.  The first of equal payloads is that of the smallest id, a null id
coming last; rows that repeat the first's id (or payloads that no row with an id has) are responses too.  A null
address is left out of the header, blanks and control characters in one are percent-encoded.  Payloads of any length
are kept whole; one longer than a frame has a frame to itself.  An empty table gives no bundles.  Other columns are not
read.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import heavy_join, materialise, settle

#: Payloads below this size are never revisits; content of a frame and of a bundle in bytes; level of compression.
LEAST, FRAME, BUNDLE, LEVEL = 100, 256 << 10, 4 << 20, 3
#: Fixed values of the seekable format: magic of a skippable frame, magic at the end, and the flag of checksums.
SKIPPABLE, SEEKABLE, CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
#: Fixed value: the profile of a revisit to a record of the same payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = re.compile(rb"<urn:page:(-?\d+|null):([0-9a-f]{64})>")


def record_id(page: int | None, digest: str) -> str:
    """The same in every run; of the page's id and the digest of its payload."""
    return f"<urn:page:{'null' if page is None else page}:{digest}>"


def page_of(identifier: bytes) -> int | None:
    page = ID.fullmatch(identifier)[1]
    return None if page == b"null" else int(page)


def write_record(page: int | None, url: str | None, payload: bytes, size: int, digest: str, first: int | None, date: str) -> bytes:
    """One record; with ``first``, a revisit of that page's, which has the headers of its response and no payload.

    ``size`` is the length of the whole payload, which revisits need not be given.
    """
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http if first is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page, digest)}",
        f"WARC-Date: {date}",
        *([] if url is None else ["WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)]),
        f"WARC-Payload-Digest: sha256:{digest}",
        *([] if first is None else [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(first, digest)}"]),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def read_record(content: bytes, at: int = 0) -> tuple[dict[bytes, bytes], bytes, int]:
    """Headers by lower-case name, the block, and where the next record begins."""
    end = content.index(b"\r\n\r\n", at)
    lines = content[at:end].split(b"\r\n")
    if not lines[0].startswith(b"WARC/"):
        raise ValueError(f"no record at byte {at}")
    headers = {k.strip().lower(): v.strip() for k, v in (line.split(b":", 1) for line in lines[1:])}
    start, size = end + 4, int(headers[b"content-length"])
    stop = start + size
    if content[stop : stop + 4] != b"\r\n\r\n":
        raise ValueError(f"the record at byte {at} is cut short")
    return headers, content[start:stop], stop + 4


def payload_of(block: bytes) -> tuple[bytes, int]:
    """The payload in a block, and the length that its response states."""
    end = block.index(b"\r\n\r\n") + 4
    stated = re.search(rb"(?i)\r\ncontent-length:[ \t]*(\d+)", block[:end])
    return block[end:], int(stated[1])


class Bundle:
    """Collects records into frames; ``ids``, ``frame``, ``offset`` and ``length`` say where each lies."""

    def __init__(self) -> None:
        self.frames: list[bytes] = []
        self.table = b""
        self.open: list[bytes] = []
        self.filled = self.size = 0
        self.ids: list[str] = []
        self.frame: list[int] = []
        self.offset: list[int] = []
        self.length: list[int] = []

    def add(self, identifier: str, record: bytes) -> None:
        if self.filled and self.filled + len(record) > FRAME:
            self.close_frame()
        self.ids.append(identifier)
        self.frame.append(len(self.frames))
        self.offset.append(self.filled)
        self.length.append(len(record))
        self.open.append(record)
        self.filled += len(record)
        self.size += len(record)

    def close_frame(self) -> None:
        content = b"".join(self.open)
        body = zstandard.ZstdCompressor(level=LEVEL).compress(content)
        self.frames.append(body)
        self.table += struct.pack("<III", len(body), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF)
        self.open, self.filled = [], 0

    def finish(self) -> bytes:
        if self.open:
            self.close_frame()
        footer = struct.pack("<IBI", len(self.frames), CHECKSUMS, SEEKABLE)
        return b"".join(self.frames) + struct.pack("<II", SKIPPABLE, len(self.table) + len(footer)) + self.table + footer


def seek_table(bundle: bytes) -> np.ndarray:
    """Rows ``start, stop, size, checksum``, one a frame, from the end of a bundle."""
    count, flags, magic = struct.unpack("<IBI", bundle[-9:])
    if magic != SEEKABLE or not flags & CHECKSUMS:
        raise ValueError("no seek table with checksums")
    entries = np.frombuffer(bundle[-9 - 12 * count : -9], "<u4").reshape(-1, 3).astype(np.int64)
    stop = np.cumsum(entries[:, 0])
    return np.column_stack([stop - entries[:, 0], stop, entries[:, 1:]])


def read_frame(bundle: bytes, entry: np.ndarray) -> bytes:
    start, stop, size, checksum = map(int, entry)
    content = zstandard.ZstdDecompressor().decompress(bundle[start:stop], max_output_size=max(1, size))
    if len(content) != size or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != checksum:
        raise ValueError("a frame does not hold what was written")
    return content


def write_archives(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html", date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write bundles; returns ``(part, bundle, body, ids, frame, offset, length)`` as read back from the store."""
    body = F.coalesce(F.col(html).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url).cast("string").alias("url"), body.alias("body"))
    rows = rows.select("*", F.sha2("body", 256).alias("digest"), F.octet_length("body").alias("bytes"))
    alike = rows.where(F.col("bytes") >= LEAST).groupBy("digest").agg(F.min("page").alias("first"), F.count("*").alias("n"))
    alike = materialise(alike.where("n > 1"), "alike")
    joined = heavy_join(rows, alike, ["digest"], "n", how="left")
    first = F.when(F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first")), F.col("first"))
    sent = joined.select("page", "url", F.when(first.isNull(), F.col("body")).alias("body"), "bytes", "digest", first.alias("first"), F.spark_partition_id().alias("part"))
    names = ["part", "bundle", "body", "ids", "frame", "offset", "length"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, number, part = Bundle(), 0, None

        def packed() -> pa.RecordBatch:
            body = bundle.finish()
            ints = [pa.array([x], pa.list_(pa.int32())) for x in (bundle.frame, bundle.offset, bundle.length)]
            return pa.RecordBatch.from_arrays([part, pa.array([number], pa.int32()), pa.array([body], pa.binary()), pa.array([bundle.ids], pa.list_(pa.string())), *ints], names=names)

        for batch in batches:
            part = batch["part"][:1]
            for i in range(batch.num_rows):
                page, address, text, size, digest, first = (batch[c][i].as_py() for c in ("page", "url", "body", "bytes", "digest", "first"))
                record = write_record(page, address, b"" if text is None else text.encode(), size, digest, first, date)
                bundle.add(record_id(page, digest), record)
                if bundle.size >= BUNDLE:
                    yield packed()
                    bundle, number = Bundle(), number + 1
        if bundle.ids:
            yield packed()
        settle()

    return materialise(sent.mapInArrow(run, "part int, bundle int, body binary, ids array<string>, frame array<int>, offset array<int>, length array<int>"), "archives")


def index(archives: DataFrame) -> DataFrame:
    """``(record_id, part, bundle, frame, offset, length)`` of every record; bodies are not read."""
    each = F.explode(F.arrays_zip("ids", "frame", "offset", "length")).alias("r")
    return archives.select("part", "bundle", each).select(F.col("r.ids").alias("record_id"), "part", "bundle", "r.frame", "r.offset", "r.length")


READ = "page long, record_id string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def read_archives(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """Every record of the bundles: ``page, record_id, payload_bytes, payload_digest, record_type, refers_to``.

    The digest of a response is taken of the payload read, which must be the one that its header states; a revisit
    has the length and digest of its response.  ``payload`` (with ``with_payload``) is null for revisits.
    """
    names = [f.split()[0] for f in READ.split(", ")][: 7 if with_payload else 6]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch["body"]:
                bundle = body.as_py()
                for entry in seek_table(bundle):
                    content, at, rows = read_frame(bundle, entry), 0, []
                    while at < len(content):
                        headers, block, at = read_record(content, at)
                        payload, stated = payload_of(block)
                        digest = headers[b"warc-payload-digest"].removeprefix(b"sha256:").decode()
                        kind = headers[b"warc-type"].decode()
                        if kind == "response":
                            if hashlib.sha256(payload).hexdigest() != digest or len(payload) != stated:
                                raise ValueError(f"the payload of {headers[b'warc-record-id']!r} is not the one written")
                            refers = None
                        else:
                            refers, payload = page_of(headers[b"warc-refers-to"]), None
                        identifier = headers[b"warc-record-id"]
                        rows.append((page_of(identifier), identifier.decode(), stated, digest, kind, refers, payload))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), TYPES[: len(names)], strict=False)], names=names)
        settle()

    return archives.select("body").mapInArrow(run, ", ".join(READ.split(", ")[: len(names)]))


TYPES = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())


def fetch(archives: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(record_id, record binary)`` of the ``record_id`` of ``wanted``: only the frames that hold them are decompressed."""
    places = index(archives).join(wanted.select("record_id").distinct(), "record_id")
    asked = places.groupBy("part", "bundle").agg(F.collect_list(F.struct("frame", "offset", "length", "record_id")).alias("places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                bundle, last, content, rows = batch["body"][i].as_py(), -1, b"", []
                table = seek_table(bundle)
                for p in sorted(batch["places"][i].as_py(), key=lambda p: (p["frame"], p["offset"])):
                    if p["frame"] != last:
                        last, content = p["frame"], read_frame(bundle, table[p["frame"]])
                    rows.append((p["record_id"], content[p["offset"] : p["offset"] + p["length"]]))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.binary())], names=["record_id", "record"])

    return archives.select("part", "bundle", "body").join(asked, ["part", "bundle"]).select("body", "places").mapInArrow(run, "record_id string, record binary")


def export(archives: DataFrame, folder: str) -> DataFrame:
    """Write each bundle as ``folder/part-bundle.warc.zst``, in any store that Arrow knows; returns ``(path, bytes)``.

    All machines must reach ``folder``.  A task writes to a name of its own and renames, so that one that runs again replaces what it wrote.
    """
    from pyarrow import fs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        for batch in batches:
            for i in range(batch.num_rows):
                path, body = f"{root}/{batch['part'][i].as_py():05d}-{batch['bundle'][i].as_py():05d}.warc.zst", batch["body"][i].as_py()
                with store.open_output_stream(path + ".writing") as out:
                    out.write(body)
                store.move(path + ".writing", path)
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([len(body)], pa.int64())], names=["path", "bytes"])

    return archives.select("part", "bundle", "body").mapInArrow(run, "path string, bytes long")
