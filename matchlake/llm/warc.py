"""WARC archives: one gzip member a record, written by Spark's own committers, and a sequential reader.

A member ends with the four bytes of its length, of which the last is 0 below 16 MB. Records are kept below that (longer
payloads go on in continuation records), so members can be written as text lines that end in a zero byte: the files are
plain concatenated members in any file system that Spark writes to, and a lost task leaves nothing behind.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shipped

#: Payload bytes of a record; the rest follows in continuation records.
SEGMENT_BYTES = 8 << 20
#: An archive is closed when it has this many bytes.
ARCHIVE_BYTES = 16 << 20
#: What the reader hands to the decompressor at a time.
CHUNK_BYTES = 64 << 10
#: Copies of payloads of at least this many bytes are written as revisits.
REVISIT_BYTES = 0

HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
DATE = "2026-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary, intact boolean"


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def member(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as one gzip member."""
    fields = [*fields, ("WARC-Block-Digest", "sha1:" + base32_sha1(hashlib.sha1(block).digest())), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    out = packer.compress(head.encode()) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()
    if out[-1]:
        raise ValueError("a record must stay below 16 MB")
    return out


def record_id(page_id: int | None, salt: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{salt}')}>"


def members(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> list[bytes]:
    """The record of a page: a response, in segments if it is long, or a revisit of `refers_to`."""
    digest = base32_sha1(hashlib.sha1(payload).digest())
    own = record_id(page_id, digest)
    target = quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else f"urn:page:{page_id}"
    common = [("WARC-Date", DATE), ("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha1:{digest}"),
              ("X-Payload-Length", str(len(payload)))] + ([("X-Page-Id", str(page_id))] if page_id is not None else [])
    http = ("Content-Type", "application/http; msgtype=response")
    if refers_to is not None:
        return [member([("WARC-Type", "revisit"), ("WARC-Record-ID", own), *common, ("WARC-Profile", PROFILE),
                        ("WARC-Refers-To", record_id(refers_to, digest)), ("X-Refers-To-Page-Id", str(refers_to)), http], HTTP % len(payload))]
    pieces = [payload[i:i + SEGMENT_BYTES] for i in range(0, len(payload), SEGMENT_BYTES)] or [b""]
    first = [("WARC-Type", "response"), ("WARC-Record-ID", own), *common, http]
    out = [member(first + ([("WARC-Segment-Number", "1")] if len(pieces) > 1 else []), HTTP % len(payload) + pieces[0])]
    for k, piece in enumerate(pieces[1:], 2):
        rest = [("WARC-Segment-Total-Length", str(len(HTTP % len(payload)) + len(payload)))] if k == len(pieces) else []
        out.append(member([("WARC-Type", "continuation"), ("WARC-Record-ID", record_id(page_id, f"{digest}:{k}")), *common,
                           ("WARC-Segment-Number", str(k)), ("WARC-Segment-Origin-ID", own), *rest], piece))
    return out


def write(pages: DataFrame, path: str, *, page_id: str = "page_id", url: str = "url", html: str = "html",
          revisit_bytes: int = REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Archives of all `pages` in the folder `path`, a sub-folder for each.

    Of pages with equal payloads (of at least `revisit_bytes`), the one with the largest id is the response and the others
    revisit it; rows that repeat that id are responses too. A null html is an empty payload; a null id is left out of the
    record and never is what others refer to, unless all ids are null: then all are responses. Further columns are ignored.
    """
    spark = shipped(pages.sparkSession)
    full = pages.select(F.col(page_id).cast("long").alias("i"), F.col(url).cast("string").alias("u"),
                        F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8").alias("p")).withColumn("d", F.sha1("p"))
    heads = full.where(F.octet_length("p") >= revisit_bytes).groupBy("d").agg(F.max("i").alias("h"), F.count("*").alias("n"))
    joined = full.join(heads.where("n > 1").select("d", "h"), "d", "left") \
        .select("i", "u", "p", F.when(F.col("h").isNotNull() & ~F.col("h").eqNullSafe(F.col("i")), F.col("h")).alias("r"))

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        archive, size = 0, 0
        for batch in batches:
            names, lines, held = [], [], 0
            for i, u, p, r in zip(*(c.to_pylist() for c in batch.columns)):
                line = b"".join(members(i, u, p, r))
                if size and size + len(line) > archive_bytes:
                    archive, size = archive + 1, 0
                size += len(line)
                held += len(line)
                names.append(f"{task:06d}-{archive:05d}")
                lines.append(line[:-1])  # the writer ends a line with the zero byte that ends the member
                if held > archive_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(lines, pa.binary())], ["archive", "line"])
                    names, lines, held = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(lines, pa.binary())], ["archive", "line"])

    joined.mapInArrow(records, "archive string, line binary").select("archive", F.col("line").cast("string").alias("value")) \
        .write.partitionBy("archive").option("lineSep", "\0").option("compression", "none").text(path)


@dataclass
class Record:
    """A record as read: header fields, its block's payload, whether lengths and digests agree."""

    fields: dict[str, str]
    payload: bytes
    intact: bool


@dataclass
class _Page:
    """A page that is being put together from its segments."""

    fields: dict[str, str]
    parts: list[bytes] = field(default_factory=list)
    intact: bool = True


def records(chunks: Iterable[bytes]) -> Iterator[Record]:
    """Records of an archive that comes in chunks of any size: one member after the other is decompressed as it comes in."""
    chunks = iter(chunks)
    pending = b""
    while True:
        while not pending:
            pending = next(chunks, None)
            if pending is None:
                return
        unpacker = zlib.decompressobj(31)
        head, need, block, digest = bytearray(), None, [], hashlib.sha1()
        fields: dict[str, str] = {}
        while not unpacker.eof:
            if not pending:
                pending = next(chunks, None)
                if pending is None:
                    raise EOFError("the archive ends inside a record")
            data = unpacker.decompress(pending)
            pending = unpacker.unused_data
            if need is None:
                head += data
                end = head.find(b"\r\n\r\n")
                if end < 0:
                    continue
                lines = bytes(head[:end]).decode().split("\r\n")
                if not lines[0].startswith("WARC/"):
                    raise ValueError("not a WARC record")
                fields = dict(x.split(": ", 1) for x in lines[1:])
                need = int(fields["Content-Length"])
                data = bytes(head[end + 4:])
            part = data[:need]
            need -= len(part)
            digest.update(part)
            block.append(part)
        whole = b"".join(block)
        intact = need == 0 and fields.get("WARC-Block-Digest") == "sha1:" + base32_sha1(digest.digest())
        if fields["WARC-Type"] in ("response", "revisit"):
            whole = whole[whole.find(b"\r\n\r\n") + 4:]
        yield Record(fields, whole, intact)


def pages_of(chunks: Iterable[bytes]) -> Iterator[dict]:
    """Pages of an archive: segments joined, lengths and payload digests checked."""
    held: _Page | None = None

    def done(page: _Page) -> dict:
        f, payload = page.fields, b"".join(page.parts)
        digest = f["WARC-Payload-Digest"].removeprefix("sha1:")
        length, revisit = int(f["X-Payload-Length"]), f["WARC-Type"] == "revisit"
        intact = page.intact and (revisit or (length == len(payload) and digest == base32_sha1(hashlib.sha1(payload).digest())))
        number = lambda k: int(f[k]) if k in f else None
        return {"page_id": number("X-Page-Id"), "url": f["WARC-Target-URI"], "record_type": f["WARC-Type"],
                "refers_to": number("X-Refers-To-Page-Id"), "payload_bytes": length, "payload_digest": digest,
                "payload": None if revisit else payload, "intact": intact}

    for record in records(chunks):
        if record.fields["WARC-Type"] == "continuation":
            if held is None or record.fields["WARC-Segment-Origin-ID"] != held.fields["WARC-Record-ID"]:
                raise ValueError("a continuation without its beginning")
            held.parts.append(record.payload)
            held.intact &= record.intact
            continue
        if held is not None:
            yield done(held)
        held = _Page(record.fields, [record.payload], record.intact)
    if held is not None:
        yield done(held)


def read(spark: SparkSession, path: str, *, payload: bool = True) -> DataFrame:
    """Every page of the archives below `path`, in `RECORDS`; a revisit has no payload of its own. A folder without
    archives gives no rows."""
    shipped(spark)
    kind = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                      ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()), ("intact", pa.bool_())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                data = memoryview(content.as_buffer())
                held, size = [], 0
                for page in pages_of(bytes(data[i:i + CHUNK_BYTES]) for i in range(0, len(data), CHUNK_BYTES)):
                    size += len(page["payload"] or b"") + 200
                    held.append(page if payload else page | {"payload": None})
                    if size > ARCHIVE_BYTES:
                        yield pa.RecordBatch.from_pylist(held, kind)
                        held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, kind)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(rows, RECORDS)
