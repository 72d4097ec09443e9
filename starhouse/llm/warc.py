"""WARC archives: written as records with segmented payloads, read back and reassembled.

Every page becomes a ``response`` record whose block is an HTTP message with the payload in chunked
transfer framing; a page whose payload equals that of a smaller page id becomes a ``revisit`` record
that refers to it. Blocks longer than ``segment_bytes`` are cut: the first segment keeps the record's
type, the others are ``continuation`` records with the origin's id, their segment number and, on
the last one, the total length. Reading groups continuation records by origin id, orders them by
segment number, verifies numbers and total length, and decodes the chunked framing.

Defined cases: a null payload is empty; empty payloads are equal payloads like any others. Payloads
shorter than ``min_revisit_bytes`` are never revisits. Rows that repeat the smallest page id are
all responses; a null page id is larger than any other, and if no id is known all are responses.
A set of segments that is incomplete, repeated or of a wrong length gives a row with a null payload
and ``complete`` false. An empty table gives no records. Other columns are not archived.

Archive files are written and read by Spark in a shared folder: a record is a row of a text file
whose line end is the record end of the format, so each file is a plain WARC file (gzip as a
whole). A hot payload costs one row per task when its smallest id is found. Whole records are
reduced to digests where they are read; only the segments of long records are shuffled.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starhouse.llm.arrow import text_slices
from starhouse.session import scratch_path

SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
RECORDS_PER_FILE = 5_000

_END = "\r\n"
_EPOCH = "1970-01-01T00:00:00Z"  # archives of the same rows are the same bytes


def _sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _characters(raw: bytes, start: int, size: int) -> int:
    """The end of a piece of at most ``size`` bytes that cuts no UTF-8 character."""
    end = min(start + size, len(raw))
    while end < len(raw) and raw[end] & 0xC0 == 0x80:
        end -= 1
    return end


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing."""
    out, at = [], 0
    while at < len(payload):
        end = _characters(payload, at, max(size, 4))
        out.append(b"%x\r\n%b\r\n" % (end - at, payload[at:end]))
        at = end
    return b"".join(out) + b"0\r\n\r\n"


def dechunked(framed: bytes) -> bytes:
    """Inverse of :func:`chunked`; chunk extensions and trailers are ignored."""
    out, at = [], 0
    while True:
        line = framed.index(b"\r\n", at)
        size = int(framed[at:line].split(b";")[0], 16)
        at = line + 2
        if not size:
            return b"".join(out)
        out.append(framed[at:at + size])
        if len(out[-1]) != size or framed[at + size:at + size + 2] != b"\r\n":
            raise ValueError("a chunk is shorter than its size")
        at += size + 2


def _record(kind: str, record: str, block: bytes, fields: list[tuple[str, object]]) -> str:
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{record}>"), ("WARC-Date", _EPOCH),
            *((k, v) for k, v in fields if v is not None), ("Content-Length", len(block))]
    return "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + _END + block.decode()


def _records(row: dict, segment_bytes: int) -> Iterator[str]:
    """The records of one page, without their record ends."""
    payload = (row["payload"] or "").encode()
    url = (row["url"] or "").replace("\r", "%0D").replace("\n", "%0A")
    name = row["record"]
    fields = [("WARC-Target-URI", url or None), ("WARC-Payload-Digest", f"sha1:{row['digest']}"),
              ("X-Page-ID", row["page"]), ("X-Payload-Length", len(payload))]
    if row["refers"] is not None:
        block = b"HTTP/1.1 200 OK\r\n\r\n"
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("WARC-Refers-To", f"<urn:page:{row['refers']}>"), ("X-Refers-To-Page", row["refers"])]
        yield _record("revisit", name, block, fields)
        return
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
             b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload))
    if len(block) <= segment_bytes:
        yield _record("response", name, block, fields)
        return
    at, number = 0, 0
    while at < len(block):
        end, number = _characters(block, at, max(segment_bytes, 4)), number + 1
        part = [("WARC-Segment-Number", number)]
        if number > 1:
            part.append(("WARC-Segment-Origin-ID", f"<urn:page:{name}>"))
        if end == len(block):
            part.append(("WARC-Segment-Total-Length", len(block)))
        kind, own = ("response", name) if number == 1 else ("continuation", f"{name}.{number}")
        yield _record(kind, own, block[at:end], (fields if number == 1 else []) + part)
        at = end


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", segment_bytes: int = SEGMENT_BYTES,
                   min_revisit_bytes: int = 0, records_per_file: int = RECORDS_PER_FILE) -> None:
    """One archived page per row of ``pages`` in gzip files below ``path``."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "payload"):
            raw = [(p or "").encode() for p in batch.column("payload").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(map(_sha1, raw), pa.string()),
                 pa.array(map(len, raw), pa.int64())],
                [*batch.schema.names, "digest", "size"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "payload"):
            lines = [r for row in batch.to_pylist() for r in _records(row, segment_bytes)]
            for start in range(0, len(lines), 1000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lines[start:start + 1000], pa.string())], ["value"])

    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page"), F.col(url_col).alias("url"),
        F.col(payload_col).alias("payload"))
    # a record's name tells rows apart that share a page id; identical rows share it and their bytes
    name = F.concat_ws("-", F.coalesce(F.col("page").cast("string"), F.lit("none")),
                       F.hex(F.xxhash64("url", "payload")), F.hex(F.monotonically_increasing_id()))
    kind = "page long, url string, payload string, digest string, size long"
    digested = rows.mapInArrow(digests, kind)
    owners = (
        digested.select("page", "digest", "size").filter(F.col("size") >= min_revisit_bytes)
        .groupBy("digest", "size").agg(F.min("page").alias("owner"), F.count("*").alias("n"))
        .filter("n > 1 AND owner IS NOT NULL").select("digest", "size", "owner"))
    refers = F.when(~F.col("page").eqNullSafe(F.col("owner")), F.col("owner"))
    named = (digested.join(owners, ["digest", "size"], "left")
             .select("page", "url", "payload", "digest", refers.alias("refers"),
                     name.alias("record")))
    (named.mapInArrow(write, "value string").write
     .option("lineSep", _END * 2).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


# Reading ----------------------------------------------------------------------------------

_PARTS = ("origin string, segment int, total long, type string, page long, refers long, "
          "digest string, size long, ok boolean, block binary")
_PAGES = ("page_id long, record_type string, refers_to long, payload_bytes long, "
          "payload_digest string, complete boolean")


def parse(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of the records of one archive."""
    at = 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        version, *lines = raw[at:end].decode().split(_END)
        if not version.startswith("WARC/"):
            raise ValueError("no record starts here")
        fields = dict(line.split(": ", 1) for line in lines)
        start, size = end + 4, int(fields["Content-Length"])
        if raw[start + size:start + size + 4] != b"\r\n\r\n":
            raise ValueError("a record is not as long as it says")
        yield fields, raw[start:start + size]
        at = start + size + 4


def _bare(name: str) -> str:
    return name.removeprefix("<urn:page:").removesuffix(">")


def _payload(block: bytes) -> bytes | None:
    """The payload of an HTTP message; None if its framing is broken."""
    head, _, body = block.partition(b"\r\n\r\n")
    if b"transfer-encoding: chunked" not in head.lower():
        return body
    try:
        return dechunked(body)
    except ValueError:
        return None


def _number(fields: dict[str, str], name: str) -> int | None:
    return int(fields[name]) if name in fields else None


def _part(fields: dict[str, str], block: bytes) -> tuple:
    segment = _number(fields, "WARC-Segment-Number")
    origin = _bare(fields.get("WARC-Segment-Origin-ID", fields["WARC-Record-ID"]))
    page, refers = _number(fields, "X-Page-ID"), _number(fields, "X-Refers-To-Page")
    kind = fields["WARC-Type"]
    if kind == "revisit":
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        return (origin, None, None, kind, page, refers, digest,
                _number(fields, "X-Payload-Length"), True, None)
    if segment is not None:
        return (origin, segment, _number(fields, "WARC-Segment-Total-Length"), kind, page, None,
                None, None, True, block)
    payload = _payload(block)
    if payload is None:
        return origin, None, None, kind, page, None, None, None, False, None
    return origin, None, None, kind, page, None, _sha1(payload), len(payload), True, None


def reassemble(segments: list[tuple[int, int | None, bytes]]) -> bytes | None:
    """The payload of a record's segments (number, total length on the last one, block)."""
    segments = sorted(segments, key=lambda s: s[0])
    totals = [t for _, t, _ in segments if t is not None]
    block = b"".join(b for _, _, b in segments)
    if [n for n, _, _ in segments] != list(range(1, len(segments) + 1)) or totals != [len(block)]:
        return None
    return _payload(block)


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in names]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per archived page: its type, full payload length and digest, and what it refers to."""
    text, long = pa.string(), pa.int64()

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [p.split()[0] for p in _PARTS.split(", ")]
        kinds = [text, pa.int32(), long, text, long, long, text, long, pa.bool_(), pa.binary()]
        for batch in batches:
            for i in range(batch.num_rows):
                raw = gzip.decompress(batch.column("content")[i].as_py())
                rows = [_part(fields, block) for fields, block in parse(raw)]
                for start in range(0, len(rows), 1000):
                    yield _batch(rows[start:start + 1000], names, kinds)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [p.split()[0] for p in _PAGES.split(", ")]
        kinds = [long, text, long, long, text, pa.bool_()]
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                digest, size, ok = r["digest"], r["size"], r["ok"]
                if r["segments"]:
                    payload = reassemble(
                        [(s["segment"], s["total"], s["block"]) for s in r["segments"]])
                    ok = payload is not None
                    digest, size = (_sha1(payload), len(payload)) if ok else (None, None)
                rows.append((r["page"], r["type"], r["refers"], size, digest, ok))
            yield _batch(rows, names, kinds)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    found = files.select("content").mapInArrow(parts, _PARTS)
    segment = F.when(F.col("segment").isNotNull(), F.struct("segment", "total", "block"))
    first = F.col("type") != "continuation"
    records = found.groupBy("origin").agg(
        F.max(F.when(first, F.struct("type", "page", "refers", "digest", "size", "ok"))).alias("r"),
        F.collect_list(segment).alias("segments"),  # at most one payload's segments
    ).select("r.*", "segments")
    return records.mapInArrow(whole, _PAGES)


def archive_and_read(pages: DataFrame, **options) -> DataFrame:
    """Write the pages to a fresh folder in the shared place and read them back."""
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path, **options)
    return read_archives(pages.sparkSession, path)
