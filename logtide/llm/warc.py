"""WARC archives: writing with revisits, and a reader that salvages what damage has left.

Each record is a gzip member of its own. Records with equal payloads of at least ``least_bytes`` are
written once, as the response with the smallest id; the others revisit it. Which is which is settled on (id,
digest) rows; payloads meet the decision by id, so a payload that a third of all pages share makes no hot key.

Files are written by Spark's text writer: a row is one member and the first ten bytes of an empty member, and
the line separator is the rest of that empty member, so the files are plain multi-member gzip.

The reader checks every member (its checksum, header, content length and block digest). Where a check fails, it looks for
the next member that passes, or the next version line of an uncompressed record, takes up again there, and
reports the bytes between as a gap with the reason. Archives are read whole, one a time; the writer keeps
them near ``archive_bytes`` of payload.

Null payloads are empty. A row without an id is always a response and named by null. Rows that repeat an id and a
payload give records alike. Line breaks in a URL are written as %0D and %0A. Columns besides id, url and payload
are ignored. An empty table gives no archives.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logtide.llm.words import slices

DATE = "2024-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
EMPTY_MEMBER = bytes([0x1F, 0x8B, 8, 0, 0, 0, 0, 0, 0, 3])
#: The rest of an empty member: an empty block, checksum 0, length 0.
SEPARATOR = "\x03" + "\x00" * 9
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ALPHABET_16, ALPHABET_32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1, from five hex digits (four characters) at a time."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), ALPHABET_16, ALPHABET_32)


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(name: str, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One compressed record; a revisit has the HTTP header only."""
    block = HTTP + payload if refers_to is None else HTTP
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": (url or "").replace("\r", "%0D").replace("\n", "%0A"),
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Block-Digest": _digest(block),
        "X-Page-Id": name,
        "X-Payload-Length": str(len(payload)),
    }
    if refers_to is not None:
        head |= {
            "WARC-Profile": PROFILE,
            "WARC-Refers-To": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, refers_to)}>",
            "X-Refers-To-Page": refers_to,
        }
    head["Content-Length"] = str(len(block))
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items() if v) + "\r\n"
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(text.encode() + block + b"\r\n\r\n") + squeeze.flush()


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "payload"):
        rows = zip(*(part.column(k).to_pylist() for k in range(5)))
        made = [
            record_bytes("" if name is None else str(name), url, payload, digest, None if refers is None else str(refers)) + EMPTY_MEMBER
            for name, url, payload, digest, refers in rows
        ]
        yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["record"])


def write_warc(
    pages: DataFrame, path: str, least_bytes: int = 0, archive_bytes: int = 16 << 20,
    id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
) -> None:
    """Write one record for each row below ``path``."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    ids = pages.select(F.col(id_col).alias("id"), base32_sha1(payload).alias("digest"), F.octet_length(payload).alias("size"))
    known = ids.where("id IS NOT NULL").distinct()
    firsts = known.where(F.col("size") >= least_bytes).groupBy("digest").agg(F.min("id").alias("first"))
    revisits = known.join(firsts, "digest").where("id <> first").select(F.col("id").alias("_id"), F.col("digest").alias("_digest"), "first")
    total = ids.agg(F.sum("size")).first()[0] or 0
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"), base32_sha1(payload).alias("digest"))
    decided = rows.join(revisits, (F.col("id") == F.col("_id")) & (F.col("digest") == F.col("_digest")), "left")
    decided = decided.select("id", "url", "payload", "digest", "first")
    per_file = max(1, archive_bytes * max(1, pages.count()) // max(total, 1))
    made = decided.mapInArrow(_records, "record binary").select(F.col("record").cast("string").alias("value"))
    made.write.option("lineSep", SEPARATOR).option("maxRecordsPerFile", per_file).text(path)


#: The longest header of a record, so that a false version line is not searched for its end far and wide.
HEADER_BYTES = 1 << 16


class Damage(Exception):
    """Why the bytes at a place are no sound record."""


def parse_record(data: bytes, place: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Header, block and end of the record at ``place``."""
    if not data.startswith(b"WARC/1.", place):
        raise Damage("no version line")
    end = data.find(b"\r\n\r\n", place, place + HEADER_BYTES)
    if end < 0:
        raise Damage(f"header without end within {HEADER_BYTES} bytes")
    head = {}
    for line in data[place:end].decode("utf-8", "replace").split("\r\n")[1:]:
        key, colon, value = line.partition(":")
        if not colon:
            raise Damage("malformed header line")
        head[key.strip().lower()] = value.strip()
    if not head.get("content-length", "").isdigit():
        raise Damage("no content length")
    size = int(head["content-length"])
    block = data[end + 4 : end + 4 + size]
    if len(block) < size or data[end + 4 + size : end + 8 + size] != b"\r\n\r\n":
        raise Damage("block does not end where its length says")
    if head.get("warc-block-digest", "sha1:").startswith("sha1:") and "warc-block-digest" in head and head["warc-block-digest"] != _digest(block):
        raise Damage("block digest differs")
    return head, block, end + 8 + size


def _member(data: memoryview) -> tuple[bytes, int]:
    """Contents and length of the gzip member at the start of ``data``."""
    inflate = zlib.decompressobj(31)
    try:
        out = inflate.decompress(data)
    except zlib.error as problem:
        raise Damage(f"gzip: {problem}") from None
    if not inflate.eof:
        raise Damage("gzip: member is cut off")
    return out, len(data) - len(inflate.unused_data)


def _at(data: bytes, place: int) -> tuple[list[tuple[dict[str, str], bytes]], int]:
    """Sound records at ``place`` and where they end."""
    if data[place : place + 3] == b"\x1f\x8b\x08":
        head = data[place : place + 10]
        if len(head) == 10 and (head[3] & 0xE0 or head[8] not in (0, 2, 4) or 13 < head[9] < 255):
            raise Damage("gzip: no member has such a header")
        # a member is rarely long: give the inflater a little first
        window = 1 << 16
        while True:
            view = memoryview(data)[place : place + window]
            try:
                contents, length = _member(view)
                break
            except Damage as problem:
                if "cut off" not in str(problem) or place + window >= len(data):
                    raise
                window *= 8
        found, at = [], 0
        while at < len(contents):
            head, block, at = parse_record(contents, at)
            found.append((head, block))
        return found, place + length
    head, block, end = parse_record(data, place)
    return [(head, block)], end


def salvage(data: bytes) -> Iterator[tuple[int, dict[str, str] | None, bytes, int, str]]:
    """(offset, header, block, 0, "") for sound records; (offset, None, b"", length, reason) for gaps."""
    place, gap, reason = 0, None, ""
    marks = {b"\x1f\x8b\x08": -1, b"WARC/1.": -1}  # the next place of each, found anew only once it is passed
    while place < len(data):
        try:
            found, end = _at(data, place)
        except Damage as problem:
            if gap is None:
                gap, reason = place, str(problem)
            for mark, at in marks.items():
                if at <= place:
                    found_at = data.find(mark, place + 1)
                    marks[mark] = len(data) if found_at < 0 else found_at
            place = min(marks.values())
            continue
        if not found and gap is not None:
            place = end  # an empty member proves nothing
            continue
        if gap is not None:
            yield gap, None, b"", place - gap, reason
            gap = None
        for head, block in found:
            yield place, head, block, 0, ""
        place = end
    if gap is not None:
        yield gap, None, b"", len(data) - gap, reason


READ = (
    "archive string, offset long, gap_bytes long, reason string, record_type string, record_id string, refers_to string, url string,"
    " payload_digest string, payload_bytes long, payload binary, headers map<string,string>"
)


def _row(archive: str, found) -> dict:
    offset, head, block, gap, reason = found
    row = {"archive": archive, "offset": offset}
    if head is None:
        return row | {"gap_bytes": gap, "reason": reason}
    payload = block.split(b"\r\n\r\n", 1)[-1] if head.get("content-type", "").startswith("application/http") else block
    full = head.get("warc-type") != "revisit"
    return row | {
        "record_type": head.get("warc-type"),
        "record_id": head.get("x-page-id", head.get("warc-record-id")),
        "refers_to": head.get("x-refers-to-page"),
        "url": head.get("warc-target-uri"),
        "payload_digest": _digest(payload)[5:] if full else head.get("warc-payload-digest", "").removeprefix("sha1:"),
        "payload_bytes": len(payload) if full else int(head.get("x-payload-length", 0)),
        "payload": payload if full else None,
        "headers": list(head.items()),
    }


def _read(batches: Iterator[pa.RecordBatch], strict: bool = False) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("archive", pa.string()), ("offset", pa.int64()), ("gap_bytes", pa.int64()), ("reason", pa.string()),
        ("record_type", pa.string()), ("record_id", pa.string()), ("refers_to", pa.string()), ("url", pa.string()),
        ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()), ("headers", pa.map_(pa.string(), pa.string())),
    ])
    for batch in batches:
        for k in range(batch.num_rows):
            archive, data = batch.column(0)[k].as_py(), batch.column(1)[k].as_buffer().to_pybytes()
            rows, size = [], 0
            for found in salvage(data):
                if strict and found[1] is None:
                    raise ValueError(f"{archive}: {found[3]} damaged bytes at {found[0]}: {found[4]}")
                rows.append(_row(archive, found))
                size += len(found[2])
                if size >= 2 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)


def read_warc(spark: SparkSession, path: str, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Records and quarantined gaps of all archives below ``path``; with ``strict``, a gap is an error."""
    archives = spark.read.format("binaryFile").load(path).select("path", "content")
    found = archives.mapInArrow(partial(_read, strict=strict), READ)
    records = found.where("gap_bytes IS NULL").drop("gap_bytes", "reason")
    return records, found.where("gap_bytes IS NOT NULL").select("archive", "offset", "gap_bytes", "reason")
