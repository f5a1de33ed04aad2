"""WARC archives: writing with revisits, and a reader that salvages damaged ones.

Archives are rows of a table (archive, data): concatenated gzip members, one
record each, or plain records. A table lives in the shared folder like any
other, so executors never exchange local files.

Reading checks each record: the member's own checksum, the version line, the
header lines, Content-Length (of the record and of the HTTP response in it), the
closing blank lines, the block digest and the size that a member unpacks to. After a
failed check the reader searches for the next member (or version line) that
gives a valid record, goes on from there, and logs the bytes between as a
quarantined gap.

Defined results: null payload counts as empty; of records with equal payloads
of at least `least` bytes the one with the smallest identifier, null last, is
the response and the others revisit it; rows that repeat an identifier are
written each, and of such with the smallest identifier one is the response; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import spread_join, stored

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Headers that every record needs.
NEEDED = ("warc-type", "warc-record-id", "warc-date", "content-length")
#: Bytes at which an archive is closed; bytes of a member read at a time; bytes that a member may unpack to; digits of a length.
ARCHIVE, STEP, MEMBER, DIGITS = 8 << 20, 32 << 10, 1 << 30, 18


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data, usedforsecurity=False).digest()).decode()


def urn(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else quote(str(page_id), safe='')}>"


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to=None, revisit: bool | None = None) -> bytes:
    """A response record, or a revisit of refers_to whose block ends after the HTTP header."""
    revisit = refers_to is not None if revisit is None else revisit
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    uri = " ".join((url or "").split())
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {urn(page_id)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}",
        *([f"WARC-Refers-To: {urn(refers_to)}", f"WARC-Profile: {PROFILE}"] if revisit else []),
        "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{sha1_base32(block)}", f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


class Bad(Exception):
    """A failed check."""


def number(text: str) -> int:
    """A length from a header; raises Bad."""
    if not (text.isascii() and text.isdigit() and len(text) <= DIGITS):
        raise Bad("no content length")
    return int(text)


def http_length(block: bytes) -> int | None:
    """Content-Length of an HTTP message, None if it has none; raises Bad."""
    for line in block.partition(b"\r\n\r\n")[0].split(b"\r\n"):
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length":
            return number(value.strip().decode("utf-8", "replace"))
    return None


def parse(data: bytes, at: int = 0, whole: bool = False) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record at a place; raises Bad. whole: nothing may follow."""
    if data[at : at + len(VERSION)] != VERSION:
        raise Bad("no version line")
    head = data.find(b"\r\n\r\n", at)
    if head < 0:
        raise Bad("headers do not end")
    headers = {}
    for line in data[at:head].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Bad("broken header line")
        headers[name.decode("utf-8", "replace").lower()] = value.strip().decode("utf-8", "replace")
    if missing := [x for x in NEEDED if x not in headers]:
        raise Bad(f"no {missing[0]}")
    start = head + 4
    end = start + number(headers["content-length"])
    if data[end : end + 4] != b"\r\n\r\n":
        raise Bad("record is cut or its length is wrong")
    block = data[start:end]
    want = headers.get("warc-block-digest", "")
    if want.startswith("sha1:") and want[5:] != sha1_base32(block):
        raise Bad("block digest differs")
    if whole and end + 4 != len(data):
        raise Bad("bytes follow the record")
    if block.startswith(b"HTTP/"):
        http_length(block)
    return headers, block, end + 4


def _member_at(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    z, out, view, p, size = zlib.decompressobj(31), [], memoryview(data), at, 0
    try:
        while not z.eof and p < len(data):  # in steps, as the rest behind a member is copied
            out.append(z.decompress(view[p : p + STEP]))
            p, size = p + STEP, size + len(out[-1])
            if size > MEMBER:
                raise Bad("member unpacks to too many bytes")
    except zlib.error as e:
        raise Bad(f"gzip: {e}") from e
    if not z.eof:
        raise Bad("member is cut")
    headers, block, _ = parse(b"".join(out), 0, whole=True)
    return headers, block, min(p, len(data)) - len(z.unused_data)


def _one(data: bytes, at: int):
    if data[at : at + 3] == MAGIC:
        return _member_at(data, at)
    return parse(data, at)


def salvage(data: bytes) -> Iterator[tuple[str, int, int, str | None, dict[str, str] | None, bytes | None]]:
    """(kind, start, end, reason, headers, block) of an archive: kind is record or gap; together they cover it."""
    at = 0
    while at < len(data):
        try:
            headers, block, end = _one(data, at)
        except Bad as e:
            reason, start, got = str(e), at, None
            at += 1
            while True:  # the next place that gives a valid record
                nexts = [p for p in (data.find(MAGIC, at), data.find(VERSION, at)) if p >= 0]
                if not nexts:
                    at = len(data)
                    break
                at = min(nexts)
                try:
                    got = _one(data, at)
                    break
                except Bad:
                    at += 1
            yield "gap", start, at, reason, None, None
            if got is None:
                return
            headers, block, end = got
        yield "record", at, end, None, headers, block
        at = end


def plan_records(pages: DataFrame, least: int = 0, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """(page_id, url, payload, digest, revisit, refers_to): refers_to is the response's identifier for revisits, else null.

    Rows are told apart by their place in pages, which must come in the same order each time it is read, as files do.
    """
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"), F.sha1(payload).alias("digest"))
    narrow = stored(rows.where(F.octet_length("payload") >= least).select("row", "page_id", "digest"))
    # only groups of two and more need a join; a digest's pages are counted before they are shuffled
    first = F.min(F.struct(F.col("page_id").isNull(), "page_id", "row"))
    groups = narrow.groupBy("digest").agg(first.alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = spread_join(narrow, groups, ["digest"]).where(F.col("row") != F.col("first.row")).select("row", F.lit(True).alias("revisit"), F.col("first.page_id").alias("refers_to"))
    return rows.join(again, "row", "left").withColumn("revisit", F.coalesce("revisit", F.lit(False))).drop("row")


def write_archives(records: DataFrame, compressed: bool = True) -> DataFrame:
    """(archive, data) of plan_records()'s rows."""

    def write(batches):
        context = TaskContext.get()
        task, number, parts, size = context.partitionId() if context else 0, 0, [], 0
        for batch in batches:
            for page, url, payload, digest, revisit, refers in zip(*(batch.column(c).to_pylist() for c in range(6)), strict=True):
                data = record(page, url, payload, base64.b32encode(bytes.fromhex(digest)).decode(), refers, revisit)
                parts.append(member(data) if compressed else data)
                size += len(parts[-1])
                if size >= ARCHIVE:
                    yield pa.record_batch([pa.array([f"{task:06d}-{number:05d}"]), pa.array([b"".join(parts)], pa.binary())], ["archive", "data"])
                    number, parts, size = number + 1, [], 0
        if parts:
            yield pa.record_batch([pa.array([f"{task:06d}-{number:05d}"]), pa.array([b"".join(parts)], pa.binary())], ["archive", "data"])

    return records.select("page_id", "url", "payload", "digest", "revisit", "refers_to").mapInArrow(write, "archive string, data binary")


def _number(uri: str | None) -> str | None:
    """The identifier in a record's name; None for none."""
    return unquote(uri[len("<urn:page:") : -1]) or None if uri and uri.startswith("<urn:page:") else None


def read_archives(archives: DataFrame) -> DataFrame:
    """Records and quarantined gaps of (archive, data): archive, kind, start, end, reason, record_type, page_id, url, refers_to, payload, payload_bytes, payload_digest, digest_ok.

    payload is null for revisits and gaps.
    """
    names = ["archive", "kind", "start", "end", "reason", "record_type", "page_id", "url", "refers_to", "payload", "payload_bytes", "payload_digest", "digest_ok"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 5, pa.binary(), pa.int64(), pa.string(), pa.bool_()]
    schema = "archive string, kind string, start bigint, end bigint, reason string, record_type string, page_id string, url string, refers_to string, payload binary, payload_bytes bigint, payload_digest string, digest_ok boolean"

    def read(batches):
        for batch in batches:
            for archive, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                out = []
                for kind, start, end, reason, headers, block in salvage(data or b""):
                    if kind == "gap":
                        out.append((archive, kind, start, end, reason, *[None] * 8))
                        continue
                    payload = block.partition(b"\r\n\r\n")[2]
                    revisit = headers.get("warc-type") == "revisit"
                    told = headers.get("warc-payload-digest", "").removeprefix("sha1:")
                    told_length = http_length(block) if block.startswith(b"HTTP/") else None
                    length = len(payload) if told_length is None else told_length
                    digest = told if revisit else sha1_base32(payload)
                    out.append((archive, kind, start, end, None, headers.get("warc-type"), _number(headers.get("warc-record-id")), headers.get("warc-target-uri"), _number(headers.get("warc-refers-to")), None if revisit else payload, length if revisit else len(payload), digest, digest == told))
                    if len(out) >= 512:
                        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
                        out = []
                if out:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return archives.select("archive", "data").mapInArrow(read, schema)


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) as the stored archives give them."""
    kind = pages.schema["page_id"].dataType
    archives = stored(write_archives(plan_records(pages, least)))
    got = read_archives(archives).where("kind = 'record'")
    return got.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
