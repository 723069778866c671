"""WARC archives: one gzip member a record, written by Spark, read back by a salvaging scan.

Writing. A row of Spark's text writer is a segment of whole members. A gzip member ends
with the high byte of its length, which is 0 below 16 MB (a longer record is followed by
an empty member), so the segment goes out without that byte and the line separator, set
to byte 0, puts it back: the files are plain gzip, and Spark's own commit protocol makes
them whole when executors are lost. Files hold ``FILE_SEGMENTS`` segments of about
``SEGMENT_BYTES``.

Reading. A file is scanned from its start: gzip checksum and length, version line, header
end, content length, closing lines, block and payload digests. After a failed check the
scan looks for the next place where a valid member (in plain archives: a valid version
line) begins, goes on there, and reports the bytes in between as a quarantined gap. A
damaged member that still unpacks in part gives the whole records of that part.

Memory of a reading task grows with the archives, which the writer bounds; of foreign
archives, one file must fit.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions.scratch import written

SEGMENT_BYTES, FILE_SEGMENTS = 4 << 20, 4
LEAST_BYTES = 0
#: A digest of more than this share of all rows is hot; there are at most as many as its inverse.
HOT_SHARE = 1e-3
DATE = "2024-01-01T00:00:00Z"
#: Fixed values of the format.
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
GZIP = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HEAD_END = re.compile(rb"\r\n(\r\n|WARC/1\.[01]\r\n)")
_FEED = 1 << 16
_LEVEL = 6


def digest_of(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---- one record ------------------------------------------------------------------------


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """A response record, or a revisit record that holds the HTTP head only."""
    # Control characters would end a header line.
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "urn:none")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{_urn(page_id)}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {uri}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
        f"WARC-Block-Digest: sha1:{digest_of(block)}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{_urn(refers_to)}>"]
    lines.append(f"Content-Length: {len(block)}")
    head = "\r\n".join(lines).encode("utf-8", "surrogatepass")
    return head + b"\r\n\r\n" + block + b"\r\n\r\n"


def _urn(page_id: int | None) -> str:
    return f"urn:page:{'none' if page_id is None else page_id}"


def _page(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def member(data: bytes) -> bytes:
    """Gzip members that hold ``data`` and end with a zero byte."""
    packed = gzip.compress(data, _LEVEL, mtime=0)
    return packed if packed[-1] == 0 else packed + gzip.compress(b"", mtime=0)


class Damaged(ValueError):
    """A check of a record or member failed."""


def parse(data: bytes | memoryview, at: int) -> tuple[dict[str, str], int, int, int]:
    """(headers, block start, block end, end) of the record at ``at``; Damaged if a check fails."""
    data = memoryview(data)
    if not VERSION.match(data, at):
        raise Damaged("no version line")
    # A version line inside a header is a line without colon: no header is searched beyond the next
    # one, so that trying many version lines costs time in proportion to the content.
    found = _HEAD_END.search(data, at)
    if found is None:
        raise Damaged("header without end")
    if found[1] != b"\r\n":
        raise Damaged("header line without colon")
    head_end = found.start()
    headers = {}
    for line in bytes(data[at:head_end]).decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise Damaged("header line without colon")
        headers[name.strip().lower()] = value.strip()
    if not re.fullmatch(r"\d{1,18}", headers.get("content-length", ""), re.ASCII):
        raise Damaged("no content length")
    start = head_end + 4
    end = start + int(headers["content-length"])
    if bytes(data[end : end + 4]) != b"\r\n\r\n":
        raise Damaged("record does not end where its length says")
    block = bytes(data[start:end])
    _check(headers.get("warc-block-digest"), block, "block")
    if headers.get("warc-type") == "response":
        _check(headers.get("warc-payload-digest"), payload_of(headers, block), "payload")
    return headers, start, end, end + 4


def _check(claimed: str | None, content: bytes, name: str) -> None:
    """A digest that is not there, or of another kind, is not checked."""
    if claimed and claimed.lower().startswith("sha1:") and claimed[5:].strip().upper() != digest_of(content):
        raise Damaged(f"{name} digest differs")


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    """What follows the HTTP head; the whole block of other contents."""
    if not headers.get("content-type", "").lower().startswith("application/http"):
        return block
    _, found, payload = block.partition(b"\r\n\r\n")
    return payload if found else b""


# ---- salvage ---------------------------------------------------------------------------


def unpack(data: memoryview, at: int) -> tuple[bytes, int, str | None]:
    """(content, end, fault) of the gzip member at ``at``; with a fault, the part before it."""
    reader, out, pos = zlib.decompressobj(31), [], at
    try:
        while not reader.eof:
            if pos >= len(data):
                return b"".join(out), len(data), "member is cut off"
            piece = data[pos : pos + _FEED]
            out.append(reader.decompress(piece))
            pos += len(piece)
    except zlib.error as error:
        return b"".join(out), pos, f"gzip: {error}"
    return b"".join(out), pos - len(reader.unused_data), None


Found = tuple[str, int, int, str | None, dict[str, str], bytes]


def _records(content: bytes, at: int, end: int, fault: str | None) -> Iterator[Found]:
    """Records of plain content, and its gaps; ``at`` and ``end`` are where it stands in the file."""
    pos = 0
    while pos < len(content):
        try:
            headers, start, stop, after = parse(content, pos)
        except Damaged as error:
            after = _next_version(content, pos + 1)
            yield "gap", at, end, fault or str(error), {}, content[pos:after]
        else:
            yield "record", at, end, None, headers, content[start:stop]
        pos = after


def _next_version(content: bytes | memoryview, at: int) -> int:
    """The next version line where all checks hold, or the end."""
    for found in VERSION.finditer(content, at):
        try:
            parse(content, found.start())
            return found.start()
        except Damaged:
            continue
    return len(content)


def _next_start(data: memoryview, at: int) -> int:
    """The next member whose checks hold and that begins with a record, or a valid plain record."""
    for found in re.compile(re.escape(GZIP) + b"|" + VERSION.pattern).finditer(data, at):
        place = found.start()
        content, fault = data, None
        if found[0] == GZIP:
            content, _, fault = unpack(data, place)
            inner = 0
        else:
            inner = place
        if fault is None:
            try:
                parse(content, inner)
                return place
            except Damaged:
                continue
    return len(data)


def scan(content: bytes) -> Iterator[Found]:
    """(kind, start, end, reason, headers, block) of all records and gaps of an archive, in order.

    Records of a gzip member have the place of the member. A gap is a stretch of the file
    that no valid record covers, or the part of a member that none does (then with the
    place of the member, and its bytes as the block).
    """
    data, at = memoryview(content), 0
    while at < len(data):
        if bytes(data[at : at + 3]) == GZIP:
            inside, end, fault = unpack(data, at)
            if fault is not None:
                # What did unpack may hold whole records; the search goes on behind the bad start.
                end = _next_start(data, at + 1)
                kept = [f for f in _records(inside, at, end, fault) if f[0] == "record"]
                yield from kept
                yield "gap", at, end, fault, {}, bytes(data[at:end])
            else:
                yield from _records(inside, at, end, None)
            at = end
            continue
        try:
            headers, start, stop, end = parse(data, at)
            yield "record", at, end, None, headers, bytes(data[start:stop])
        except Damaged as error:
            end = _next_start(data, at + 1)
            yield "gap", at, end, str(error), {}, bytes(data[at:end])
        at = end


# ---- tables ----------------------------------------------------------------------------

_READ = (
    "file string, kind string, start long, end long, reason string, record_type string, page_id long, "
    "refers_to long, uri string, payload_digest string, payload_bytes long, block binary"
)
_HTTP_LENGTH = re.compile(rb"(?im)^content-length:[ \t]*(\d{1,18})\r?$")


def _row(file: str, found: Found, with_blocks: bool) -> tuple:
    kind, start, end, reason, headers, block = found
    if kind == "gap":
        return (file, kind, start, end, reason, None, None, None, None, None, len(block), block if with_blocks else None)
    claimed = headers.get("warc-payload-digest", "")
    digest = claimed[5:].strip().upper() if claimed.lower().startswith("sha1:") else None
    if headers.get("warc-type") == "revisit":
        # The payload stands in the record referred to; its length is in the HTTP head kept here.
        length = _HTTP_LENGTH.search(block.partition(b"\r\n\r\n")[0])
        size = int(length[1]) if length else None
    else:
        payload = payload_of(headers, block)
        size, digest = len(payload), digest or digest_of(payload)
    return (
        file, kind, start, end, None, headers.get("warc-type"), _page(headers.get("warc-record-id")),
        _page(headers.get("warc-refers-to")), headers.get("warc-target-uri"), digest, size, block if with_blocks else None,
    )


def read_archives(spark: SparkSession, path: str, with_blocks: bool = False) -> DataFrame:
    """All records and quarantined gaps of the archives below ``path``, one row each.

    ``kind`` is record or gap. ``start`` and ``end`` are places in the file (of the gzip
    member, if there is one); gaps give the ``reason`` and in ``payload_bytes`` how many
    bytes (inside a sound member: of its content) no record covers. ``block`` is only filled
    with ``with_blocks``. Empty files and folders give no rows.
    """
    columns = [c.split()[0] for c in _READ.split(", ")]

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for file, content in zip(frame["path"], frame["content"]):
                rows, held = [], 0
                for found in scan(content):
                    rows.append(_row(file, found, with_blocks))
                    held += len(found[5]) if with_blocks else 1000
                    if held > SEGMENT_BYTES:
                        yield pd.DataFrame(rows, columns=columns)
                        rows, held = [], 0
                yield pd.DataFrame(rows, columns=columns)

    files = spark.read.format("binaryFile").load(path)
    return files.select("path", "content").mapInPandas(read, _READ)


def _typed(pages: DataFrame, least_bytes: int, hot_share: float) -> DataFrame:
    """page_id, url, html, revisit and refers_to: the largest page_id of equal payloads is the response.

    Pages of a hot digest find it in a broadcast of at most 1 / ``hot_share`` rows, so that
    no task of the join gets more than that share of them.
    """
    html = F.coalesce("html", F.lit("")).cast("binary")
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"))
    keyed = own.withColumn("__sha1", F.sha1("html"))
    rows = keyed.count()
    least = F.length("html") >= least_bytes
    shared = (
        keyed.where(least).groupBy("__sha1").agg(F.max("page_id").alias("__first"), F.count(F.lit(1)).alias("__n")).where("__n > 1")
    )
    shared = written(shared, "shared-payloads")
    hot = shared.where(F.col("__n") > max(hot_share * rows, 1)).select("__sha1", F.col("__first").alias("__hot"))
    cold = shared.where(F.col("__n") <= max(hot_share * rows, 1)).select("__sha1", F.col("__first").alias("__cold"))
    # A page that has found its digest takes no part in the second join.
    found = keyed.join(F.broadcast(hot), "__sha1", "left")
    rest = F.when(F.col("__hot").isNull() & least, F.col("__sha1"))
    spread = F.coalesce(rest, F.concat(F.lit("-"), F.xxhash64("page_id").cast("string")))
    joined = found.withColumn("__key", spread).join(cold.withColumnRenamed("__sha1", "__key"), "__key", "left")
    first: Column = F.when(least, F.coalesce("__hot", "__cold"))
    revisit = first.isNotNull() & ~F.col("page_id").eqNullSafe(first)
    return joined.select("page_id", "url", "html", revisit.alias("revisit"), F.when(revisit, first).alias("refers_to"))


def write_archives(
    pages: DataFrame,
    path: str,
    least_bytes: int = LEAST_BYTES,
    hot_share: float = HOT_SHARE,
    segment_bytes: int = SEGMENT_BYTES,
    file_segments: int = FILE_SEGMENTS,
) -> None:
    """Write a record per row of ``pages`` (page_id, url, html) to gzip archives in the folder ``path``.

    The payload is html in UTF-8 (missing: empty). Of rows with equal payloads of at least
    ``least_bytes`` that with the largest page_id is a response (of repeated rows each; a
    missing page_id counts as smallest), the others revisit it; smaller payloads are all
    responses. Other columns are not read. A file holds ``file_segments`` segments of about
    ``segment_bytes``, one longer record each at most beyond that. No rows give no records.
    """

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, held = [], 0
        for frame in frames:
            for page, url, html, revisit, refers in zip(*(frame[c] for c in ("page_id", "url", "html", "revisit", "refers_to"))):
                number = [None if pd.isna(v) else int(v) for v in (page, refers)]
                parts.append(member(record(number[0], url, html, number[1], bool(revisit))))
                held += len(parts[-1])
                if held >= segment_bytes:
                    yield pd.DataFrame({"segment": [b"".join(parts)[:-1]]})
                    parts, held = [], 0
        if parts:
            yield pd.DataFrame({"segment": [b"".join(parts)[:-1]]})

    segments = _typed(pages, least_bytes, hot_share).mapInPandas(pack, "segment binary")
    (
        segments.select(F.col("segment").cast("string").alias("value"))
        .write.option("lineSep", "\0")
        .option("maxRecordsPerFile", file_segments)
        .text(path)
    )
