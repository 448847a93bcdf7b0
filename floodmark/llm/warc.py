"""WARC archives: pages out as records, archives in, segments joined, chunked framing decoded.

Writing: one record per page. Of pages with equal payloads the one with the largest page_id is a
``response``; the others are ``revisit`` records that carry its id and no payload. A response is an HTTP
message in chunked transfer framing; where its block is longer than ``segment_bytes`` it is cut into a
first record and ``continuation`` records with the segment numbers and the total length of the WARC
standard. Archives are gzip files written by Spark's text writer, whose line separator is the blank
lines that end a record.

Reading: each archive is opened piece by piece, gzip member by member, and parsed by content lengths; a task
holds the compressed file and one record. Only segments cross the network: they are grouped
by the record they continue, ordered by number, their total length is verified, and the chunked body is
decoded and its digest checked against the header. A record that fails says so in ``error``.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, shared_path, written

CRLF = "\r\n"
#: Ends each record; also Spark's line separator when archives are written.
RECORD_END = CRLF + CRLF
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A lookup of the groups of equal payloads is broadcast up to so many rows (80 bytes each).
BROADCAST_ROWS = 50_000
#: How a gzip member starts; compressed bytes opened at a time; bytes of blocks handed on at a time.
GZIP, PART, HELD = b"\x1f\x8b\x08", 1 << 16, 16 << 20

def _cut(data: bytes, size: int) -> Iterator[bytes]:
    """Pieces of at most ``size`` bytes that end between characters; a long character may exceed it."""
    at = 0
    while at < len(data):
        end = min(len(data), at + size)
        while end < len(data) and end > at + 1 and data[end] & 0xC0 == 0x80:
            end -= 1
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        yield data[at:end]
        at = end


def _chunked(payload: bytes, size: int) -> bytes:
    parts = [b"%x\r\n%b\r\n" % (len(c), c) for c in _cut(payload, size)]
    return b"".join(parts) + b"0\r\n\r\n"


def _unchunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        eol = body.index(b"\r\n", at)
        size = int(body[at:eol].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        piece = body[eol + 2 : eol + 2 + size]
        if len(piece) != size or body[eol + 2 + size : eol + 4 + size] != b"\r\n":
            raise ValueError("chunk of wrong length")
        out.append(piece)
        at = eol + 4 + size


def _name(page_id: str | None, digest: str) -> str:
    return f"urn:page:{'none' if page_id is None else page_id}:{digest}"


def _header(fields: list[tuple[str, object]]) -> str:
    return "WARC/1.1" + CRLF + "".join(f"{k}: {v}{CRLF}" for k, v in fields if v is not None) + CRLF


def _records(page_id, url, payload: bytes, digest: str, size: int, lead, segment_bytes: int, chunk_bytes: int) -> Iterator[str]:
    name = _name(page_id, digest)
    uri = None if url is None else " ".join(str(url).split())
    common = [("WARC-Date", DATE), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{digest}")]
    http = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"
    if lead is not None:
        block = f"{http}Content-Length: {size}{RECORD_END}"
        fields = [("WARC-Type", "revisit"), ("WARC-Record-ID", f"<{name}>"), *common, ("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{_name(lead, digest)}>")]
        yield _header([*fields, ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]) + block
        return
    block = f"{http}Transfer-Encoding: chunked{RECORD_END}".encode() + _chunked(payload, chunk_bytes)
    pieces = list(_cut(block, segment_bytes))
    for i, piece in enumerate(pieces, 1):
        many, last = len(pieces) > 1, i == len(pieces)
        fields = [
            ("WARC-Type", "response" if i == 1 else "continuation"),
            ("WARC-Record-ID", f"<{name}{f':{i}' if i > 1 else ''}>"),
            *(common if i == 1 else common[:2]),
            ("WARC-Segment-Number", i if many else None),
            ("WARC-Segment-Origin-ID", f"<{name}>" if i > 1 else None),
            ("WARC-Segment-Total-Length", len(block) if many and last else None),
            ("Content-Type", "application/http; msgtype=response" if i == 1 else None),
            ("Content-Length", len(piece)),
        ]
        yield _header(fields) + piece.decode()


def write_archives(
    pages: DataFrame,
    path: str,
    min_revisit_bytes: int = 0,
    segment_bytes: int = 64 * 1024,
    chunk_bytes: int = 8 * 1024,
    records_per_file: int = 4000,
) -> None:
    """Write ``pages`` (page_id, url, html) to ``path`` as gzip archives of at most ``records_per_file`` records.

    A null html is an empty payload, a null url leaves the target out, a null page_id is written as
    ``none``. Payloads under ``min_revisit_bytes`` are always responses. Repeats of the leading
    row are responses too. An empty table writes no record.
    """
    html = F.coalesce("html", F.lit(""))
    keyed = pages.select("page_id", "url", html.alias("html"), F.sha1(html).alias("sha1"), F.octet_length(html).alias("size"))
    groups = keyed.filter(F.col("size") >= min_revisit_bytes).groupBy("sha1", "size").agg(F.max("page_id").alias("lead"), F.count("*").alias("n"))
    groups = checkpointed(groups.filter("n > 1").drop("n"))
    if groups.count() <= BROADCAST_ROWS:
        groups = F.broadcast(groups)
    rows = keyed.join(groups, ["sha1", "size"], "left")
    lead = F.when(~F.col("page_id").eqNullSafe(F.col("lead")), F.col("lead"))
    rows = rows.select("page_id", "url", "html", "sha1", "size", lead.alias("lead"))

    def render(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out: list[str] = []
            for page_id, url, html, sha1, size, to in zip(b["page_id"], b["url"], b["html"], b["sha1"], b["size"], b["lead"], strict=True):
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                out.extend(_records(page_id, url, html.encode(), digest, int(size), to, segment_bytes, chunk_bytes))
            yield pd.DataFrame({"value": out}, dtype=object)

    # ids as strings: pandas would turn longs with nulls into doubles
    rows = rows.withColumns({"page_id": F.col("page_id").cast("string"), "lead": F.col("lead").cast("string")})
    writer = rows.mapInPandas(render, "value string").write.option("lineSep", RECORD_END)
    writer.option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def _opened(content: bytes) -> Iterator[tuple[bytes, bool, str | None]]:
    """The bytes of an archive, piece by piece: each with whether a gzip member starts with it, and what is wrong.

    All members are read, one after the other, as the standard has one for each record; one that is
    broken is given up, and reading goes on where the next one seems to start.
    """
    data, at = memoryview(content), 0
    if content[:2] != GZIP[:2]:
        yield content, True, None
        return
    while at < len(data):
        member, member_at, first = zlib.decompressobj(31), at, True
        try:
            while not member.eof and at < len(data):
                part = data[at : at + PART]
                out = member.decompress(part)
                at += len(part) - len(member.unused_data)
                if out or first:
                    yield out, first, None
                first = False
            if not member.eof:
                yield b"", False, "archive ends within a gzip member"
        except zlib.error as e:
            found = content.find(GZIP, member_at + 1)
            at = len(data) if found < 0 else found
            yield b"", False, f"broken gzip member: {e}"
        while at < len(data) and data[at] == 0:  # padding
            at += 1


def _fields(lines: list[bytes]) -> dict[bytes, bytes]:
    """Header fields by lower-case name; a line that starts with a blank goes on with the one before."""
    fields, name = {}, None
    for x in lines:
        if x[:1] in (b" ", b"\t") and name is not None:
            fields[name] += b" " + x.strip()
        else:
            name, _, v = x.partition(b":")
            name = name.strip().lower()
            fields[name] = v.strip()
    return fields


class _Reader:
    """Records of an archive as (head, block, None), or (None, b"", what is wrong) where there should be one."""

    def __init__(self, content: bytes):
        self.pieces, self.wrong = _opened(content), []
        self.buffer, self.base, self.members = bytearray(), 0, []  # base: the place of the buffer's first byte

    def more(self) -> bool:
        for piece, first, wrong in self.pieces:
            if wrong:
                self.wrong.append(wrong)
            if first:
                self.members.append(self.base + len(self.buffer))
            if piece:
                self.buffer += piece
                return True
        return False

    def find(self, what: bytes, at: int) -> int:
        """The place of ``what`` in the buffer from ``at`` on, -1 if it doesn't come any more."""
        while (found := self.buffer.find(what, at)) < 0:
            at = max(at, len(self.buffer) - len(what) + 1)
            if not self.more():
                return -1
        return found

    def drop(self, n: int) -> None:
        del self.buffer[:n]
        self.base += n
        self.members = [m for m in self.members if m >= self.base]

    def record(self) -> tuple[dict[bytes, bytes], bytes, int]:
        """Head, block and whole size of the record at the start of the buffer."""
        end = self.find(b"\r\n\r\n", 0)
        if end < 0:
            raise ValueError(f"archive ends within a record at byte {self.base}")
        lines = bytes(self.buffer[:end]).split(b"\r\n")
        if not lines[0].startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {self.base}")
        head = _fields(lines[1:])
        if not head.get(b"content-length", b"").isdigit() or b"warc-type" not in head or b"warc-record-id" not in head:
            raise ValueError(f"record at byte {self.base} lacks its length, type or id")
        size = end + 4 + int(head[b"content-length"])
        while len(self.buffer) < size + 4 and self.more():
            pass
        if bytes(self.buffer[size : size + 4]) != b"\r\n\r\n":
            raise ValueError(f"record at byte {self.base} is not of its stated length")
        return head, bytes(self.buffer[end + 4 : size]), size + 4

    def resume(self) -> int:
        """Where, after a record that is no good, another one may start: with a member or after a line's end."""
        found = self.find(b"\nWARC/", 0)
        members = [m - self.base for m in self.members if m > self.base]
        return min([len(self.buffer) if found < 0 else found + 1, *members])

    def __iter__(self) -> Iterator[tuple[dict[bytes, bytes] | None, bytes, str | None]]:
        while self.buffer or self.more():
            blank = len(self.buffer) - len(self.buffer.lstrip(b"\r\n"))
            if blank:  # more blank lines than the standard asks for
                self.drop(blank)
                continue
            try:
                head, block, size = self.record()
                yield head, block, None
            except ValueError as e:
                yield None, b"", str(e)
                size = self.resume()
            self.drop(size)
        for wrong in self.wrong:
            yield None, b"", wrong


def _parse(data: bytes) -> Iterator[tuple[dict[bytes, bytes], bytes]]:
    """The records of an archive that has nothing wrong."""
    for head, block, wrong in _Reader(data):
        if wrong:
            raise ValueError(wrong)
        yield head, block


def _payload(block: bytes, kind: str = "response", http: bool = True) -> tuple[bytes | None, int]:
    """The decoded payload, or None and the stated length for a message without one."""
    if not http:
        return block, len(block)
    head, _, body = block.partition(b"\r\n\r\n")
    fields = _fields(head.split(b"\r\n")[1:])
    if fields.get(b"transfer-encoding", b"").lower() == b"chunked":
        payload = _unchunked(body)
        return payload, len(payload)
    if kind == "revisit":
        return None, int(fields.get(b"content-length", b"0"))
    return body, len(body)


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _decoded(block: bytes, stated: str | None, kind: str = "response", http: bool = True) -> tuple[int, str | None, str | None]:
    """Payload length, digest and error of a whole block."""
    try:
        payload, n = _payload(block, kind, http)
    except (ValueError, IndexError) as e:
        return 0, stated, f"bad framing: {e}"
    if payload is None:
        return n, stated, None
    digest = _digest(payload)
    return n, digest, None if stated in (None, digest) else "digest differs from the header"


#: What one record, or one reassembled record, gives; whole records carry no block.
PARSED = "record_id string, kind string, refers_to string, segment int, total long, digest string, block binary, n long, segments int, error string"
COLUMNS = [c.split()[0] for c in PARSED.split(", ")]
WHOLE_NUMBERS = {"total": "Int64", "n": "Int64", "segment": "Int32", "segments": "Int32"}


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=COLUMNS).astype(WHOLE_NUMBERS)


def _row(head: dict[bytes, bytes], block: bytes) -> tuple:
    text = lambda name: head[name].decode(errors="replace") if name in head else None
    record, kind = text(b"warc-record-id").strip("<>"), text(b"warc-type")
    origin = (text(b"warc-segment-origin-id") or record).strip("<>")
    refers = (text(b"warc-refers-to") or "").strip("<>") or None
    stated = text(b"warc-payload-digest") or ""
    digest = stated.removeprefix("sha1:") or None if stated.startswith("sha1:") or ":" not in stated else None
    number, total = text(b"warc-segment-number"), text(b"warc-segment-total-length")
    http = head.get(b"content-type", b"application/http").lower().startswith(b"application/http")
    if number is None:
        n, digest, error = _decoded(block, digest, kind, http)
        return origin, kind, refers, None, None, digest, None, n, 1, error
    if not number.isdigit() or total is not None and not total.isdigit():
        return origin, kind, refers, None, None, digest, None, 0, 1, "segment without a number"
    return origin, kind, refers, int(number), None if total is None else int(total), digest, block, None, None, None


def _parse_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for content in b["content"]:
            rows, held = [], 0
            for head, block, wrong in _Reader(content):
                rows.append(_row(head, block) if wrong is None else (None, None, None, None, None, None, None, 0, 1, wrong))
                held += len(block)
                if held > HELD or len(rows) >= 2000:
                    yield _frame(rows)
                    rows, held = [], 0
            if rows:
                yield _frame(rows)


def _reassemble(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """The record that the segments of ``group`` make; a record written k times gives k rows."""
    rows = group.sort_values("segment", kind="stable")
    repeats = int((rows["segment"] == 1).sum()) or 1
    first, parts = rows.iloc[0], rows.iloc[::repeats]
    total = parts["total"].dropna()
    block = b"".join(parts["block"])
    n, digest, error = 0, first["digest"], None
    if list(rows["segment"]) != [i for i in range(1, len(parts) + 1) for _ in range(repeats)] or len(total) != 1:
        error = "segments missing or repeated"
    elif int(total.iloc[0]) != len(block):
        error = f"{len(block)} bytes in place of {int(total.iloc[0])}"
    else:
        n, digest, error = _decoded(block, first["digest"], first["kind"])
    return _frame([(key[0], first["kind"], first["refers_to"], None, None, digest, None, n, len(parts), error)] * repeats)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The pages of the archives at ``path``: page_id, payload_bytes, payload_digest, record_type, refers_to, segments, error.

    Archives of other writers are read as well, a gzip member for each record or one for all: their
    records have a null page_id. Each compressed file has to fit in a task's memory; ``write_archives``
    bounds a file by its records, each a segment of bounded size. A record with missing, repeated or short
    segments, broken chunks or another digest than stated has ``error`` set and payload_bytes 0 where
    nothing could be decoded. Where no record can be made out there is a row with ``error`` alone, and
    reading goes on with the next record. Bodies that aren't chunked are payloads as they are.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    parsed = written(files.mapInPandas(_parse_files, PARSED), "warc-parsed")
    joined = parsed.filter("segment is not null").groupBy("record_id").applyInPandas(_reassemble, PARSED)
    page = lambda c: F.when(F.col(c).startswith("urn:page:"), F.split_part(F.col(c), F.lit(":"), F.lit(3)).try_cast("long"))
    return parsed.filter("segment is null").unionByName(joined).select(
        page("record_id").alias("page_id"),
        F.col("n").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        page("refers_to").alias("refers_to"),
        "segments",
        "error",
        "record_id",
    )


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """``pages`` written as archives in the shared folder and read back."""
    path = shared_path(pages.sparkSession, "warc")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path)


#: SHA-1 in base32 by SQL: the 40 hex digits as 32 groups of five bits.
ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, h, octet_length(encode(h)) AS n, max(page_id) OVER (PARTITION BY h) AS lead, sha1(h) AS x FROM p)
SELECT page_id, n::BIGINT AS payload_bytes,
       list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(x, (i * 5) // 4 + 1, 2))::INTEGER >> (3 - (i * 5) % 4)) & 31) + 1, 1) FOR i IN range(0, 32)],
           'string_agg', '') AS payload_digest,
       CASE WHEN page_id = lead THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> lead THEN lead END AS refers_to
FROM d
"""
