"""WARC archives that other programs wrote, and broken ones."""

import base64
import gzip
import hashlib

import pytest

from floodmark.llm import queries, warc


def record(kind, name, block, **fields):
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{name}>"), *((k.replace("_", "-"), v) for k, v in fields.items()), ("Content-Length", len(block))]
    return b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


BODY = "Grüße".encode() * 50
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nX-Folded: a\r\n  b\r\n\r\n"
CHUNKED = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: Chunked\r\n\r\n7;x=y\r\n" + BODY[:7] + b"\r\n" + b"%x\r\n" % (len(BODY) - 7) + BODY[7:] + b"\r\n0\r\nTrailer: 1\r\n\r\n"
RECORDS = [
    record("warcinfo", 1, b"software: other\r\n", Content_Type="application/warc-fields"),
    record("response", 2, HTTP + BODY, WARC_Payload_Digest="sha1:" + digest(BODY), Content_Type="application/http; msgtype=response"),
    record("response", 3, CHUNKED, WARC_Payload_Digest="sha1:" + digest(BODY)),
    record("resource", 4, b"\x00\xff" * 9, Content_Type="image/png"),
    record("revisit", 5, b"HTTP/1.1 200 OK\r\nContent-Length: 350\r\n\r\n", WARC_Refers_To="<urn:uuid:2>", WARC_Payload_Digest="sha1:" + digest(BODY)),
]
SIZES = {"urn:uuid:1": 17, "urn:uuid:2": 350, "urn:uuid:3": 350, "urn:uuid:4": 18, "urn:uuid:5": 350}


def read(spark, tmp_path, *files):
    for i, data in enumerate(files):
        (tmp_path / f"{i}.warc.gz").write_bytes(data)
    return warc.read_archives(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("how", ["a member each", "one member", "not compressed", "padded"])
def test_foreign_archives(spark, tmp_path, how):
    data = {"a member each": b"".join(map(gzip.compress, RECORDS)), "one member": gzip.compress(b"".join(RECORDS)), "not compressed": b"".join(RECORDS), "padded": bytes(9).join(map(gzip.compress, RECORDS)) + bytes(512)}[how]
    rows = {r.record_id: r for r in read(spark, tmp_path, data)}
    assert {k: r.payload_bytes for k, r in rows.items()} == SIZES and not [r for r in rows.values() if r.error or r.page_id is not None]
    assert rows["urn:uuid:2"].payload_digest == rows["urn:uuid:3"].payload_digest == digest(BODY)
    assert rows["urn:uuid:1"].record_type == "warcinfo" and rows["urn:uuid:5"].record_type == "revisit"


def test_broken_records_end_nothing(spark, tmp_path):
    short = RECORDS[1].replace(b"Content-Length: 4", b"Content-Length: 9", 1)
    no_length = RECORDS[3].replace(b"Content-Length", b"Content-Size")
    assert short != RECORDS[1] and no_length != RECORDS[3]
    broken = bytearray(gzip.compress(RECORDS[2]))
    broken[40] ^= 0xFF
    files = [
        b"".join(map(gzip.compress, [RECORDS[0], short, no_length, b"WARC/1.0 nonsense", RECORDS[3]])),
        gzip.compress(RECORDS[0] + short + no_length + b"junk\r\n\r\n" + RECORDS[3]),
        gzip.compress(RECORDS[1]) + bytes(broken) + gzip.compress(RECORDS[3]),
        gzip.compress(RECORDS[1]) + gzip.compress(RECORDS[2])[:-30],
        gzip.compress(RECORDS[3]) + gzip.compress(RECORDS[1])[:5],
        b"", gzip.compress(b""), b"\x1f\x8b\x08nonsense", b"plain nonsense", gzip.compress(record("response", 6, b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n5\r\nabc")), gzip.compress(record("response", 7, HTTP + BODY, WARC_Payload_Digest="sha1:AAAA")),
    ]
    rows = read(spark, tmp_path, *files)
    good = sorted(r.record_id for r in rows if not r.error)
    assert good == sorted(["urn:uuid:1", "urn:uuid:4"] * 2 + ["urn:uuid:2", "urn:uuid:4"] + ["urn:uuid:2"] + ["urn:uuid:4"])
    errors = [r.error for r in rows if r.error]
    assert sum("stated length" in e for e in errors) == 3 and sum("lacks its length" in e for e in errors) == 2
    assert sum("broken gzip member" in e for e in errors) == 2 and sum("ends within a gzip member" in e for e in errors) == 2
    assert {r.record_id: r.error for r in rows if r.record_id in ("urn:uuid:6", "urn:uuid:7")} == {"urn:uuid:6": "bad framing: chunk of wrong length", "urn:uuid:7": "digest differs from the header"}


def test_records_longer_than_what_is_opened_at_a_time(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "PART", 100)
    big = [record("resource", i, bytes([65 + i]) * 200_000, Content_Type="text/plain") for i in range(8)]
    records = list(warc._Reader(b"".join(map(gzip.compress, big))))
    assert [(len(b), w) for _, b, w in records] == [(200_000, None)] * 8


def test_query_keeps_its_columns(spark, sf_dir):
    assert queries.op9_warc(spark, sf_dir).columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def test_clashing_columns(spark):
    rows = [(i, f"u{i % 3}", f"<p>{i % 4}</p>", "x", 1, "y", "z", 2) for i in range(9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, sha1 string, size int, lead string, kind string, n int")
    out = warc.archive_round_trip(pages).collect()
    assert sorted((r.page_id, r.refers_to) for r in out) == [(i, None if i + 4 > 8 else i % 4 + (8 if i % 4 == 0 else 4)) for i in range(9)]
