from __future__ import annotations

import base64
import gzip
import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wardmill.llm import warc

SCHEMA = "page_id long, url string, html string, id long, digest string, first string, size int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, 1, "d", "f", 2) for r in rows], SCHEMA).repartition(3)


def sha(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def expected(rows, min_bytes=0):
    largest = {}
    for page, _, html in rows:
        now = largest.get(html or "", (False, 0))
        largest[html or ""] = max(now, (page is not None, page or 0))
    out = []
    for page, _, html in rows:
        body = html or ""
        known, first = largest[body]
        again = len(body.encode()) >= min_bytes and known and page != first
        out.append((page, len(body.encode()), sha(body), "revisit" if again else "response", first if again else None))
    return Counter(out)


def found(spark, rows, **options):
    folder = warc.write_archives(pages(spark, rows), **options)
    records = warc.resolve_revisits(warc.read_archives(spark, folder))
    whole = lambda c: None if c is None else int(c)
    return folder, Counter(
        (whole(r.page_id), r.payload_bytes, r.payload_digest, r.type, whole(r.original)) for r in records.collect()
    )


ROWS = [
    (1, "http://a.example/", "<p>x</p>"), (2, "http://b.example/", "<p>x</p>"), (3, None, "<p>x</p>"),
    (4, "http://c.example/\r\nX: y", "été\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n"), (5, "u", None), (6, "u", ""),
    (7, "u", "a\x00b\x0bc" * 50_000), (8, "v", "a\x00b\x0bc" * 50_000), (9, "", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc"),
    (None, "n", "<p>x</p>"), (None, "n", "alone"), (10, "r", "twice"), (10, "r", "twice"), (11, "k", "\r\n\r\n"),
]


def test_equals_plain_python(spark):
    for least in (0, 9):
        folder, got = found(spark, ROWS, min_bytes=least)
        assert got == expected(ROWS, least)


def test_archives_hold_each_payload_once(spark):
    folder, _ = found(spark, ROWS)
    records = warc.read_archives(spark, folder, with_payload=True)
    kept = Counter(bytes(r.payload).decode() for r in records.filter("type = 'response'").collect())
    assert kept == Counter({html or "": 2 if html == "twice" else 1 for _, _, html in ROWS})
    assert records.filter("type = 'revisit' and (payload_bytes > 0 or refers_to is null)").count() == 0
    heads = records.filter("type = 'response'").select(F.col("record_id").alias("refers_to")).distinct()
    assert records.filter("type = 'revisit'").join(heads, "refers_to", "left_anti").count() == 0
    assert records.filter("digest <> concat('sha1:', payload_sha1) and type = 'response'").count() == 0


def test_archives_have_the_form_of_the_standard(spark, tmp_path):
    folder, _ = found(spark, ROWS[:3], folder=str(tmp_path / "a"))
    data = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "a").glob("*.gz"))
    assert data.count(b"WARC/1.1\r\nWARC-Type: ") == 3 and data.endswith(b"\r\n\r\n")
    assert data.count(b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n") == 2
    assert b"WARC-Target-URI: http://a.example/\r\n" in data


def test_reads_plain_and_member_packed_archives_and_folded_headers(spark, tmp_path):
    def record(number, body):
        return (f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:{number}>\r\nX-Note: one\r\n two\r\n"
                f"Content-Length: {len(body)}\r\n\r\n").encode() + body + b"\r\n\r\n"
    bodies = [b"", b"\r\n\r\nWARC/1.0\r\n\r\n", bytes(range(256)) * 9_000]
    plain = b"".join(record(i, b) for i, b in enumerate(bodies))
    (tmp_path / "a.warc").write_bytes(plain)
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(record(i, b)) for i, b in enumerate(bodies)))
    rows = warc.read_archives(spark, str(tmp_path), with_payload=True).collect()
    assert Counter(bytes(r.payload) for r in rows) == Counter(bodies * 2) and {r.type for r in rows} == {"resource"}
    for broken in (plain[:-3], plain[:40], gzip.compress(plain)[:-9]):
        with pytest.raises(ValueError, match="ends inside"):
            list(warc.records_of(warc.unpacked(broken)))


def test_a_revisit_without_its_response_keeps_its_digest(spark, tmp_path):
    head = ("WARC/1.1\r\nWARC-Type: revisit\r\nWARC-Record-ID: <r>\r\nWARC-Refers-To: <gone>\r\n"
            "WARC-Payload-Digest: sha1:ABC\r\nContent-Length: 0\r\n\r\n\r\n\r\n")
    (tmp_path / "a.warc").write_text(head, newline="")
    row = warc.resolve_revisits(warc.read_archives(spark, str(tmp_path))).first()
    assert (row.payload_digest, row.payload_bytes, row.original) == ("ABC", None, None)


def test_empty_table_and_a_payload_of_very_many_pages(spark):
    assert not found(spark, [])[1]
    rows = [(i, f"http://h.example/{i}", "same") for i in range(3_000)] + [(9_000 + i, "u", str(i)) for i in range(50)]
    assert found(spark, rows)[1] == expected(rows)
