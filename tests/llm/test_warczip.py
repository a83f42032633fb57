"""Packages: round trip, directories, range reads."""

import base64
import hashlib
import io
import zipfile

import pytest

from shoreline.llm import warczip

SCHEMA = "page_id long, url string, html string, digest string, payload int"
CASES = [
    (1, "http://a/", "same"),
    (2, None, "same"),
    (3, "http://a/ü?x=1%20 \r\n", None),
    (4, "http://b/", ""),
    (4, "http://b/", ""),
    (5, "u", "x\r\n\r\nContent-Length: 5\r\n" * 20_000),
    (None, "u", "same"),
    (None, "v", "alone"),
    (6, "u", "é" * 1000),
]


def brute(rows, least):
    first = {}
    for page_id, _, html in rows:
        if page_id is not None:
            first[html or ""] = max(first.get(html or "", page_id), page_id)
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        to = first.get(html or "") if len(data) >= least else None
        to = None if to == page_id else to
        out.append((page_id, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 10])
def test_round_trip(spark, least):
    pages = spark.createDataFrame([(i, u, h, "d", 1) for i, u, h in CASES], SCHEMA)
    rows = warczip.archived(pages, least).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str) == brute(CASES, least)
    payloads = {r.page_id: bytes(r.payload) for r in rows if r.payload is not None and r.page_id is not None}
    assert payloads[5] == CASES[5][2].encode()
    assert next(r.url for r in rows if r.page_id == 3) == "http://a/ü?x=1%2520%20%0D%0A"


def test_splits_are_read_by_as_many_tasks(spark, monkeypatch):
    """Rows of splits are tiny, so by size alone one task would get them all."""
    monkeypatch.setattr(warczip, "SPLIT_BYTES", 2000)
    pages = spark.createDataFrame([(i, "u", hashlib.sha512(b"%d" % i).hexdigest() * 8, "d", 1) for i in range(200)], SCHEMA)
    records = warczip.archived(pages)
    assert records.rdd.getNumPartitions() >= 16 and records.count() == 200
    used = records.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(n > 0 for n in used) >= 8


def test_empty_table(spark):
    assert warczip.archived(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("limit", [zipfile.ZIP64_LIMIT, 100])
@pytest.mark.parametrize("comment", [b"", b"PK comment" * 50])
def test_directory(monkeypatch, limit, comment):
    """Directories with and without ZIP64 records; the low limit makes the writer use them."""
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
    target = io.BytesIO()
    with zipfile.ZipFile(target, "w") as package:
        package.comment = comment
        for i in range(30):
            package.writestr(f"m{i}", b"%d" % i * 300)
        package.writestr("packed", b"x" * 1000, zipfile.ZIP_DEFLATED)
    found = warczip.directory(target, len(target.getvalue()))
    assert set(found) == {f"m{i}" for i in range(30)}
    for name, (start, size) in found.items():
        assert target.getvalue()[start : start + size] == name[1:].encode() * 300


def test_broken_payload_is_an_error():
    good = warczip.record(1, "u", b"abc", base64.b32encode(hashlib.sha1(b"abc").digest()).decode(), None)
    assert warczip.parsed(good)[4] == 3
    with pytest.raises(ValueError):
        warczip.parsed(warczip.record(1, "u", b"abc", "A" * 32, None))
