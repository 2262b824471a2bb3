import hashlib
import struct

import pytest
import zstandard

from tidemark.llm.warc import SKIPPABLE, parsed, read_archives, record_bytes, write_archives

COLUMNS = "page_id long, url string, html string, payload string, digest string, target string, n long, archive string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, *[None] * 5) for r in rows], COLUMNS)


def test_round_trip_with_copies_ties_and_nulls(spark):
    large, other = "é<p>text</p>" * 200, "x" * 1000
    rows = [(i, f"http://h/{i}", large) for i in range(40)]
    rows += [(50, None, None), (51, "http://h/a b", ""), (52, "u", "small"), (53, "u", "small"), (54, "u", "x" * 999), (55, "u", "x" * 999)]
    rows += [(60, "u", other), (61, "u", other), (61, "u", other), (None, "u", other), (None, "u", "n" * 2000), (None, "u", "n" * 2000)]
    rows += [(70, "u", "long " * 400_000)]
    found = read_archives(write_archives(pages(spark, rows))).collect()
    assert all(r.error is None for r in found) and len(found) == len(rows)
    payload = {hashlib.sha1(r.payload).hexdigest(): r.payload for r in found if r.record_type == "response"}
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to, payload[r.payload_digest].decode()) for r in found), key=str)
    expected = []
    for page, _, html in rows:
        text = html or ""
        n = len(text.encode())
        target = max((p for p, _, h in rows if h == html and p is not None), default=None) if n >= 1000 else None
        revisit = target is not None and page != target
        expected.append((page, n, "revisit" if revisit else "response", target if revisit else None, text))
    assert got == sorted(expected, key=str)


def test_no_pages(spark):
    assert read_archives(write_archives(pages(spark, []))).count() == 0


def record(**changes):
    page = {"page_id": 1, "url": "http://h/", "payload": b"hello", "digest": hashlib.sha1(b"hello").hexdigest(), "n": 5, "refers_to": None}
    return record_bytes(page | changes)


def test_headers_and_lengths_are_checked():
    assert parsed(record())["payload"] == b"hello"
    for bad in (record()[:-4], record() + b"x", record().replace(b"hello", b"hullo"), record().replace(b"WARC/1.1", b"HTTP/1.1")):
        with pytest.raises(ValueError):
            parsed(bad)
    head, _, rest = record().partition(b"\r\n\r\n")
    fields = head.rpartition(b": ")
    with pytest.raises(ValueError):
        parsed(fields[0] + b": " + str(int(fields[2]) + 1).encode() + b"\r\n\r\n" + rest)


def test_damaged_archives_give_errors(spark, tmp_path):
    dictionary = b"raw dictionary content " * 20
    pack = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    packed = zstandard.ZstdCompressor().compress(dictionary)
    frames = [pack.compress(record(page_id=i)) for i in range(3)]
    head = struct.pack("<II", SKIPPABLE, len(packed)) + packed
    files = {
        "good": head + b"".join(frames),
        "cut": head + frames[0] + frames[1][:-9],
        "wrong": head + frames[0] + pack.compress(b"no record") + frames[2],
        "short": head[:20],
        "none": b"",
    }
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    table = spark.createDataFrame([(f"file://{tmp_path}/{name}",) for name in files], "archive string")
    found = {}
    for r in read_archives(table).collect():
        found.setdefault(r.archive.rsplit("/")[-1], []).append((r.page_id, r.error is not None))
    assert found["good"] == [(0, False), (1, False), (2, False)]
    assert found["cut"] == [(0, False), (None, True)]
    assert found["wrong"] == [(0, False), (None, True), (2, False)]
    assert found["short"] == [(None, True)] and "none" not in found
