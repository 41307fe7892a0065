"""WARC archives: round trip, revisits, assembly both ways, damage."""

from __future__ import annotations

import gzip
import hashlib

import pytest

from sparrowscope.llm import warc

PAGES = "page_id bigint, url string, html string, type string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "t") for r in rows], PAGES).repartition(3)


def expected(rows):
    rows = list(dict.fromkeys(rows))
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        last = max((p for p, _, h in rows if (h or "") == (html or "") and p is not None), default=None)
        revisit = len(data) >= 1000 and last is not None and page != last
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", last if revisit else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    large, evil = "é" * 600, "x" * 990 + "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n\x1f\x8b"
    rows = [
        (1, "http://a/b c\r\nX: y", large), (2, "http://a/", large), (9, None, large), (3, "http://b/?q", evil),
        (4, "http://b/", evil), (5, "", "small"), (6, "u", "small"), (7, "u", None), (8, "u", ""), (None, "n", large),
        (2, "http://a/", large), (9, "other", large), (10, "big", "ab\n" * 700_000), (11, "ü", "a" * 1000), (12, "ü", "a" * 1000),
    ]
    path = warc.archive_folder(spark)
    warc.write_captures(frame(spark, rows), path)
    found = warc.captured_pages(spark, path)
    assert found.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, found.collect()), key=str) == expected(rows)
    captures = warc.assemble(warc.read_records(spark, path, payloads=True)).collect()
    assert {len(c["requests"]) for c in captures} == {len(c["metadata"]) for c in captures} == {1}
    assert {bytes(c["payload"]) for c in captures if c["type"] == "response"} == {(h or "").encode() for _, _, h in rows}
    kinds = {r["type"]: r["count"] for r in warc.read_records(spark, path).groupBy("type").count().collect()}
    assert kinds["request"] == kinds["metadata"] == len(rows) and kinds["warcinfo"] >= 1


def test_empty_table(spark):
    path = warc.archive_folder(spark)
    warc.write_captures(frame(spark, [(1, "u", "x")]).where("page_id > 5"), path)
    assert warc.captured_pages(spark, path).collect() == []


def test_assembly_follows_either_direction(spark):
    rows = [
        ("r1", "response", ["q1"]), ("q1", "request", []), ("m1", "metadata", ["r1"]), ("m1", "metadata", ["r1"]),
        ("r1", "response", ["q1"]), ("r2", "response", []), ("m9", "metadata", ["gone"]), (None, "request", ["r2"]),
        ("q2", "request", ["r1", "r2"]),
    ]
    full = [(i, t, None, None, c, None, "d", 1, None, None) for i, t, c in rows]
    found = {r["record_id"]: r for r in warc.assemble(spark.createDataFrame(full, warc.RECORDS)).collect()}
    ids = {k: (sorted(q["record_id"] for q in r["requests"]), [m["record_id"] for m in r["metadata"]]) for k, r in found.items()}
    assert ids == {"r1": (["q1", "q2"], ["m1"]), "r2": (["q2"], [])}


def test_plain_and_damaged_archives():
    member = warc.capture_members(4, "http://a/", b"payload", None, "1970-01-01T00:00:00Z")
    plain = gzip.decompress(member)
    for content in (member, plain, gzip.compress(plain), member + warc._EMPTY_MEMBER):
        kinds = [dict(headers)["warc-type"] for headers, _ in warc.parse_records(content)]
        assert kinds == ["request", "response", "metadata"]
    for content in (member[:-5], plain[:-30], b"text\r\n\r\n"):
        with pytest.raises((ValueError, KeyError)):
            list(warc.parse_records(content))
    broken = [warc._row(h, b.replace(b"payload", b"payloaX"), False) for h, b in warc.parse_records(plain) if dict(h)["warc-type"] == "request"]
    assert broken[0]["concurrent_to"]
    with pytest.raises(ValueError):
        [warc._row(h, b.replace(b"payload", b"payloaX"), False) for h, b in warc.parse_records(plain)]
