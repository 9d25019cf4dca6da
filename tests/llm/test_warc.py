"""WARC: exact round trips, broken archives, and the framing by itself."""

from __future__ import annotations

import gzip
import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tabwright.llm import warc

LONG = "<p>Ünïcode straße 日本語</p>\r\n0\r\n\r\nWARC/1.1\r\n" * 900


@given(st.binary(max_size=300), st.integers(1, 50))
def test_framing_round_trip(body, size):
    assert warc.dechunked(warc.chunked(body, size)) == body


def test_framing_of_others():
    assert warc.dechunked(b"3;x=1\r\nabc\r\n2\r\nde\r\n0\r\nTrailer: y\r\n\r\n") == b"abcde"
    with pytest.raises(ValueError):
        warc.dechunked(b"5\r\nabc\r\n0\r\n\r\n")


def rows():
    same = "the same payload " * 20
    return [
        (7, "http://a/é x\n", same, "k1"), (3, None, same, "k2"), (9, "u", same, None), (3, "u", same, "k3"), (1, "u", "short", "x"), (2, "u", "short", "x"),
        (4, "u", None, "x"), (5, "u", "", "x"), (6, "u", LONG, "x"), (8, "u", LONG, "x"), (10, "u", "x" * 2_000_000, "x"), (None, "u", same, "x"),
    ]


def test_round_trip(spark):
    pages = spark.createDataFrame(rows(), "page_id long, url string, html string, digest string").repartition(3)
    path = warc.write(pages, "page_id", "url", "html", segment=1000, chunk=333)
    read = warc.read(spark, path)
    assert read.where("NOT complete").count() == 0
    found = {(r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"])
             for r in warc.resolved(read).withColumnRenamed("key", "page_id").collect()}
    want = set()
    for page, _, html, _ in rows():
        raw = (html or "").encode()
        first = min((p for p, _, h, _ in rows() if p is not None and (h or "").encode() == raw), default=None)
        revisit = len(raw) >= 100 and page != first
        want.add((page, "revisit" if revisit else "response", first if revisit else None, len(raw), hashlib.sha256(raw).hexdigest()))
    assert found == want
    payloads = {r["key"]: bytes(r["payload"]) for r in read.where("type = 'response'").collect()}
    assert payloads["6"] == LONG.encode() and payloads["4"] == b"" and payloads["10"] == b"x" * 2_000_000
    assert warc.resolved(read).count() == len(rows())


def test_archives_are_plain_warc(spark, tmp_path):
    pages = spark.createDataFrame(rows()[:2], "page_id long, url string, html string, digest string").coalesce(1)
    path = warc.write(pages, "page_id", "url", "html", str(tmp_path / "out"))
    files = list((tmp_path / "out").glob("*.gz"))
    raw = b"".join(gzip.open(f).read() for f in files)
    heads = [f for f, _ in warc.parsed(raw)]
    assert sorted(h["warc-type"] for h in heads) == ["response", "revisit"] and path
    assert all(h["warc-record-id"].startswith("<urn:uuid:") for h in heads)


def test_missing_and_broken_segments(spark, tmp_path):
    body = b"y" * 5000
    digest = hashlib.sha256(body).hexdigest()
    whole = warc.records("1", "u", body, digest, True, 1000, 400)
    lost = warc.records("2", "u", body, digest, True, 1000, 400)
    wrong = warc.records("3", "u", body, "0" * 64, True, 1000, 400)
    cut = warc.records("4", "u", body, digest, True, 1000, 400)
    orphan = warc.records("5", "u", b"", "f" * 64, False, 1000, 400)
    # per-record compression, segments out of order and spread over two archives
    (tmp_path / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, [*whole[::-1], *lost[:2], *orphan])))
    (tmp_path / "b.warc").write_bytes(b"".join([*lost[3:], *wrong, *cut[:-1]]))
    found = {r["key"]: r for r in warc.read(spark, str(tmp_path)).collect()}
    assert found["1"]["complete"] and bytes(found["1"]["payload"]) == body
    assert all(not found[k]["complete"] and found[k]["payload"] is None for k in ("2", "3", "4"))
    assert [r["refers_to"] for r in warc.resolved(warc.read(spark, str(tmp_path))).where("key = 5").collect()] == [None]


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    path = warc.write(pages, "page_id", "url", "html")
    assert warc.read(spark, path).count() == 0
