import gzip
import io
import zlib

import pytest

from leadlake.llm import warc
from leadlake.llm.common import scratch

PAGES = [
    (5, "http://a.example/", "<p>same</p>"),
    (3, "http://b.example/x y\r\nZ: 1", "<p>same</p>"),
    (9, None, "<p>same</p>"),
    (3, "http://b.example/", "<p>same</p>"),
    (1, "http://é.example/", None),
    (2, "http://c.example/", ""),
    (None, "http://d.example/", "<p>same</p>"),
    (7, "http://long.example/", "<b>lång</b>" * 40_000),
    (8, "", "\r\n\r\nWARC/1.1\r\n"),
]


def written(spark, keep, pages, **options):
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    frame = frame.selectExpr("*", "1 as payload", "2 as refers_to", "'x' as digest", "3 as n")
    return keep(warc.write_archives(frame, keep.folder("warc"), **options), "archives")


def test_round_trip(spark):
    with scratch(spark) as keep:
        read = warc.read_archives(written(spark, keep, PAGES), with_payload=True)
        rows = read.withColumns({"id": warc.page_number("record_id"), "to": warc.page_number("refers_to")}).collect()
    assert {r.problem for r in rows} == {None} and len(rows) == len(PAGES)
    kinds = sorted(((r.id, r.record_type, r.to, r.payload_bytes) for r in rows), key=repr)
    same = len("<p>same</p>")
    assert kinds == sorted(
        [(5, "revisit", 3, same), (3, "response", None, same), (9, "revisit", 3, same), (3, "response", None, same),
         (1, "response", None, 0), (2, "revisit", 1, 0), (None, "revisit", 3, same),
         (7, "response", None, len(("<b>lång</b>" * 40_000).encode())), (8, "response", None, 14)],
        key=repr,
    )
    payloads = {r.id: bytes(r.payload) for r in rows if r.record_type == "response"}
    assert payloads[7].decode() == "<b>lång</b>" * 40_000 and payloads[8] == b"\r\n\r\nWARC/1.1\r\n"
    assert [r.target_uri for r in rows if r.id == 9] == [None]
    assert any("%0D%0AZ:%201" in (r.target_uri or "") for r in rows)


def test_short_payloads_are_written_in_full(spark):
    with scratch(spark) as keep:
        read = warc.read_archives(written(spark, keep, PAGES, min_payload=1))
        kinds = {r.record_id: r.record_type for r in read.collect()}
    assert kinds["<urn:page:1>"] == kinds["<urn:page:2>"] == "response" and kinds["<urn:page:5>"] == "revisit"


def test_no_pages(spark):
    with scratch(spark) as keep:
        assert warc.read_archives(written(spark, keep, [])).collect() == []


def archive(*payloads):
    return [warc.gzip_member(warc.record_bytes(i, "http://x/", p, None, "2026-01-01T00:00:00Z")) for i, p in enumerate(payloads)]


def test_members_are_single_records_that_gzip_reads():
    parts = archive(b"one", b"two" * 50_000)
    assert gzip.decompress(b"".join(parts)).count(b"WARC/1.1\r\n") == 2
    assert zlib.decompress(parts[1], 31).endswith(b"two\r\n\r\n")


@pytest.mark.parametrize("chunk", [1, 7, 64 << 10])
def test_reader_works_in_any_chunks(chunk, monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", chunk)
    data = b"".join(archive(b"one", b"", b"x" * 3000))
    got = list(warc.records(io.BytesIO(data), with_payload=True))
    assert [r["payload"] for r in got] == [b"one", b"", b"x" * 3000] and not any(r["problem"] for r in got)
    assert [r["position"] for r in got] == [0, len(archive(b"one")[0]), len(data) - len(archive(b"", b"", b"x" * 3000)[2])]


def test_damage_is_told():
    good = warc.record_bytes(1, "http://x/", b"payload", None, "2026-01-01T00:00:00Z")
    wrong = {
        "payload digest differs": good.replace(b"\r\n\r\npayload", b"\r\n\r\npaXload"),
        "no empty lines at the record's end": good[:-4],
    }
    for problem, data in wrong.items():
        (row,) = warc.records(io.BytesIO(warc.gzip_member(data)))
        assert row["problem"] == problem
    for problem, data in {
        "no Content-Length": warc.gzip_member(good.replace(b"Content-Length: 8", b"Content-Length: x")[:60]),
        "member cut short": b"".join(archive(b"a" * 9000))[:-20],
        "no WARC/1.1 record": warc.gzip_member(b"HTTP/1.1 200 OK\r\n\r\n"),
    }.items():
        rows = list(warc.records(io.BytesIO(archive(b"fine")[0] + data)))
        assert rows[0]["problem"] is None and rows[1]["problem"] is not None, problem
    two = list(warc.records(io.BytesIO(warc.gzip_member(wrong["payload digest differs"]) + archive(b"next")[0])))
    assert [bool(r["problem"]) for r in two] == [True, False]
