from __future__ import annotations

import base64
import gzip
import hashlib

import pytest

from tests.llm.corpus import multiset
from vecindad.llm import warc

SCHEMA = "page_id long, url string, html string, record_id string, payload string, digest int"


def pages() -> list[tuple]:
    long = "<p>é€𝄞</p>\r\n\r\nWARC/1.1\r\n" * 20_000
    texts = [
        "<p>one</p>", "<p>two</p>", "<p>one</p>", None, "", "ends\r\n", "ends\r\n\r\n", "\r\n\r\nbegins", "\n", "WARC/1.1\r\nWARC-Type: response\r\n\r\n",
        long, long, "x" * 3_000_000, "<p>two</p>", "a\r\r\n\rb", "\x00 nul \x1f",
    ]
    out = [(k, f"http://a.example/{k}", t) for k, t in enumerate(texts)]
    out += [(None, "http://none.example/", "<p>one</p>"), (None, None, None), (None, "u", "only null id")]
    out += [(2, "http://a.example/2", "<p>one</p>"), (0, "http://b.example/0", "<p>one</p>"), (1, "http://a.example/1", "<p>two</p>")]
    out += [(50, "http://a.example/a b\r\nX-Evil: 1", "evil"), (51, "http://ü.example/é", "evil")]
    return [(*row, "clash", "clash", 3) for row in out]


def expected(rows) -> list[tuple]:
    groups: dict[bytes, list] = {}
    for page, _, html, *_ in rows:
        groups.setdefault((html or "").encode(), []).append(page)
    out = []
    for data, ids in groups.items():
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        ids = sorted(ids, key=lambda p: (p is None, p or 0))
        out += [(p, len(data), digest, "revisit" if k else "response", ids[0] if k else None) for k, p in enumerate(ids)]
    return out


@pytest.fixture
def folder(spark, tmp_path):
    spark.createDataFrame(pages(), SCHEMA).repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    return str(tmp_path)


def test_against_brute_force(spark, folder):
    got = [tuple(r) for r in warc.op12_archives(spark, folder).collect()]
    assert multiset(got) == multiset(expected(pages()))


def test_archives_hold_each_payload_once(spark, folder):
    path = f"{folder}/archives"
    warc.write(warc.page_records(spark, f"{folder}/pages.parquet"), path)
    records = warc.read_archives(spark, path).collect()
    assert len({r["record_id"] for r in records}) == len(records) == len(pages())
    payloads = [bytes(r["payload"]) for r in records if r["record_type"] == "response"]
    assert multiset(payloads) == multiset({(row[2] or "").encode() for row in pages()})
    urls = {r["page_id"]: r["url"] for r in records}
    assert urls[50] == "http://a.example/a%20b%0D%0AX-Evil:%201" and urls[51] == "http://ü.example/é"


def test_least_bytes(spark, folder):
    heads = warc.headers(warc.page_records(spark, f"{folder}/pages.parquet"))
    small = {r["record_id"] for r in heads.where("payload_bytes < 100").collect()}
    again = {r["record_id"] for r in warc.revisits(heads, 100).collect()}
    assert len(again) == 1 and not again & small


def _record(kind: str, name: str, block: bytes, **more: str) -> bytes:
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:{name}>", f"Content-Length: {len(block)}"]
    lines += [f"{k.replace('_', '-')}: {v}" for k, v in more.items()]
    return "\r\n".join(["WARC/1.0", *lines, "", ""]).encode() + block + b"\r\n\r\n"


def test_foreign_archive_is_resolved_and_written_anew(spark, tmp_path):
    """Members compressed one by one, folded headers, revisits by id, by digest and without a response."""
    http = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n"
    digest = "sha1:" + base64.b32encode(hashlib.sha1(b"body").digest()).decode()
    members = [
        _record("warcinfo", "info", b"software: x\r\n"),
        _record("response", "r1", http + b"body", Content_Type="application/http;\r\n msgtype=response"),
        _record("response", "r2", http + b"body", Content_Type="application/http; msgtype=response"),
        _record("revisit", "v1", b"", WARC_Refers_To="<urn:r2>", WARC_Payload_Digest=digest),
        _record("revisit", "v2", http, WARC_Payload_Digest=digest, Content_Type="application/http; msgtype=response"),
        _record("revisit", "v3", b"", WARC_Payload_Digest="sha1:UNKNOWN"),
    ]
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.warc.gz").write_bytes(b"".join(gzip.compress(m) for m in members))
    found = {r["record_id"]: r for r in warc.resolved(warc.read_archives(spark, str(source))).collect()}
    assert found["urn:v1"]["refers_record"] == "urn:r2" and found["urn:v1"]["payload_bytes"] == 4
    assert found["urn:v2"]["refers_record"] == "urn:r1" and found["urn:v3"]["refers_record"] is None
    warc.rewrite(spark, str(source), str(tmp_path / "out"))
    anew = {r["record_id"]: r for r in warc.read_archives(spark, str(tmp_path / "out")).collect()}
    assert set(anew) == {"urn:r1", "urn:r2", "urn:v1", "urn:v2"}
    assert [k for k, r in anew.items() if r["record_type"] == "response"] == ["urn:r1"]
    assert {r["refers_to"] for k, r in anew.items() if k != "urn:r1"} == {"urn:r1"}


def test_cut_archive_is_an_error(spark, tmp_path):
    source = tmp_path / "cut"
    source.mkdir()
    (source / "a.warc").write_bytes(_record("response", "r", b"0123456789")[:-8])
    with pytest.raises(Exception, match="ends within a record"):
        warc.read_archives(spark, str(source)).collect()


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/pages.parquet")
    assert warc.op12_archives(spark, str(tmp_path)).count() == 0
