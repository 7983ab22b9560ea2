import base64
import gzip
import hashlib
import zlib
from pathlib import Path

import pytest

from sluice.llm import warc

HTML = "<p>ü</p>\r\n\r\nWARC/1.1\r\nContent-Length: 9\r\n\r\n"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], "page_id long, url string, html string, payload string, archive string")


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def test_round_trip(spark):
    rows = [(1, "http://a/", HTML), (2, None, HTML), (5, "http://b/\r\nx", "once"), (7, "c", None), (8, "d", ""), (9, "e", "long " * 300_000), (None, "f", HTML)]
    got = {r.page_id: r for r in warc.round_trip(pages(spark, rows)).collect()}
    heads = {HTML: 2, "once": 5, "": 8, "long " * 300_000: 9}
    for i, _, h in rows:
        r, head = got[i], heads[h or ""]
        assert (r.payload_bytes, r.payload_digest) == (len((h or "").encode()), digest(h))
        assert (r.record_type, r.refers_to) == (("response", None) if i == head else ("revisit", head))


def test_small_payloads_below_the_bound_are_responses(spark):
    got = warc.round_trip(pages(spark, [(1, "a", "x"), (2, "a", "x"), (3, "a", "long"), (4, "a", "long")]), least=3).collect()
    assert sorted((r.page_id, r.record_type) for r in got) == [(1, "response"), (2, "response"), (3, "revisit"), (4, "response")]


def test_repeated_rows_and_empty_tables(spark):
    got = warc.round_trip(pages(spark, [(1, "a", "x"), (1, "a", "x")])).collect()
    assert [(r.page_id, r.record_type) for r in got] == [(1, "response")] * 2
    assert warc.round_trip(pages(spark, [])).collect() == []


def record(body, kind="resource"):
    return f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:x>\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


def test_normal_form_has_one_member_a_record_and_a_sidecar(spark, tmp_path):
    records = [record(b"a" * 10), record(b""), record(b"b\r\n\r\n" * 100_000)]
    forms = {"one.warc.gz": gzip.compress(b"".join(records)), "many.warc.gz": b"".join(map(gzip.compress, records)), "plain.warc": b"".join(records)}
    for name, data in forms.items():
        (tmp_path / name).write_bytes(data)
    sources = spark.createDataFrame([(f"file://{tmp_path / n}",) for n in forms], "archive string")
    index = warc.normalise(sources, f"file://{tmp_path}/out").collect()
    for name in forms:
        data = (tmp_path / "out" / name).read_bytes()
        rows = sorted((r for r in index if r.archive.endswith(f"/{name}")), key=lambda r: r.record_no)
        assert [zlib.decompress(data[r.offset : r.offset + r.length], 31) for r in rows] == records
        assert sum(r.length for r in rows) == len(data)
        lines = Path(tmp_path / "out" / f"{name}.index.tsv").read_text().splitlines()
        assert [tuple(map(int, s.split("\t")[-2:])) for s in lines] == [(r.offset, r.length) for r in rows]


def test_a_truncated_stream_is_an_error(spark, tmp_path):
    (tmp_path / "cut.warc.gz").write_bytes(gzip.compress(record(b"a" * 1000))[:-20])
    with pytest.raises(Exception, match="ends inside"):
        warc.normalise(spark.createDataFrame([(f"file://{tmp_path}/cut.warc.gz",)], "archive string"), f"file://{tmp_path}/out").collect()
