from pyspark.sql import functions as F

from sluice.sources.csv_upload import read_event_csv


def _write(dirpath, name, text, encoding="utf-8"):
    p = dirpath / name
    p.write_bytes(text.encode(encoding))
    return p


def _read(spark, d):
    rows, files = read_event_csv(spark, str(d))
    rows = rows.withColumn("file", F.regexp_extract("file_path", r"([^/]+)$", 1))
    files = files.withColumn("file", F.regexp_extract("file_path", r"([^/]+)$", 1))
    return rows, files


def test_headers_quoting_and_ragged_rows(spark, tmp_path):
    _write(tmp_path, "a.csv", 'timestamp,event_type,did,x\n1,order,d1,"q,""r"""\n2,order,d2,"line\nbreak"\n3,order,d3,\n4,order\n5,order,d5,x,extra\n\n6,reg,d6,z\n')
    _write(tmp_path, "b.csv", "﻿did,did,timestamp,event_type,ip,aid\njunk,d7,7,click,1.1.1.1,a7\n")
    _write(tmp_path, "c.csv", "did,event_type\nd8,order\n")
    _write(tmp_path, "d.csv", "")
    rows, files = _read(spark, tmp_path)
    fv = {r.file: (r.status, r.reason) for r in files.collect()}
    assert fv["a.csv"] == (200, None) and fv["b.csv"] == (200, None)
    assert fv["c.csv"] == (400, "Missing Required field: No timestamp")
    all_rows = rows.collect()
    got = {(r.file, r.record.did): r for r in all_rows if r.record}
    ok = [r for r in all_rows if r.status == 200]
    bad = [r for r in all_rows if r.status == 500]
    assert len(bad) == 2 and all(r.reason == "Err read file:wrong number of fields" for r in bad)
    a1 = got[("a.csv", "d1")].record
    assert a1.extension == {"event_type": "order", "x": 'q,"r"'} and a1.timestamp == "1" and a1.event == "TrackerEvent" and a1.id == ""
    assert got[("a.csv", "d2")].record.extension["x"] == "line\nbreak"
    assert got[("a.csv", "d3")].record.extension["x"] == ""
    b = got[("b.csv", "d7")].record
    assert (b.did, b.ip, b.aid, b.extension) == ("d7", "1.1.1.1", "a7", {"event_type": "click"})
    assert got[("b.csv", "d7")].event_type == "click"
    assert len(ok) == 5


def test_oversized_file_rejected(spark, tmp_path):
    big = "did,timestamp,event_type\n" + "d,1,order\n" * (10 * 1024 * 1024 // 10 + 10)
    _write(tmp_path, "big.csv", big)
    _write(tmp_path, "small.csv", "did,timestamp,event_type\nd,1,order\n")
    rows, files = _read(spark, tmp_path)
    fv = {r.file: (r.status, r.reason) for r in files.collect()}
    assert fv["big.csv"][0] == 400 and fv["big.csv"][1].startswith("The file is too large:")
    assert fv["small.csv"] == (200, None)
    assert {r.file for r in rows.collect()} == {"small.csv"}


import pytest  # noqa: E402


@pytest.mark.parametrize(
    "header,missing",
    [("timestamp,event_type", "did"), ("did,event_type", "timestamp"), ("did,timestamp", "event_type"), ("x", "did")],
)
def test_each_missing_required_column(spark, tmp_path, header, missing):
    _write(tmp_path, "f.csv", header + "\n" + ",".join(["v"] * len(header.split(","))) + "\n")
    rows, files = _read(spark, tmp_path)
    f = files.first()
    assert (f.status, f.reason) == (400, f"Missing Required field: No {missing}")
    assert rows.count() == 0


def test_odd_names_headers_and_quotes(spark, tmp_path):
    _write(tmp_path, "up[1] a.csv", "\n\r\ndid,timestamp,event_type\r\nd1,1,order\r\n")
    _write(tmp_path, "quoted.csv", 'did,timestamp,event_type,"odd\nname"\nd2,1,order,"a""b\r\nc"\n')
    _write(tmp_path, "bare.csv", 'did,timestamp,event_type\nd3,1,cl"ick\nd4,1,"cl"ick\n"d5","1","order"\nd6,1,"never closed\nd7,1,order\n')
    _write(tmp_path, "wide.csv", "did,timestamp,event_type," + "x" * 1_200_000 + "\nd8,1,order,v")
    _write(tmp_path, "badhead.csv", 'did,"time"stamp,event_type\nd9,1,order\n')
    _write(tmp_path, "headonly.csv", "did,timestamp,event_type")
    _write(tmp_path, "twice.csv", "x,did,timestamp,event_type,x,did\n1,no,1,order,2,d10\n")
    rows, files = _read(spark, tmp_path)
    fv = {r.file: (r.status, r.reason) for r in files.collect()}
    assert {k: v[0] for k, v in fv.items()} == {k: 500 if k == "badhead.csv" else 200 for k in fv} and len(fv) == 7
    got = {(r.file, r.record.did): r for r in rows.collect() if r.record}
    assert sorted(k[1] for k in got) == ["d1", "d10", "d2", "d5", "d8"]
    assert got["quoted.csv", "d2"].record.extension == {"event_type": "order", "odd\nname": 'a"b\nc'}
    assert got["wide.csv", "d8"].record.extension["x" * 1_200_000] == "v"
    assert got["twice.csv", "d10"].record.extension == {"event_type": "order", "x": "2"}
    bad = sorted(r.raw_line for r in rows.collect() if r.status == 500)
    assert bad == ['d3,1,cl"ick', 'd4,1,"cl"ick', 'd6,1,"never closed\nd7,1,order']


def test_every_upload_of_a_manifest_has_a_verdict(spark, tmp_path):
    names = {"ok.csv": "did,timestamp,event_type\nd,1,order\n", "_hidden.csv": "did\n", "empty.csv": "", "head.csv": "did,timestamp,event_type\n"}
    for name, text in names.items():
        _write(tmp_path, name, text)
    sent = [(f"file:{tmp_path}/{n}", len(t)) for n, t in names.items()] + [(f"file:{tmp_path}/gone.csv", 7), (f"file:{tmp_path}/huge.csv", 20_000_000)]
    manifest = spark.createDataFrame(sent, "file_path string, file_size long")
    _, files = read_event_csv(spark, str(tmp_path), manifest=manifest)
    got = {r.file_path.rsplit("/", 1)[1]: (r.status, r.reason) for r in files.collect()}
    assert got["ok.csv"] == got["head.csv"] == (200, None)
    assert got["empty.csv"] == (500, "Failed to read the first line of file:EOF")
    assert got["_hidden.csv"][0] == got["gone.csv"][0] == 500
    assert got["huge.csv"] == (400, "The file is too large:20000000bytes")
