"""Uploads the original's way: a file stops at its first fault; a reply to every request, also in a stream."""

import pytest
from pyspark.sql import functions as F

from sluice.schema import MAX_UPLOAD_BYTES
from sluice.sinks.ledger import DeadLetterLedger
from sluice.sources.csv_upload import list_uploads, read_event_csv, upload_replies, upload_rows
from sluice.streaming.upload_job import UPLOAD_REQUEST, start_upload_request_job, upload_request_stream

HEAD = "did,timestamp,event_type\n"
FILES = {
    "ok.csv": HEAD + "d1,1,click\nd2,2,view\n",
    "ragged.csv": HEAD + "d3,1,click\n\nd4,1,click\nd5,1\nd6,1,click\nd7,1,2,3\n",
    "first.csv": HEAD + 'd8,"a"b,click\nd9,1,click\n',
    "last.csv": HEAD + "d10,1,click\nd11",
    "head.csv": HEAD,
    "bad [1]{x}*?.csv": "﻿" + HEAD + "d12,1,click\n",
    "noid.csv": "timestamp,event_type\n1,click\n",
    "blank.csv": "\n\r\n",
}
FAULT = "Err read file:wrong number of fields"
# file: did of the rows kept, status, written, reply; a file that stops at its first fault
UNTIL_FAULT = {
    "ok.csv": (["d1", "d2"], 200, 2, "2 messages have been writen."),
    "ragged.csv": (["d3", "d4"], 500, 2, FAULT),
    "first.csv": ([], 500, 0, 'Err read file:bare " in non-quoted field'),
    "last.csv": (["d10"], 500, 1, FAULT),
    "head.csv": ([], 200, 0, "0 messages have been writen."),
    "bad [1]{x}*?.csv": (["d12"], 200, 1, "1 messages have been writen."),
    "noid.csv": ([], 400, 0, "Missing Required field: No did"),
    "blank.csv": ([], 500, 0, "Failed to read the first line of file:EOF"),
}


@pytest.fixture
def folder(tmp_path):
    for name, text in FILES.items():
        (tmp_path / name).write_bytes(text.encode())
    return tmp_path


def name(path="file_path"):
    return F.regexp_extract(path, r"([^/]+)\z", 1).alias("file")


def test_a_file_stops_at_its_first_fault(spark, folder):
    rows, files = read_event_csv(spark, str(folder), until_fault=True)
    kept = {n: [] for n in FILES}
    for r in rows.where("status = 200").select(name(), "line", "record.did").orderBy("line").collect():
        kept[r.file].append(r.did)
    faulty = [(r.file, r.line, r.raw_line) for r in rows.where("status <> 200").select(name(), "line", "raw_line").collect()]
    assert sorted(faulty) == [("first.csv", 1, 'd8,"a"b,click'), ("last.csv", 2, "d11"), ("ragged.csv", 3, "d5,1")]
    got = {r.file: (kept[r.file], r.status, r.n_written, r.reply) for r in upload_replies(rows, files, until_fault=True).select(name(), "status", "n_written", "reply").collect()}
    assert got == UNTIL_FAULT


def test_otherwise_every_good_row_is_written_and_told(spark, folder):
    rows, files = read_event_csv(spark, str(folder))
    got = {r.file: (r.status, r.n_written) for r in upload_replies(rows, files).select(name(), "status", "n_written").collect()}
    assert got["ragged.csv"] == (200, 3) and got["first.csv"] == (200, 1) and got["head.csv"] == (200, 0)


def test_lines_are_numbered_by_record(spark, folder):
    rows = upload_rows(list_uploads(spark, str(folder / "ragged.csv"))).orderBy("line").collect()
    assert [(r.line, r.status) for r in rows] == [(1, 200), (2, 200), (3, 500), (4, 200), (5, 500)]


def requests_of(spark, folder):
    sent = [(f"file:{folder}/{n}", len(t.encode())) for n, t in FILES.items()]
    sent += [(f"file:{folder}/empty.csv", 0), (f"file:{folder}/gone.csv", 5), (f"file:{folder}/huge.csv", MAX_UPLOAD_BYTES + 1)]
    (folder / "folder").mkdir()
    (folder / "folder" / "inside.csv").write_text(HEAD + "d99,1,click\n")
    sent += [(f"file:{folder}/folder", 7)]  # not a file
    return spark.createDataFrame(sent, UPLOAD_REQUEST)


def stream(spark, folder, sink=None, until_fault=True):
    out = folder / "out"
    requests_of(spark, folder).repartition(3).write.parquet(f"{out}/requests")
    q = start_upload_request_job(
        upload_request_stream(spark, f"{out}/requests", 1), {"default": "d", "click": "clicks"}, f"{out}/topics", f"{out}/dead", f"{out}/replies", f"{out}/ckpt", available_now=True,
        sink=sink, counts_path=f"{out}/counts", until_fault=until_fault,
    )
    q.awaitTermination()
    assert q.exception() is None
    replies = {r.file: (r.status, r.n_written, r.reply) for r in spark.read.parquet(f"{out}/replies").select(name(), "status", "n_written", "reply").collect()}
    counts = spark.read.parquet(f"{out}/counts").agg(F.sum("success"), F.sum("failed"), F.sum("rejected")).first()
    return out, replies, tuple(counts)


def test_every_request_of_a_stream_is_answered(spark, folder):
    out, replies, counts = stream(spark, folder)
    want = {n: v[1:] for n, v in UNTIL_FAULT.items()}
    want |= {
        "empty.csv": (500, 0, "Failed to read the first line of file:EOF"),
        "gone.csv": (500, 0, "Failed to read upload file:"),
        "folder": (500, 0, "Failed to read upload file:"),
        "huge.csv": (400, 0, f"The file is too large:{MAX_UPLOAD_BYTES + 1}bytes"),
    }
    assert replies == want
    assert spark.read.parquet(f"{out}/topics").count() == 6
    # three faulty rows and six rejected uploads
    assert counts == (6, 0, 9)


def test_a_sink_that_refuses_does_not_end_the_stream(spark, folder):
    def broken(messages, batch_id):
        raise RuntimeError("down")

    out, replies, counts = stream(spark, folder, broken, until_fault=False)
    assert replies["ok.csv"] == (500, 0, "Failed to send to kafka:Failed to send message to kafka:down")
    assert replies["head.csv"] == (200, 0, "0 messages have been writen.")
    letters = DeadLetterLedger(spark, f"{out}/dead").letters().where("kind = 'unsent'").collect()
    assert len(letters) == counts[1] == 8 and all(r.data is not None and r.topic in ("d", "clicks") for r in letters)
