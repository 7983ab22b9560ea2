"""Postback ingest and click delivery as streams: payloads, refused sends, batches without a valid row."""

import json

from pyspark.sql import functions as F

from sluice.sources.forms import REQUEST_LOG
from sluice.streaming.click_job import message_file_stream, start_click_job
from sluice.streaming.ingest_job import request_file_stream
from sluice.streaming.postback_job import start_postback_job

KEY = "k"


def request(spark, path, bodies):
    names = REQUEST_LOG.fieldNames()
    rows = [tuple({"request_id": i, "path": "/p", "query": "", "body": b}.get(n, "") for n in names) for i, b in enumerate(bodies)]
    spark.createDataFrame(rows, REQUEST_LOG).coalesce(1).write.mode("append").parquet(path)


def run(spark, tmp_path, sink=None):
    body = "appid=1&adname=n&adid=2&device=d&idfa=i&point=3&ts=1700000000000&sign=x&keyword=kw&more=m"
    request(spark, f"{tmp_path}/log", [body, "appid=1"])
    paths = [f"{tmp_path}/{n}" for n in ("topics", "dead", "outbox", "checkpoint")]
    q = start_postback_job(request_file_stream(spark, f"{tmp_path}/log"), KEY, "http://n", "default", *paths, sink=sink, bypass_sign=True, available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    return paths


def test_accepted_postbacks_become_messages_and_notifications(spark, tmp_path):
    topics, _, outbox, _ = run(spark, tmp_path)
    rows = spark.read.parquet(topics).collect()
    record = json.loads(bytes(rows[0].value))
    assert [r.topic for r in rows] == ["default"]
    assert (record["event"], record["id"], record["did"], record["timestamp"]) == ("anwo_postback", "kw", "i", "2023-11-14T22:13:20Z")
    assert [r.url for r in spark.read.parquet(outbox).collect()] == ["http://n?params=kw"]


def test_a_refused_batch_is_kept_with_its_payload_and_still_notified(spark, tmp_path):
    def refuse(messages, batch_id):
        raise RuntimeError()

    _, dead, outbox, _ = run(spark, tmp_path, refuse)
    letters = spark.read.parquet(dead).collect()
    assert [(r.topic, r.error) for r in letters] == [("default", "Failed to send message to kafka:RuntimeError")]
    assert json.loads(bytes(letters[0].data))["id"] == "kw"
    assert spark.read.parquet(outbox).count() == 1


def test_click_delivery_survives_a_batch_without_valid_clicks(spark, tmp_path):
    rows = spark.createDataFrame([(0, b"not a record")], "offset long, value binary")
    full = rows.select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), "offset", F.lit(None).cast("binary").alias("key"), "value", F.current_timestamp().alias("timestamp"))
    full.write.parquet(f"{tmp_path}/messages")
    seen = []
    q = start_click_job(
        message_file_stream(spark, f"{tmp_path}/messages"),
        f"{tmp_path}/outbox",
        f"{tmp_path}/checkpoint",
        "http://c",
        "pid",
        deliver=lambda frame, batch_id: seen.append((batch_id, frame.count())),
        available_now=True,
    )
    q.awaitTermination()
    assert q.exception() is None and seen == [(0, 0)]
