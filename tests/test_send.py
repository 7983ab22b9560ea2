"""Senders: results for each message, refused batches, counts; and the counts of a stream."""

import pytest
from pyspark.sql import functions as F

from sluice.plans import derive, settings
from sluice.schema import SEND_RESULT
from sluice.sinks.ledger import DeadLetterLedger
from sluice.sinks.send import NO_RESULT, BadResult, each_topic, settle, topic_table_sender
from sluice.sinks.topic_table import write_topic_table
from sluice.streaming.counts import RequestCounts
from sluice.streaming.ingest_job import request_file_stream, start_ingest_job

SF = "/root/testdata/sf0.001"


@pytest.fixture
def messages(spark):
    rows = [(f"m{n}", "a" if n < 3 else "b", None, None, bytearray(b"x")) for n in range(5)] + [("m0", "a", None, None, bytearray(b"x"))]
    return spark.createDataFrame(rows, "message_id string, topic string, partition int, key binary, value binary")


def errors(sent):
    return {r.message_id: r.error for r in sent.results.collect()}


def test_a_table_takes_all(spark, messages, tmp_path):
    sent = settle(messages, topic_table_sender(f"{tmp_path}/t"), "b1")
    assert (sent.success, sent.failed) == (6, 0) and set(errors(sent).values()) == {None}
    settle(messages, topic_table_sender(f"{tmp_path}/t"), "b1")
    back = spark.read.parquet(f"{tmp_path}/t")
    assert back.count() == 6 and "message_id" not in back.columns


def test_results_for_some(spark, messages):
    def send(m, batch):
        return m.where("message_id <> 'm4'").select("message_id", F.when(F.col("message_id") == "m1", F.lit("no")).alias("error"))

    sent = settle(messages, send, "b")
    assert errors(sent) == {"m0": None, "m1": "no", "m2": None, "m3": None, "m4": NO_RESULT}
    assert (sent.success, sent.failed) == (4, 2)
    assert sorted((r.message_id, r.topic, r.error) for r in sent.failures(messages).collect()) == [("m1", "a", "no"), ("m4", "b", NO_RESULT)]


def test_a_sender_that_raises_or_breaks_in_a_task(spark, messages):
    def at_once(m, batch):
        raise TypeError("down")

    def in_a_task(m, batch):
        return m.select("message_id", F.raise_error(F.lit("lost")).cast("string").alias("error"))

    for send, text in ((at_once, "Failed to send message to kafka:down"), (in_a_task, "lost")):
        sent = settle(messages, send, "b")
        assert (sent.success, sent.failed) == (0, 6) and all(text in e for e in errors(sent).values())


def test_results_of_another_shape_are_an_error(spark, messages):
    with pytest.raises(BadResult):
        settle(messages, lambda m, b: m.select("message_id"), "b")


def test_no_messages(spark, messages):
    sent = settle(messages.limit(0), lambda m, b: None, "b")
    assert (sent.success, sent.failed) == (0, 0) and sent.results.schema == SEND_RESULT


def test_topics_are_refused_one_by_one(spark, messages, tmp_path):
    def write(of_topic):
        if of_topic.first().topic == "a":
            raise RuntimeError("unknown topic")
        write_topic_table(of_topic, f"{tmp_path}/t")

    sent = settle(messages, each_topic(write), "b")
    assert (sent.success, sent.failed) == (2, 4)
    assert errors(sent)["m0"].endswith("unknown topic") and errors(sent)["m3"] is None
    assert [r.topic for r in spark.read.parquet(f"{tmp_path}/t").select("topic").distinct().collect()] == ["b"]


def test_stream_counts_equal_what_the_sink_and_the_ledger_hold(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    derive.request_log(events).repartition(3).write.parquet(f"{tmp_path}/in")
    listener = RequestCounts()
    spark.streams.addListener(listener)

    def sink(messages, batch_id):
        refused = F.crc32("message_id") % 3 == 0
        write_topic_table(messages.where(~refused), f"{tmp_path}/topics", batch_id)
        return messages.select("message_id", F.when(refused, F.lit("no")).alias("error"))

    try:
        q = start_ingest_job(
            request_file_stream(spark, f"{tmp_path}/in", 1), settings.ROUTES, f"{tmp_path}/topics", f"{tmp_path}/dead", f"{tmp_path}/ckpt", sink=sink, available_now=True, counts_path=f"{tmp_path}/counts"
        )
        q.awaitTermination()
        assert q.exception() is None
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    counts = {r.batch_id: r for r in spark.read.parquet(f"{tmp_path}/counts").collect()}
    taken = {r.batch_id: r["count"] for r in spark.read.parquet(f"{tmp_path}/topics").groupBy("batch_id").count().collect()}
    ledger = DeadLetterLedger(spark, f"{tmp_path}/dead")
    kinds = [F.count_if(F.col("kind") == k).alias(k) for k in ("unsent", "rejected")]
    kept = {int(r.commit.split("-")[1]): (r.unsent, r.rejected) for r in ledger.letters().groupBy("commit").agg(*kinds).collect()}
    assert len(counts) == 3
    for batch, r in counts.items():
        assert r.success == taken[batch] and (r.failed, r.rejected) == kept[batch] and r.failed > 0
        # requests without repeats: what the progress report saw is what was counted
        assert listener.by_batch[batch] == r.success + r.failed + r.rejected
    assert sum(r.success + r.failed + r.rejected for r in counts.values()) == events.count()
