from pyspark.sql import functions as F

from sluice.plans import derive, settings
from sluice.plans.partner import click_outbox
from sluice.session import scratch_path
from sluice.streaming.click_job import message_file_stream, start_click_job

SF = "/root/testdata/sf0.001"


def test_stream_equals_batch(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    root = scratch_path(spark, "test-stream")
    derive.click_messages(events).repartition(4).write.parquet(f"{root}/in")
    q = start_click_job(
        message_file_stream(spark, f"{root}/in", max_files_per_trigger=1),
        f"{root}/outbox",
        f"{root}/ckpt",
        settings.CLICK_BASE_URL,
        settings.PARTNER_PID,
        available_now=True,
    )
    q.awaitTermination()
    streamed = spark.read.parquet(f"{root}/outbox")
    assert streamed.select("batch_id").distinct().count() >= 2
    batch = click_outbox(spark.read.parquet(f"{root}/in"), settings.CLICK_BASE_URL, settings.PARTNER_PID)
    key = ["source_id", "method", "url", "headers"]
    assert sorted(streamed.select(*key).collect()) == sorted(batch.select(*key).collect())
    assert batch.count() > 0


def test_rerun_batch_overwrites_its_partition(spark):
    from sluice.sinks.outbox import to_outbox, write_outbox

    root = scratch_path(spark, "test-outbox")
    df = spark.range(5).select(F.col("id").alias("s"), F.lit("u").alias("url"))
    out = to_outbox(df, "url", "s")
    write_outbox(out, root, 7)
    write_outbox(out, root, 7)
    write_outbox(out, root, 8)
    got = spark.read.parquet(root)
    assert got.filter("batch_id = 7").count() == 5 and got.count() == 10


def test_ingest_stream_equals_batch(spark):
    from sluice.plans.ingest import ingest_forms, topic_counts
    from sluice.streaming.ingest_job import request_file_stream, start_ingest_job

    events = spark.read.parquet(f"{SF}/events.parquet")
    root = scratch_path(spark, "test-ingest")
    derive.request_log(events).repartition(3).write.parquet(f"{root}/in")
    q = start_ingest_job(request_file_stream(spark, f"{root}/in", 1), settings.ROUTES, f"{root}/topics", f"{root}/dead", f"{root}/ckpt", available_now=True)
    q.awaitTermination()
    streamed = spark.read.parquet(f"{root}/topics").groupBy("topic").count()
    batch = topic_counts(ingest_forms(spark.read.parquet(f"{root}/in"), settings.ROUTES))
    assert sorted(tuple(r) for r in streamed.collect()) == sorted(tuple(r) for r in batch.collect())
    dead = spark.read.parquet(f"{root}/dead")
    assert dead.count() + sum(r[1] for r in streamed.collect()) == events.count()


def test_failed_sink_batches_become_dead_letters(spark):
    from sluice.streaming.ingest_job import request_file_stream, start_ingest_job

    events = spark.read.parquet(f"{SF}/events.parquet")
    root = scratch_path(spark, "test-failsink")
    derive.request_log(events).repartition(2).write.parquet(f"{root}/in")

    def broken_sink(messages, batch_id):
        raise RuntimeError("broker unavailable")

    q = start_ingest_job(request_file_stream(spark, f"{root}/in", 1), settings.ROUTES, f"{root}/topics", f"{root}/dead", f"{root}/ckpt", sink=broken_sink, available_now=True)
    q.awaitTermination()
    dead = spark.read.parquet(f"{root}/dead")
    assert dead.count() == events.count()  # rejected requests plus every message the sink refused
    failed = dead.filter(F.col("error").startswith("Failed to send message to kafka:broker unavailable"))
    assert failed.count() > 0 and failed.filter(F.col("data").isNull() | F.col("topic").isNull()).count() == 0
