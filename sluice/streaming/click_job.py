"""The continuous click-forwarding job.

Source: a topic subscription (``sources.kafka.read_topics``) or any streaming
DataFrame with a binary ``value`` column and an ``offset`` (e.g. a Parquet
file stream). Each micro-batch is decoded, judged and turned into outbound
partner requests, written to the outbox table under ``batch_id=N``.

Delivery guarantee: the outbox is written before the batch's progress is
committed, and a re-run batch overwrites its own ``batch_id`` partition, so
each click request lands in the outbox exactly once per batch. By default the
delivery function runs again for a re-run batch (at least once). The original
marked a message done *before* sending its request; with ``claims_path`` the
job does the same (at most once). A stateless query: no keyed state, no
watermark; the claim log grows by one empty file a batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sluice.plans.partner import click_outbox
from sluice.schema import DELIVERY_RESULT
from sluice.session import _fs_exists, scratch_path
from sluice.sinks.outbox import delivery_results, with_request_key, write_outbox
from sluice.sinks.send import checked
from sluice.sources.kafka import read_topics

Deliver = Callable[[DataFrame, int], "DataFrame | None"]


def claim(spark: SparkSession, claims_path: str, batch_id: int) -> bool:
    """Marks a batch as taken; false if it is taken already. One file a batch, made in one step by the file system."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{claims_path.rstrip('/')}/batch_id={int(batch_id)}")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).createNewFile(path)


def start_click_job(
    messages: DataFrame,
    outbox_path: str,
    checkpoint: str,
    base: str,
    pid: str,
    codec: str = "json",
    deliver: Deliver | None = None,
    available_now: bool = False,
    processing_time: str | None = None,
    results_path: str | None = None,
    claims_path: str | None = None,
) -> StreamingQuery:
    """Start the job; ``deliver(outbox_batch, batch_id)`` may send the requests and return their results.

    ``results_path`` gets every request with its result, under ``batch_id=N``.
    With ``claims_path`` delivery is at most once, as the original's: a batch
    is claimed there before it is sent, and a claimed batch is never sent
    again, whether or not its sending ended.
    """

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        out = click_outbox(batch, base, pid, codec=codec)
        write_outbox(out, outbox_path, batch_id)
        if deliver is None or (claims_path and not claim(spark, claims_path, batch_id)):
            return
        # a batch without a valid click leaves no folder: it delivers no rows
        written = f"{outbox_path}/batch_id={batch_id}"
        requests = spark.read.schema(out.schema).parquet(written) if _fs_exists(spark, written) else out
        told = deliver(with_request_key(requests), batch_id)
        if told is not None:
            # sent once: what the results are made into reads what was written
            path = scratch_path(spark, "delivery")
            checked(told, DELIVERY_RESULT).write.parquet(path)
            told = spark.read.schema(DELIVERY_RESULT).parquet(path)
        if results_path:
            write_outbox(delivery_results(requests, told), results_path, batch_id)

    writer = messages.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def start_click_job_from_topics(
    spark: SparkSession, brokers: Sequence[str], topics: str | Sequence[str], read_from_oldest: bool = False, **job
) -> StreamingQuery:
    """The job on a subscription to ``topics`` (comma-separated or a list); ``job`` goes to ``start_click_job``."""
    return start_click_job(read_topics(spark, brokers, topics, read_from_oldest), **job)


def message_file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Parquet files of messages ``(topic, partition, offset, key, value, timestamp)`` as a stream."""
    from pyspark.sql import types as T

    schema = T.StructType(
        [
            T.StructField("topic", T.StringType()),
            T.StructField("partition", T.IntegerType()),
            T.StructField("offset", T.LongType()),
            T.StructField("key", T.BinaryType()),
            T.StructField("value", T.BinaryType()),
            T.StructField("timestamp", T.TimestampType()),
        ]
    )
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    elif max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.parquet(path)
