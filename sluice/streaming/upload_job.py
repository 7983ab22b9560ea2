"""CSV uploads as a stream.

``start_upload_job`` follows a landing folder: a ``binaryFile`` file stream
yields new uploads with their content, as many per micro-batch as a hundred of
the largest weigh. ``start_upload_request_job`` follows the upload requests instead
(file_path, file_size): each micro-batch reads the files that its requests name
and joins them back, so that empty, missing, oversized and header-only uploads
get their reply too.

Both parse with the batch reader's own functions and send the rows' messages
with ``sinks.send``: what the sink refuses goes to the dead-letter ledger and
into the upload's reply, and the stream goes on. Messages, letters, replies and
counts carry the batch's name, so a re-run batch replaces its own.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from sluice.plans.ingest import ingest_uploads, unsent_letters
from sluice.schema import MAX_UPLOAD_BYTES
from sluice.sinks.ledger import DeadLetterLedger
from sluice.sinks.outbox import write_outbox
from sluice.sinks.send import settle
from sluice.sinks.topic_table import write_topic_table
from sluice.sources.csv_upload import file_verdicts, upload_replies, upload_rows, with_manifest
from sluice.streaming.counts import job_name, write_counts

UPLOAD_REQUEST = T.StructType([T.StructField("file_path", T.StringType()), T.StructField("file_size", T.LongType())])
# Bytes of a micro-batch: small uploads are many to a batch, so that its fixed cost is shared.
BATCH_BYTES = 100 * MAX_UPLOAD_BYTES
UPLOAD_FILE = "path string, modificationTime timestamp, length long, content binary"
Sink = Callable[[DataFrame, int], "DataFrame | None"]


def upload_file_stream(spark: SparkSession, folder: str, glob: str = "*.csv", max_files_per_trigger: int | None = None, max_bytes_per_trigger: int = BATCH_BYTES) -> DataFrame:
    bound = ("maxFilesPerTrigger", max_files_per_trigger) if max_files_per_trigger else ("maxBytesPerTrigger", max_bytes_per_trigger)
    return (
        spark.readStream.format("binaryFile")
        .schema(UPLOAD_FILE)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .option(*bound)
        .load(folder)
    )


def upload_request_stream(spark: SparkSession, folder: str, max_files_per_trigger: int = 10) -> DataFrame:
    """Parquet files of upload requests as a stream."""
    return spark.readStream.schema(UPLOAD_REQUEST).option("maxFilesPerTrigger", max_files_per_trigger).parquet(folder)


def are_files(spark: SparkSession, paths: list[str]) -> list[bool]:
    """Whether each path is a file that is there, asked for side by side."""
    to_path, conf = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jsc.hadoopConfiguration()

    def is_file(path: str) -> bool:
        p = to_path(path)
        fs = p.getFileSystem(conf)
        return fs.exists(p) and fs.getFileStatus(p).isFile()

    with ThreadPoolExecutor(16) as pool:
        return list(pool.map(is_file, paths))


def requested_files(requests: DataFrame) -> DataFrame:
    """The uploads that a micro-batch's requests name and that are there; the list of them is as long as the batch."""
    spark = requests.sparkSession
    wanted = requests.where((F.col("file_size") > 0) & (F.col("file_size") <= MAX_UPLOAD_BYTES)).select("file_path").distinct()
    named = [r.file_path for r in wanted.collect() if r.file_path]
    found = [path for path, there in zip(named, are_files(spark, named)) if there]
    if not found:
        return spark.createDataFrame([], UPLOAD_FILE)
    # names are names, not patterns
    return spark.read.format("binaryFile").load([re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in found])


def _ingest(
    rows: DataFrame,
    verdicts: DataFrame,
    routes: Mapping[str, str],
    topics_path: str,
    dead_letter_path: str,
    replies_path: str | None,
    counts_path: str | None,
    sink: Sink | None,
    until_fault: bool,
    job: str,
    batch_id: int,
) -> None:
    """One micro-batch: send, keep what was refused, reply, count."""
    spark = rows.sparkSession
    # sinks, letters and replies read the batch's rows and verdicts: keep them (bounded by the trigger)
    rows, verdicts = rows.persist(StorageLevel.MEMORY_AND_DISK), verdicts.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        messages, dead = ingest_uploads(rows, verdicts, routes)
        sent = settle(messages, lambda m, _: sink(m, batch_id) if sink else write_topic_table(m, topics_path, batch_id), f"{job}-{batch_id}")
        failures = sent.failures(messages).withColumn("file_path", F.regexp_extract("origin", r"(?s)\A(.*)#[0-9]+\z", 1))
        reported = DeadLetterLedger(spark, dead_letter_path).append(dead.unionByName(unsent_letters(failures)), f"{job}-{batch_id}")
        if replies_path:
            refused = failures.groupBy("file_path").agg(F.count(F.lit(1)).alias("n_refused"), F.min("error").alias("error"))
            write_outbox(upload_replies(rows, verdicts, until_fault, refused), replies_path, batch_id)
        write_counts(spark, counts_path, batch_id, sent.success, sent.failed, reported - sent.failed)
    finally:
        rows.unpersist()
        verdicts.unpersist()


def _start(stream: DataFrame, each_batch, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def start_upload_job(
    files: DataFrame,
    routes: Mapping[str, str],
    topics_path: str,
    dead_letter_path: str,
    checkpoint: str,
    available_now: bool = False,
    sink: Sink | None = None,
    replies_path: str | None = None,
    counts_path: str | None = None,
    until_fault: bool = False,
) -> StreamingQuery:
    def each_batch(batch: DataFrame, batch_id: int) -> None:
        rows, verdicts = upload_rows(batch, until_fault), file_verdicts(batch)
        _ingest(rows, verdicts, routes, topics_path, dead_letter_path, replies_path, counts_path, sink, until_fault, job_name(checkpoint), batch_id)

    return _start(files, each_batch, checkpoint, available_now)


def start_upload_request_job(
    requests: DataFrame,
    routes: Mapping[str, str],
    topics_path: str,
    dead_letter_path: str,
    replies_path: str,
    checkpoint: str,
    available_now: bool = False,
    sink: Sink | None = None,
    counts_path: str | None = None,
    until_fault: bool = False,
) -> StreamingQuery:
    """Uploads by request: every request of a micro-batch gets one reply."""

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        asked = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            files = requested_files(asked)
            verdicts = with_manifest(file_verdicts(files), asked.groupBy("file_path").agg(F.max("file_size").alias("file_size")))
            _ingest(upload_rows(files, until_fault), verdicts, routes, topics_path, dead_letter_path, replies_path, counts_path, sink, until_fault, job_name(checkpoint), batch_id)
        finally:
            asked.unpersist()

    return _start(requests, each_batch, checkpoint, available_now)
