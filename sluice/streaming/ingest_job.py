"""Form ingest as a Structured Streaming query (same operators as the batch plan).

Each micro-batch of request-log rows is parsed, validated, assembled and
routed; valid records become topic messages and rejected requests become dead
letters. Both writes finish before the batch's progress is committed (T3); a
re-run batch replaces its own messages and its letters are known already, so
nothing is doubled. ``sink`` may replace the Parquet topic table with a broker
write (see ``sinks.send``): what it refuses, one message or the whole batch,
is kept in the dead-letter ledger with error, payload and topic, to be
replayed, and the stream goes on. With ``counts_path`` a row a batch says how
many messages were sent, how many failed and how many requests were rejected.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from sluice.plans.ingest import form_messages_and_dead_letters, ingest_forms, unsent_letters
from sluice.sinks.ledger import DeadLetterLedger
from sluice.sinks.send import settle
from sluice.sinks.topic_table import write_topic_table
from sluice.sources.forms import REQUEST_LOG
from sluice.streaming.counts import job_name, seen, write_counts

Sink = Callable[[DataFrame, int], "DataFrame | None"]


def start_ingest_job(
    requests: DataFrame,
    routes: Mapping[str, str],
    topics_path: str,
    dead_letter_path: str,
    checkpoint: str,
    sink: Sink | None = None,
    available_now: bool = False,
    counts_path: str | None = None,
) -> StreamingQuery:
    job = job_name(checkpoint)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        # several writes read the same judged batch: keep it
        # (a micro-batch is bounded by the trigger's file/offset limits)
        judged = ingest_forms(batch, routes).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            messages, dead = form_messages_and_dead_letters(judged)
            sent = settle(messages, lambda m, _: sink(m, batch_id) if sink else write_topic_table(m, topics_path, batch_id), f"{job}-{batch_id}")
            if sent.failed:
                dead = dead.unionByName(unsent_letters(sent.failures(messages)))
            reported = DeadLetterLedger(batch.sparkSession, dead_letter_path).append(dead, f"{job}-{batch_id}")
            write_counts(batch.sparkSession, counts_path, batch_id, sent.success, sent.failed, reported - sent.failed)
        finally:
            judged.unpersist()

    writer = seen(requests).writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def request_file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(REQUEST_LOG)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    elif max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.parquet(path)
