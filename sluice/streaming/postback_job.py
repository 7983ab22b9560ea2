"""Partner postbacks as a stream: record to the default topic, notification to the outbox.

Each micro-batch of request-log rows is judged once. Accepted postbacks become
messages; those that ``sink`` refuses are kept in the dead-letter ledger with
their payload. The notification is due either way, as the
original sends it whether or not its record could be written. All tables are
written under ``batch_id=N`` before the progress is committed, and a re-run
batch replaces its own folders. A sink that fails half-way has sent some of
the messages that are kept as well: at least once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from sluice.plans.ingest import unsent_letters
from sluice.plans.partner import judge_postbacks, postback_messages, postback_outbox
from sluice.sinks.ledger import DeadLetterLedger
from sluice.sinks.outbox import write_outbox
from sluice.sinks.send import settle
from sluice.sinks.topic_table import write_topic_table
from sluice.streaming.counts import job_name


def start_postback_job(
    requests: DataFrame,
    key: str,
    base: str,
    topic: str,
    topics_path: str,
    dead_letter_path: str,
    outbox_path: str,
    checkpoint: str,
    sink: Callable[[DataFrame, int], "DataFrame | None"] | None = None,
    bypass_sign: bool = False,
    codec: str = "json",
    available_now: bool = False,
) -> StreamingQuery:
    job = job_name(checkpoint)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        # messages and notifications read the same judged batch, bounded by the trigger
        judged = judge_postbacks(batch, key, bypass_sign).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            messages = postback_messages(judged, topic, codec)
            sent = settle(messages, lambda m, _: sink(m, batch_id) if sink else write_topic_table(m, topics_path, batch_id), f"{job}-{batch_id}")
            if sent.failed:
                ledger = DeadLetterLedger(batch.sparkSession, dead_letter_path)
                ledger.append(unsent_letters(sent.failures(messages)), f"{job}-{batch_id}")
            write_outbox(postback_outbox(judged, base), outbox_path, batch_id)
        finally:
            judged.unpersist()

    writer = requests.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
