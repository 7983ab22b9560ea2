"""A2 in a stream: what each micro-batch sent, what failed and what was rejected.

The counts are taken by ``observe`` as a batch's results are written, so no
keyed state is kept. ``write_counts`` keeps them as a table, a row a batch;
``RequestCounts`` is a listener that reads the requests seen by each batch from
the query's progress, to hold the two against each other.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from sluice.sinks.outbox import write_outbox

SEEN = "requests_seen"


def job_name(checkpoint: str) -> str:
    """A name for the batches of one query: its numbers begin anew with another checkpoint."""
    return hashlib.sha1(checkpoint.encode()).hexdigest()[:10]


def write_counts(spark: SparkSession, path: str | None, batch_id: int, success: int, failed: int, rejected: int) -> None:
    if path:
        row = spark.createDataFrame([(int(success), int(failed), int(rejected))], "success long, failed long, rejected long")
        write_outbox(row, path, batch_id)


def seen(requests: DataFrame) -> DataFrame:
    """The stream with a count of its rows in every progress report."""
    return requests.observe(SEEN, F.count(F.lit(1)).alias("n"))


class RequestCounts(StreamingQueryListener):
    """``by_batch``: rows that each micro-batch read, from the progress reports (``seen``)."""

    def __init__(self):
        self.by_batch: dict[int, int] = {}

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        row = event.progress.observedMetrics.get(SEEN)
        if row is not None:
            self.by_batch[event.progress.batchId] = row.n

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
