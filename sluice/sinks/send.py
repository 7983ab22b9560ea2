"""Sending messages with a result for each, and the counts of it.

A sender takes a batch of messages (``message_id, topic, partition, key,
value``) and the name of the batch, and sends them. It may

* return nothing: all are acknowledged;
* return ``schema.SEND_RESULT`` rows: an error, or null, for each message; a
  message without a row is counted as failed;
* raise: none is acknowledged.

``settle`` runs a sender exactly once per call, writes the results in the
shared folder and counts them as they are written, with ``observe``: no state
is kept and nothing is read twice for the counts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.schema import SEND_FAILED_MSG, SEND_RESULT
from sluice.session import scratch_path
from sluice.sinks.deadletter import packed, unpacked
from sluice.sinks.topic_table import write_topic_table

Send = Callable[[DataFrame, str], DataFrame | None]
NO_RESULT = "no result"
MESSAGE_COLUMNS = ("topic", "partition", "key", "value")


class BadResult(TypeError):
    """What a function returned doesn't have the columns it has to have."""


def checked(results: DataFrame, schema) -> DataFrame:
    """``results``, if it has the columns of ``schema`` in order."""
    if [(f.name, f.dataType) for f in results.schema] != [(f.name, f.dataType) for f in schema]:
        raise BadResult(f"expected {schema.simpleString()}, not {results.schema.simpleString()}")
    return results


class Sent:
    """``results`` (message_id, error), written; ``success`` and ``failed`` messages."""

    def __init__(self, results: DataFrame, success: int, failed: int):
        self.results, self.success, self.failed = results, success, failed

    def failures(self, messages: DataFrame) -> DataFrame:
        """The messages that were not acknowledged, with their ``error``."""
        rest = [c for c in messages.columns if c != "message_id"]
        refused = self.results.where(F.col("error").isNotNull()).select(packed("message_id").alias("name"), "error")
        named = messages.select(packed("message_id").alias("name"), *rest).join(refused, "name")
        return named.select(unpacked("name").alias("message_id"), *rest, "error")


def settle(messages: DataFrame, send: Send, batch: str, keep: tuple[str, ...] = ()) -> Sent:
    """Sends the messages and writes what came of each; ``keep`` names columns, one value a message, that go with the results."""
    spark = messages.sparkSession
    ids = messages.groupBy(packed("message_id").alias("name")).agg(F.count(F.lit(1)).alias("copies"), *[F.min(c).alias(c) for c in keep])
    path = scratch_path(spark, "send-results")
    schema = T.StructType([*SEND_RESULT.fields, *[messages.schema[c] for c in keep]])

    def written(results: DataFrame) -> Sent:
        counts = Observation()
        ok = F.col("error").isNull()
        results = results.select(unpacked("name").alias("message_id"), "error", *keep, "copies")
        counted = results.observe(counts, F.sum(F.when(ok, F.col("copies"))).alias("success"), F.sum(F.when(~ok, F.col("copies"))).alias("failed"))
        counted.write.mode("overwrite").option("compression", "zstd").parquet(path)
        got = counts.get
        return Sent(spark.read.schema(schema).parquet(path), got.get("success") or 0, got.get("failed") or 0)

    try:
        told = send(messages, batch)
        if told is None:
            return written(ids.withColumn("error", F.lit(None).cast("string")))
        told = checked(told, SEND_RESULT).groupBy(packed("message_id").alias("name")).agg(F.max("error").alias("error"), F.lit(True).alias("told"))
        error = F.when(F.col("told").isNull(), F.lit(NO_RESULT)).otherwise(F.col("error"))
        return written(ids.join(told, "name", "left").withColumn("error", error))
    except BadResult:
        raise
    except Exception as exc:  # the sink refused the batch
        error = SEND_FAILED_MSG + (str(exc) or type(exc).__name__)
        return written(ids.withColumn("error", F.lit(error)))


def topic_table_sender(path: str) -> Send:
    """Messages go to the Parquet topic table at ``path``, each batch to a folder of its own."""

    def send(messages: DataFrame, batch: str) -> None:
        write_topic_table(messages.select(*MESSAGE_COLUMNS), path, batch)

    return send


def each_topic(write: Callable[[DataFrame], None]) -> Send:
    """Topics written one by one, as a broker refuses one and takes another; topics are as many as the route table names."""

    def send(messages: DataFrame, batch: str) -> DataFrame:
        refused: list[tuple[str | None, str]] = []
        for topic in sorted(r.topic or "" for r in messages.select("topic").distinct().collect()):
            of_topic = messages.where(F.coalesce("topic", F.lit("")) == topic)
            try:
                write(of_topic.select(*MESSAGE_COLUMNS))
            except Exception as exc:
                refused.append((topic, SEND_FAILED_MSG + (str(exc) or type(exc).__name__)))
        error = F.lit(None).cast("string")
        for topic, text in refused:
            error = F.when(F.coalesce("topic", F.lit("")) == topic, F.lit(text)).otherwise(error)
        return messages.select("message_id", error.alias("error"))

    return send
