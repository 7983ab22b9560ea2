"""Replay of what could not be written: decode each payload, route it by its event type, send it
again, count, and send the failures to the next retry generation."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.codec import decode, encode
from sluice.operators.routing import route
from sluice.schema import MAX_RETRY_GENERATIONS
from sluice.session import scratch_path
from sluice.sinks.deadletter import next_generation, to_dead_letters
from sluice.sinks.kafka import to_messages
from sluice.sinks.ledger import DeadLetterLedger
from sluice.sinks.send import Send, settle
from sluice.sinks.topic_table import write_topic_table

UNDECODABLE = "undecodable"


def replay(lines: DataFrame, routes: Mapping[str, str] | DataFrame, codec: str = "json") -> DataFrame:
    """Parsed backup lines -> ``record``, ``verdict`` (ok/undecodable), ``topic``, retry columns.

    Routing uses the record's ``extension['event_type']`` (unknown or absent
    types go to ``default``).
    """
    df = decode(lines.withColumn("data", F.when(F.col("bytes_ok"), F.col("data"))), value="data", codec=codec)
    df = df.withColumn("verdict", F.when(F.col("decoded"), F.lit("ok")).otherwise(F.lit(UNDECODABLE)))
    et = F.try_element_at(F.col("record.extension"), F.lit("event_type"))
    df = route(df, routes, event_type=et)
    df = df.withColumn("topic", F.when(F.col("decoded"), F.col("topic")))
    return next_generation(df)


def lines_to_letters(lines: DataFrame, error: str = "backup log") -> DataFrame:
    """Parsed backup lines (``sources.backup_log``) as dead letters at their generation; a line whose list is no bytes keeps its text."""
    data = F.when(F.col("bytes_ok"), F.col("data")).otherwise(F.encode("value", "UTF-8"))
    return to_dead_letters(lines, F.lit(error), None, data, F.lit(None).cast("string"), F.col("attempt"), F.col("file_path"))


def replay_ledger(
    ledger: DeadLetterLedger,
    send: Send,
    routes: Mapping[str, str] | DataFrame,
    commit: str,
    codec: str = "json",
    limit: int = MAX_RETRY_GENERATIONS,
) -> tuple[int, int]:
    """K5/A2: send every pending letter again; returns how many were sent and how many failed.

    Letters that don't decode fail without being sent. Those that fail are
    pending for the next replay, up to generation ``limit``; then they are
    exhausted and stay visible. A replay is run once by its name: run again
    after it has ended it does nothing, and after a crash it sends again what
    it may have sent (at least once), under the same batch name.
    """
    spark = ledger.spark
    if ledger.is_committed(commit):
        done = ledger.summary().where(F.col("commit") == commit).head()
        return (done.success, done.failed) if done else (0, 0)
    stage = scratch_path(spark, "replay-letters")
    todo = ledger.pending().select("letter_id", "origin", "attempt", "data", F.col("data").isNotNull().alias("bytes_ok"))
    replay(todo, routes, codec).select("letter_id", "origin", "attempt", "verdict", "topic", "data").write.option("compression", "zstd").parquet(stage)
    judged = spark.read.parquet(stage)
    ok = judged.where(F.col("verdict") == "ok")
    # a letter's message has the letter's name, whatever topic it is routed to now
    message = [F.col("letter_id").alias("message_id"), "origin", "attempt", "topic", F.lit(None).cast("int").alias("partition")]
    sent = settle(ok.select(*message, F.lit(None).cast("binary").alias("key"), F.col("data").alias("value")), send, commit, keep=("attempt",))
    results = sent.results.select(F.col("message_id").alias("letter_id"), "attempt", "error")
    unsendable = judged.where(F.col("verdict") != "ok").select("letter_id", "attempt", F.col("verdict").alias("error"))
    ledger.settle(results.unionByName(unsendable), commit, limit)
    done = ledger.summary().where(F.col("commit") == commit).head()
    return (done.success, done.failed) if done else (0, 0)


def replay_to_tables(replayed: DataFrame, topics_path: str, dead_letter_path: str, codec: str = "json", commit: str | None = None) -> None:
    """K5 write side: decoded lines go to the topic table; failed lines go to the
    dead-letter ledger as the next attempt. Lines past the last generation are
    logged at the last generation + 1 with error ``exhausted``, so they stay
    visible but are never replayed again.

    Both writes are named by ``commit`` (by default a digest of the files read),
    so a replay of the same files replaces what it wrote before. The judged
    lines are written once to a staging table in the shared checkpoint folder
    and both outputs read from it.
    """
    spark = replayed.sparkSession
    commit = commit or "replay-" + hashlib.sha1("\n".join(sorted(replayed.inputFiles())).encode()).hexdigest()[:16]
    stage = scratch_path(spark, "replay-stage")
    data = F.when(F.col("bytes_ok"), F.col("data")).otherwise(F.encode("value", "UTF-8"))
    replayed.select("record", data.alias("data"), "topic", "verdict", "next_attempt", "retry", "file_path").write.mode("overwrite").parquet(stage)
    replayed = spark.read.parquet(stage)

    ok = replayed.filter(F.col("verdict") == "ok")
    write_topic_table(to_messages(ok, encode(F.col("record"), codec)), topics_path, commit)
    failed = replayed.filter(F.col("verdict") != "ok")
    attempt = F.coalesce(F.col("next_attempt"), F.lit(MAX_RETRY_GENERATIONS + 1))
    error = F.when(F.col("retry") == "exhausted", F.lit("exhausted")).otherwise(F.col("verdict"))
    letters = to_dead_letters(failed, error, None, F.col("data"), F.col("topic"), attempt, F.col("file_path"))
    DeadLetterLedger(spark, dead_letter_path).append(letters, commit)
