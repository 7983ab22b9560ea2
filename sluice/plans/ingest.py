"""Form ingest: request log -> parameters -> verdict -> record -> topic."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.timefmt import event_time
from sluice.operators.assemble import assemble_event
from sluice.operators.codec import encode
from sluice.operators.routing import route
from sluice.operators.validate import validate_event
from sluice.schema import REJECTED
from sluice.sinks.deadletter import to_dead_letters
from sluice.sinks.kafka import named_messages
from sluice.sources.forms import parse_requests


def ingest_forms(requests: DataFrame, routes: Mapping[str, str] | DataFrame) -> DataFrame:
    """Every request with ``params``, ``status``/``reason``, ``record`` (valid rows),
    ``topic`` and ``event_time`` (the record's timestamp as TIMESTAMP, when it is one).

    Row-local from end to end: no shuffle, one pass over the request log.
    """
    df = parse_requests(requests)
    df = validate_event(df)
    df = assemble_event(df)
    df = df.withColumn("record", F.when(F.col("status") == 200, F.col("record")))
    et = F.try_element_at(F.col("params"), F.lit("event_type"))
    df = route(df, routes, event_type=et)
    return df.withColumns(
        {
            "topic": F.when(F.col("status") == 200, F.col("topic")),
            # typed time for downstream use; not part of the record
            "event_time": event_time(F.col("record.timestamp")),
        }
    )


def topic_counts(ingested: DataFrame) -> DataFrame:
    """Valid events per topic (partial counts per task, merged by topic)."""
    return ingested.filter(F.col("status") == 200).groupBy("topic").agg(F.count(F.lit(1)).alias("n_events"))


def form_messages_and_dead_letters(ingested: DataFrame, codec: str = "json") -> tuple[DataFrame, DataFrame]:
    """Split ingested requests into topic messages (valid) and dead letters (rejected).

    Both come from one pass over the request log; nothing is dropped: every
    request is either a message or a dead letter carrying its reason. A
    rejected request never became a record, so its letter holds the raw form
    text and is not one to be sent again.
    """
    ok = F.col("status") == 200
    origin = F.concat(F.lit("request:"), F.col("request_id").cast("string"))
    messages = named_messages(ingested.filter(ok), encode(F.col("record"), codec), origin)
    dead = to_dead_letters(
        ingested.filter(~ok),
        error=F.col("reason"),
        record=F.col("params"),
        data=F.encode(F.concat_ws("&", F.col("body"), F.col("query")), "UTF-8"),
        topic=F.lit(None).cast("string"),
        origin=origin,
        kind=REJECTED,
    )
    return messages, dead


def unsent_letters(failures: DataFrame) -> DataFrame:
    """Dead letters of the messages that a sink refused (``sinks.send``), with their encoded payload."""
    return to_dead_letters(failures, F.col("error"), None, F.col("value"), F.col("topic"), origin=F.col("origin"))


def ingest_uploads(rows: DataFrame, files: DataFrame, routes: Mapping[str, str] | DataFrame, codec: str = "json") -> tuple[DataFrame, DataFrame]:
    """CSV upload rows -> topic messages (routed by the row's ``event_type``) and
    dead letters: every ragged row, plus one letter per rejected file."""
    routed = route(rows, routes, event_type="event_type")
    ok = F.col("status") == 200
    line = F.concat(F.col("file_path"), F.lit("#"), F.col("line").cast("string"))
    messages = named_messages(routed.filter(ok), encode(F.col("record"), codec), line)
    none = F.lit(None).cast("string")
    bad_rows = to_dead_letters(routed.filter(~ok), F.col("reason"), None, F.encode(F.col("raw_line"), "UTF-8"), none, origin=line, kind=REJECTED)
    bad_files = to_dead_letters(
        files.filter(F.col("status") != 200), F.col("reason"), F.struct(F.col("file_path")), F.lit(None).cast("binary"), none, origin=F.col("file_path"), kind=REJECTED
    )
    return messages, bad_rows.unionByName(bad_files)
