"""Partner flows: click forwarding (topic -> callback URL) and postbacks (request -> record)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.clicks import click_url, click_verdicts
from sluice.operators.codec import decode, encode
from sluice.operators.postback import postback_url, postbacks
from sluice.sinks.kafka import named_messages
from sluice.sinks.outbox import to_outbox
from sluice.sources.forms import parse_requests


def judge_clicks(messages: DataFrame, codec: str = "json") -> DataFrame:
    """Decode each message and give it a verdict (``ok`` rows are forwarded)."""
    return click_verdicts(decode(messages, codec=codec), decoded_ok="decoded")


def click_outbox(messages: DataFrame, base: str, pid: str, codec: str = "json", source_id: str = "offset") -> DataFrame:
    """T1 as a batch/stream transformation: messages -> outbound partner requests."""
    judged = judge_clicks(messages, codec).filter(F.col("verdict") == "ok")
    return to_outbox(judged, click_url(F.col("record"), base, pid), source_id)


def judge_postbacks(requests: DataFrame, key: str, bypass_sign: bool = False) -> DataFrame:
    return postbacks(parse_requests(requests), key, bypass_sign=bypass_sign)


def postback_outbox(judged: DataFrame, base: str, source_id: str = "request_id") -> DataFrame:
    ok = judged.filter(F.col("status") == 200)
    return to_outbox(ok, postback_url(F.try_element_at("params", F.lit("keyword")), base), source_id)


def postback_messages(judged: DataFrame, topic: str, codec: str = "json") -> DataFrame:
    """P3 -> K1: one message on ``topic`` for every accepted postback."""
    ok = judged.filter(F.col("status") == 200).withColumn("topic", F.lit(topic))
    return named_messages(ok, encode(F.col("record"), codec), F.concat(F.lit("request:"), F.col("request_id").cast("string")))
