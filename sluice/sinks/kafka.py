"""Topic sink. Each row carries its own ``topic``; one write serves all topics.

Spark's Kafka sink (``spark-sql-kafka`` package) takes rows
``(topic, partition, key, value)``. Writes require acknowledgement by all
replicas (``acks=all``), as the original producer did. The connector is not
bundled with PySpark; ``kafka_write_options`` is pure so it can be checked
without it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.sinks.deadletter import message_id
from sluice.sources.kafka import require_kafka


def kafka_write_options(brokers: Sequence[str], extra: Mapping[str, str] | None = None) -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": ",".join(brokers), "kafka.acks": "all"}
    opts.update(extra or {})
    return opts


def to_messages(df: DataFrame, value: Column, topic: str = "topic", partition: str | None = "partition", key: Column | None = None) -> DataFrame:
    """K1: rows shaped for the sink; ``value`` is BINARY."""
    return df.select(
        F.col(topic).alias("topic"),
        (F.col(partition) if partition and partition in df.columns else F.lit(None)).cast("int").alias("partition"),
        (key if key is not None else F.lit(None)).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
    )


def named_messages(df: DataFrame, value: Column, origin: Column, topic: str = "topic", partition: str | None = "partition", key: Column | None = None) -> DataFrame:
    """K1 with a name for each row: ``message_id``, the name of its dead letter if it is refused, and ``origin``. Sinks leave both out."""
    named = df.withColumns({"_origin": origin.cast("string"), "_value": value.cast("binary")})
    name = message_id(F.col(topic), F.col("_origin"), F.col("_value"))
    named = named.select(name.alias("message_id"), F.col("_origin").alias("origin"), "*")
    columns = [(F.col(partition) if partition and partition in df.columns else F.lit(None)).cast("int").alias("partition")]
    columns += [(key if key is not None else F.lit(None)).cast("binary").alias("key"), F.col("_value").alias("value")]
    return named.select("message_id", named["origin"], F.col(topic).alias("topic"), *columns)


def to_string_messages(df: DataFrame, text: Column, topic: str = "topic", partition: str | None = "partition") -> DataFrame:
    """K2: the same rows with a STRING payload (the sink accepts string values)."""
    return df.select(
        F.col(topic).alias("topic"),
        (F.col(partition) if partition and partition in df.columns else F.lit(None)).cast("int").alias("partition"),
        F.lit(None).cast("binary").alias("key"),
        text.cast("string").alias("value"),
    )


def write_topics(messages: DataFrame, brokers: Sequence[str], extra: Mapping[str, str] | None = None) -> None:
    """Batch write; raises if the connector is missing or any send fails."""
    require_kafka(messages.sparkSession)
    messages.drop("message_id", "origin").write.format("kafka").options(**kafka_write_options(brokers, extra)).save()


def write_topics_stream(messages: DataFrame, brokers: Sequence[str], checkpoint: str, extra: Mapping[str, str] | None = None):
    """Streaming write: progress commits only after the sink has acknowledged the batch."""
    require_kafka(messages.sparkSession)
    return (
        messages.writeStream.format("kafka")
        .options(**kafka_write_options(brokers, extra))
        .option("checkpointLocation", checkpoint)
        .start()
    )
