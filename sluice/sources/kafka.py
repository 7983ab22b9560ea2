"""Topic sources through Spark's Kafka connector (``spark-sql-kafka``).

S3 is a streaming subscription to a comma-separated topic list; the query's
checkpoint replaces the consumer group's committed offsets, and
``read_from_oldest`` picks ``earliest`` or ``latest`` for a fresh start (T4).
A lost offset range is an error unless ``extra`` says otherwise.
S4 reads every partition of a topic from the oldest offset as a batch.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def require_kafka(spark: SparkSession) -> None:
    """Fail early and clearly when the ``spark-sql-kafka`` package is not on the classpath."""
    try:
        spark.sparkContext._jvm.java.lang.Class.forName("org.apache.spark.sql.kafka010.KafkaSourceProvider")
    except Exception as exc:  # py4j wraps ClassNotFoundException
        raise RuntimeError("topic sources and sinks need the spark-sql-kafka package on the Spark classpath") from exc


def kafka_read_options(
    brokers: Sequence[str],
    topics: str | Sequence[str],
    read_from_oldest: bool = False,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    names = topics.split(",") if isinstance(topics, str) else list(topics)
    names = [t.strip() for t in names if t.strip()]
    if not names:
        raise ValueError("at least one topic is required")
    opts = {
        "kafka.bootstrap.servers": ",".join(brokers),
        "subscribe": ",".join(names),
        "startingOffsets": "earliest" if read_from_oldest else "latest",
        "failOnDataLoss": "true",
    }
    opts.update(extra or {})
    return opts


def read_topics(
    spark: SparkSession,
    brokers: Sequence[str],
    topics: str | Sequence[str],
    read_from_oldest: bool = False,
    extra: Mapping[str, str] | None = None,
) -> DataFrame:
    """S3: streaming DataFrame ``(key, value, topic, partition, offset, timestamp, ...)``."""
    require_kafka(spark)
    return spark.readStream.format("kafka").options(**kafka_read_options(brokers, topics, read_from_oldest, extra)).load()


def read_topic_batch(spark: SparkSession, brokers: Sequence[str], topic: str, extra: Mapping[str, str] | None = None) -> DataFrame:
    """The whole topic, every partition, oldest to newest offset."""
    require_kafka(spark)
    opts = kafka_read_options(brokers, topic, True, extra)
    opts["endingOffsets"] = "latest"
    return spark.read.format("kafka").options(**opts).load()
