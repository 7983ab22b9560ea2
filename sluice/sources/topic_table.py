"""S4 offline: read one topic back from a Parquet topic table and decode it.

The table is partitioned by ``topic`` (``sinks.topic_table``), so the filter
on the topic prunes the scan to that topic's folder; with a broker, the same
dump is ``sources.kafka.read_topic_batch``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.codec import decode


def read_topic_table(spark: SparkSession, path: str, topic: str | None = None) -> DataFrame:
    # topic names are text, even if every folder's name reads as a number
    found = spark.read.parquet(path).schema
    schema = T.StructType([T.StructField(f.name, T.StringType() if f.name == "topic" else f.dataType) for f in found])
    df = spark.read.schema(schema).parquet(path)
    return df.filter(F.col("topic") == topic) if topic is not None else df


def dump_topic(spark: SparkSession, path: str, topic: str, codec: str = "json") -> DataFrame:
    """Every message of ``topic`` with its decoded record (``decoded`` false if it does not decode)."""
    return decode(read_topic_table(spark, path, topic), value="value", codec=codec)
