"""Topic messages landed as a Parquet table partitioned by topic.

Where no broker is at hand (or for repeated offline reads), messages are
appended to ``path/topic=<name>/``: readers of one topic prune to its folder,
and per-batch writes are idempotent when keyed by ``batch_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_topic_table(messages: DataFrame, path: str, batch_id: int | str | None = None) -> None:
    df = messages.drop("message_id", "origin")  # names of this run, not part of a message
    parts = ["topic"]
    if batch_id is not None:
        df = df.withColumn("batch_id", F.lit(batch_id))
        parts = ["batch_id", "topic"]
    (
        df.write.mode("overwrite" if batch_id is not None else "append")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .parquet(path)
    )
