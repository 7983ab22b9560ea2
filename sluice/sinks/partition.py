"""K3: partition choice for topic messages.

``manual`` pins every message to one partition (``-1`` is rejected);
``hash`` and ``random`` leave the partition to the producer: with a message
key it hashes the key, without one it spreads messages. Any other mode is an
error raised while building the plan, before any data is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The supported partitioner names.
PARTITIONERS = ("hash", "random", "manual")


def assign_partition(
    df: DataFrame, mode: str, partition: int = -1, out: str = "partition", n: int | None = None, key: str = "key"
) -> DataFrame:
    """Add the partition. With ``n`` partitions ``hash`` takes ``pmod(xxhash64(key), n)`` and ``random`` spreads rows; else the producer chooses."""
    if mode not in PARTITIONERS:
        raise ValueError(f"Partitioner {mode} not supported.")
    if mode == "manual":
        if partition == -1:
            raise ValueError("Partition is required when partitioning manually.")
        return df.withColumn(out, F.lit(int(partition)).cast("int"))
    if n is None:
        return df.withColumn(out, F.lit(None).cast("int"))
    chosen = F.xxhash64(key) if mode == "hash" else F.monotonically_increasing_id()
    return df.withColumn(out, F.pmod(chosen, F.lit(n)).cast("int"))
