"""K6: drain topic payloads into Avro container files.

Three forms existed: re-blocked raw datums, re-encoded records, and the raw
payloads concatenated. With Spark these are one DataFrame written by the
``avro`` data source (``spark-avro`` package), uncompressed or deflate; the
raw form keeps the payload bytes in a Parquet column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.codec import avro_schema_json, decode, require_avro

CODECS = {"null": "uncompressed", "deflate": "deflate"}


def export_avro(messages: DataFrame, path: str, codec: str = "null", payload_codec: str = "json") -> None:
    """Decoded records to Avro container files (requires ``spark-avro``)."""
    if codec not in CODECS:
        raise ValueError(f'"{codec}" codec is not supported.')
    require_avro()
    recs = decode(messages, value="value", codec=payload_codec).filter(F.col("decoded")).select("record.*")
    recs.write.format("avro").option("compression", CODECS[codec]).option("avroSchema", avro_schema_json()).mode("append").save(path)


def export_raw(messages: DataFrame, path: str) -> None:
    """The payload bytes as they came, one row each (topic, partition, offset, value)."""
    cols = [c for c in ("topic", "partition", "offset", "value") if c in messages.columns]
    messages.select(*cols).write.mode("append").parquet(path)
