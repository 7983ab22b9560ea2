import pytest
from pyspark.sql import functions as F

from sluice.sinks.kafka import kafka_write_options, to_messages, to_string_messages
from sluice.sinks.partition import assign_partition
from sluice.sources.kafka import kafka_read_options


def test_partition_modes(spark):
    df = spark.range(3)
    assert {r.partition for r in assign_partition(df, "manual", 2).collect()} == {2}
    assert {r.partition for r in assign_partition(df, "hash").collect()} == {None}
    with pytest.raises(ValueError, match="required"):
        assign_partition(df, "manual", -1)
    with pytest.raises(ValueError, match="not supported"):
        assign_partition(df, "roundrobin")


def test_kafka_options():
    r = kafka_read_options(["b1:9092", "b2:9092"], "click_a, click_b", read_from_oldest=True)
    assert r["subscribe"] == "click_a,click_b" and r["startingOffsets"] == "earliest"
    assert kafka_read_options(["b"], ["t"])["startingOffsets"] == "latest"
    w = kafka_write_options(["b"])
    assert w["kafka.acks"] == "all"
    with pytest.raises(ValueError):
        kafka_read_options(["b"], " , ")


def test_message_shapes(spark):
    df = spark.createDataFrame([("t1", "x")], "topic string, v string")
    m = to_messages(df, F.encode(F.col("v"), "UTF-8"))
    assert m.columns == ["topic", "partition", "key", "value"]
    assert dict(m.dtypes)["value"] == "binary"
    s = to_string_messages(df, F.col("v"))
    assert dict(s.dtypes)["value"] == "string"


def test_avro_codec_fails_clearly_without_package(spark):
    from sluice.operators.codec import avro_schema_json, encode

    import json

    assert [f["name"] for f in json.loads(avro_schema_json())["fields"]][:3] == ["event", "id", "timestamp"]
    try:
        spark.sparkContext._jvm.java.lang.Class.forName("org.apache.spark.sql.avro.AvroDataToCatalyst")
        pytest.skip("spark-avro is installed")
    except Exception:
        pass
    with pytest.raises(RuntimeError, match="spark-avro"):
        encode(F.struct(F.lit("x").alias("event")), codec="avro")


def test_export_raw_roundtrip(spark, tmp_path):
    from sluice.sinks.avro_export import export_raw

    df = spark.createDataFrame([("t", 0, 5, bytearray(b"\x01\x02"))], "topic string, partition int, offset long, value binary")
    export_raw(df, str(tmp_path / "raw"))
    back = spark.read.parquet(str(tmp_path / "raw")).first()
    assert bytes(back.value) == b"\x01\x02" and back.offset == 5


def test_kafka_paths_fail_clearly_without_connector(spark):
    from sluice.sinks.kafka import write_topics
    from sluice.sources.kafka import read_topic_batch, read_topics

    try:
        spark.sparkContext._jvm.java.lang.Class.forName("org.apache.spark.sql.kafka010.KafkaSourceProvider")
        pytest.skip("spark-sql-kafka is installed")
    except Exception:
        pass
    with pytest.raises(RuntimeError, match="spark-sql-kafka"):
        read_topics(spark, ["b:9092"], "t")
    with pytest.raises(RuntimeError, match="spark-sql-kafka"):
        read_topic_batch(spark, ["b:9092"], "t")
    df = spark.createDataFrame([("t", "x")], "topic string, v string")
    with pytest.raises(RuntimeError, match="spark-sql-kafka"):
        write_topics(to_messages(df, F.encode(F.col("v"), "UTF-8")), ["b:9092"])
