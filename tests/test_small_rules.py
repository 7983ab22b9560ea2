"""Edges of single rules: number texts, generations, topic names, partitions, the current time."""

import time

from pyspark.sql import functions as F

from sluice.functions.timefmt import event_time, now_epoch_seconds
from sluice.operators.validate import postback_ts_ms
from sluice.sinks.partition import assign_partition
from sluice.sinks.topic_table import write_topic_table
from sluice.sources.backup_log import parse_backup_lines
from sluice.sources.topic_table import read_topic_table


def test_a_final_newline_is_no_part_of_a_number(spark):
    df = spark.createDataFrame([("123",), ("123\n",), (" 123",)], "t string")
    got = df.select(postback_ts_ms(F.col("t")).alias("ms"), event_time(F.col("t")).alias("at")).collect()
    assert [r.ms for r in got] == [123, None, None]
    assert [r.at is not None for r in got] == [True, False, False]


def test_event_time_holds_the_years_that_text_can_hold(spark):
    df = spark.createDataFrame([("253402300799",), ("253402300800",), ("9" * 30,)], "t string")
    assert [r.n for r in df.select(F.unix_seconds(event_time(F.col("t"))).alias("n")).collect()] == [253402300799, None, None]


def test_an_impossible_generation_does_not_end_the_job(spark):
    df = spark.createDataFrame([("data: [1 2]", "/x/backup.log.99999999999"), ("data: [1 2]", "/x/backup.log.4")], "value string, file_path string")
    assert [r.attempt for r in parse_backup_lines(df).collect()] == [None, 5]


def test_numeric_topic_names_stay_text(spark, tmp_path):
    path = str(tmp_path / "topics")
    messages = spark.createDataFrame([("007", None, None, b"x"), ("12", None, None, b"y")], "topic string, partition int, key binary, value binary")
    write_topic_table(messages, path)
    assert sorted(r.topic for r in read_topic_table(spark, path).collect()) == ["007", "12"]
    assert [bytes(r.value) for r in read_topic_table(spark, path, "007").collect()] == [b"x"]


def test_keyed_hash_gives_one_partition_a_key(spark):
    df = spark.createDataFrame([(bytes([k % 5]), k) for k in range(100)], "key binary, n int")
    rows = assign_partition(df, "hash", n=4).collect()
    assert all(0 <= r.partition < 4 for r in rows)
    assert len({(bytes(r.key), r.partition) for r in rows}) == 5
    assert {r.partition for r in assign_partition(df, "random", n=4).collect()} <= set(range(4))


def test_current_time_in_epoch_seconds(spark):
    assert abs(spark.range(1).select(now_epoch_seconds().alias("n")).first().n - time.time()) < 60
