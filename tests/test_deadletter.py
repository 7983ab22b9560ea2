from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.functions.bytelist import bytes_to_list_text
from sluice.sinks.deadletter import backup_lines, next_generation, to_dead_letters
from sluice.sources.backup_log import parse_backup_lines


def test_all_byte_values_roundtrip(spark):
    data = bytes(range(256))
    df = spark.createDataFrame([(bytearray(data),), (bytearray(b""),)], "d binary")
    lines = df.select(F.concat(F.lit("2024/01/01 00:00:00 data: "), bytes_to_list_text(F.col("d"))).alias("value"))
    out = parse_backup_lines(lines, path=None).collect()
    assert [bytes(r.data) for r in out] == [data, b""]


@settings(max_examples=20, deadline=None)
@given(st.binary(max_size=64))
def test_bytes_roundtrip_property(spark, data):
    df = spark.createDataFrame([(bytearray(data),)], "d binary")
    lines = df.select(F.concat(F.lit("data: "), bytes_to_list_text(F.col("d"))).alias("value"))
    assert bytes(parse_backup_lines(lines, path=None).first().data) == data


def test_line_filter(spark):
    rows = [
        ("2024/01/01 00:00:00 data: [1 2 3]", "/x/backup.log"),
        ("data: [4]", "/x/backup.log.3"),
        ("2024/01/01 00:00:00 record: user said data: [9]", "/x/backup.log"),
        ("2024/01/01 00:00:00 error: boom", "/x/backup.log"),
        ("data: [1 300]", "/x/backup.log.98"),
        ("data: data: [1]", "/x/backup.log"),
    ]
    df = spark.createDataFrame(rows, "value string, file_path string")
    out = parse_backup_lines(df).collect()
    assert [(r.attempt, r.bytes_ok) for r in out] == [(0, True), (4, True), (99, False)]
    assert bytes(out[0].data) == b"\x01\x02\x03" and out[2].data is None


def test_dead_letter_text_roundtrip(spark):
    df = spark.createDataFrame([(bytearray(b"\x00\xff\x10"),)], "d binary")
    dead = to_dead_letters(df, F.lit("boom"), F.struct(F.lit("x").alias("a")), F.col("d"), F.lit("t"))
    lines = backup_lines(dead)
    assert lines.count() == 3
    back = parse_backup_lines(lines, path=None).collect()
    assert len(back) == 1 and bytes(back[0].data) == b"\x00\xff\x10"


def test_retry_generations(spark):
    df = spark.createDataFrame([(0, "undecodable"), (98, "undecodable"), (99, "undecodable"), (100, "undecodable"), (5, "ok")], "attempt int, verdict string")
    out = [(r.next_attempt, r.retry) for r in next_generation(df).collect()]
    assert out == [(1, "retry"), (99, "retry"), (100, "retry"), (None, "exhausted"), (None, "ok")]


def test_read_backup_files_by_name(spark, tmp_path):
    from sluice.sources.backup_log import read_backup_log

    (tmp_path / "backup.log").write_text(
        "2024/01/01 00:00:00 error: boom\n2024/01/01 00:00:00 record: x data: [1]\n2024/01/01 00:00:00 data: [104 105]\n"
    )
    (tmp_path / "backup.log.2").write_text("data: [33]\ndata: [1 256]\n")
    got = sorted((r.attempt, r.bytes_ok, bytes(r.data) if r.data is not None else None) for r in read_backup_log(spark, str(tmp_path)).collect())
    assert got == [(0, True, b"hi"), (3, False, None), (3, True, b"!")]
