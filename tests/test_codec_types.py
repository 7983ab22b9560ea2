"""Decoding keeps JSON types apart: an extension that is not an object is none."""

from pyspark.sql import functions as F

from sluice.operators.clicks import click_verdicts
from sluice.operators.codec import decode


def test_extensions_by_their_type(spark):
    head = '{"event":"click","id":"i","timestamp":"1"'
    cases = {
        head + ',"extension":{"a":"1","b":null,"c":2,"d":{"e":[1]},"f":""}}': {"a": "1", "b": None, "c": "2", "d": '{"e":[1]}', "f": ""},
        head + ',"extension":{}}': {},
        head + ',"extension":"{\\"a\\":\\"1\\"}"}': None,
        head + ',"extension":" {\\"a\\":1} "}': None,
        head + ',"extension":"text"}': None,
        head + ',"extension":17}': None,
        head + ',"extension":true}': None,
        head + ',"extension":[{"a":"1"}]}': None,
        head + ',"extension":null}': None,
        head + "}": None,
        head + ',"did":"{\\"extension\\":1}","\\u0065xtension":{"a":"1"}}': {"a": "1"},
    }
    df = spark.createDataFrame([(i, bytearray(t.encode())) for i, t in enumerate(cases)], "n int, value binary")
    rows = {r.n: r for r in decode(df).collect()}
    assert all(r.decoded for r in rows.values())
    assert [rows[i].record.extension for i in range(len(cases))] == list(cases.values())
    verdicts = {r.n: r.verdict for r in click_verdicts(decode(df), decoded_ok="decoded").collect()}
    assert [verdicts[i] for i in range(len(cases))] == ["no_adv_id" if v is not None else "no_extension" for v in cases.values()]


def test_what_is_no_record_is_undecodable(spark):
    df = spark.createDataFrame([(bytearray(b),) for b in (b"", b"{", b"\xff\xfe", b"[1]x", b"text")] + [(None,)], "value binary")
    assert decode(df).where(F.col("decoded")).count() == 0
