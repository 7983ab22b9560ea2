import pytest
from pyspark.sql import functions as F

from sluice.operators.clicks import click_url, click_verdict
from sluice.operators.codec import decode, encode
from sluice.schema import DECODED_RECORD

BASE = "http://p.test/clk"


def rec(**over):
    r = {
        "event": "click",
        "id": "auc-1",
        "timestamp": "2024-01-01T00:00:07.5Z",
        "did": "dev-abc",
        "aid": None,
        "ip": "1.2.3.4",
        "os": None,
        "exchange": None,
        "extension": {"adv_id": "adv9", "os_version": "17.1", "device_model": "iPhone12"},
    }
    r.update(over)
    return r


def ext(**over):
    e = {"adv_id": "adv9", "os_version": "17.1", "device_model": "iPhone12"}
    for k, v in over.items():
        if v == "<absent>":
            e.pop(k, None)
        else:
            e[k] = v
    return e


CASES = [
    (rec(event=None), "no_event"),
    (rec(event="view"), "not_click"),
    (rec(extension=None), "no_extension"),
    (rec(extension=ext(adv_id="<absent>")), "no_adv_id"),
    (rec(extension=ext(adv_id="")), "bad_adv_id"),
    (rec(extension=ext(adv_id=None)), "bad_adv_id"),
    (rec(id=None), "no_id"),
    (rec(did=None), "no_did"),
    (rec(ip=None), "no_ip"),
    (rec(timestamp="1704067207"), "bad_timestamp"),
    (rec(timestamp="2024-01-01 00:00:07Z"), "bad_timestamp"),
    (rec(extension=ext(device_model="<absent>")), "no_device_model"),
    (rec(extension=ext(device_model="")), "ok"),
    (rec(extension=ext(os_version="<absent>")), "ok"),
    (rec(), "ok"),
]


@pytest.mark.parametrize("record,verdict", CASES)
def test_verdicts(spark, record, verdict):
    df = spark.createDataFrame([(record,)], f"r {DECODED_RECORD.simpleString()}")
    assert df.select(click_verdict(F.col("r"))).first()[0] == verdict


def test_undecodable(spark):
    df = spark.createDataFrame([(bytearray(b"{not json"),), (None,), (bytearray(b""),)], "value binary")
    out = decode(df).select(click_verdict(F.col("record"), F.col("decoded"))).collect()
    assert [r[0] for r in out] == ["undecodable"] * 3


def _url(spark, r):
    df = spark.createDataFrame([(r,)], f"r {DECODED_RECORD.simpleString()}")
    return df.select(click_url(F.col("r"), BASE, "P1")).first()[0]


def test_url_format_and_fills(spark):
    assert _url(spark, rec()) == f"{BASE}?pid=P1&advid=adv9&ip=1.2.3.4&cts=1704067207500&osv=17.1&idfa=DEV-ABC&keywords=auc-1"
    assert "&osv=unknown&" in _url(spark, rec(extension=ext(os_version="<absent>")))
    assert "&osv=unknown&" in _url(spark, rec(extension=ext(os_version="")))


def test_offset_time(spark):
    assert "&cts=1704067207000&" in _url(spark, rec(timestamp="2024-01-01T08:00:07+08:00"))


def test_codec_roundtrip_with_nulls(spark):
    rows = [(rec(event="", exchange=None, extension={"a": None, "b": "x"}),)]
    df = spark.createDataFrame(rows, f"r {DECODED_RECORD.simpleString()}")
    back = decode(df.select(encode(F.col("r")).alias("value"))).first()
    assert back.decoded and back.record.event == "" and back.record.exchange is None
    assert back.record.extension == {"a": None, "b": "x"}


def test_epoch_ms_truncates_toward_zero(spark):
    from sluice.functions.timefmt import rfc3339_to_epoch_ms

    df = spark.createDataFrame([("1969-12-31T23:59:59.9995Z",), ("1970-01-01T00:00:01.0019Z",), ("x",)], "t string")
    assert [r[0] for r in df.select(rfc3339_to_epoch_ms(F.col("t"))).collect()] == ["0", "1001", None]


def test_extension_that_is_not_an_object(spark):
    rows = [(bytearray(b'{"event":"click","id":"a","timestamp":"2024-01-01T00:00:00Z","extension":"x"}'),), (bytearray(b'{"event":"click","extension":[1,2]}'),)]
    df = decode(spark.createDataFrame(rows, "value binary"))
    out = df.select("decoded", click_verdict(F.col("record"), F.col("decoded"))).collect()
    assert [tuple(r) for r in out] == [(True, "no_extension"), (True, "no_extension")]
