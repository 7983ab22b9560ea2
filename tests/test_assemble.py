from pyspark.sql import functions as F

from sluice.operators.assemble import client_addr, event_record, postback_record
from sluice.schema import POSTBACK_EVENT


def _one(spark, params, fn):
    df = spark.createDataFrame([(params,)], "params map<string,string>")
    return df.select(fn(F.col("params")).alias("r")).first()["r"]


def test_event_record_fields_and_extension(spark):
    r = _one(spark, {"did": "d", "timestamp": "t", "event_type": "order", "ip": "1.2.3.4", "event": "x", "id": "y", "z": ""}, event_record)
    assert (r.event, r.id, r.did, r.timestamp, r.ip, r.aid) == ("TrackerEvent", "", "d", "t", "1.2.3.4", None)
    assert r.extension == {"event_type": "order", "event": "x", "id": "y", "z": ""}


def test_event_record_extension_null_when_empty(spark):
    r = _one(spark, {"did": "d", "timestamp": "t", "aid": "a", "ip": "i"}, event_record)
    assert r.extension is None and r.aid == "a"


def test_postback_record(spark):
    p = {"appid": "a", "adname": "n", "adid": "1", "device": "D", "idfa": "I", "point": "5", "ts": "-5", "sign": "s", "keyword": "kw", "aid": "x", "timestamp": "y", "ip": "9.9.9.9"}
    r = _one(spark, p, postback_record)
    assert (r.event, r.id, r.did, r.os, r.ip) == (POSTBACK_EVENT, "kw", "I", "ios", "9.9.9.9")
    assert r.timestamp == "1969-12-31T23:59:59Z"
    assert r.extension == {"appid": "a", "adname": "n", "adid": "1", "device": "D", "point": "5"}


def test_postback_time_whole_seconds_utc(spark):
    p = {"ts": "1704067207999", "keyword": "k", "idfa": "i"}
    assert _one(spark, p, postback_record).timestamp == "2024-01-01T00:00:07Z"


def test_client_addr(spark):
    df = spark.createDataFrame([("", "r:1"), (None, "r:2"), ("x", "r:3")], "xff string, remote string")
    got = [r[0] for r in df.select(client_addr(F.col("xff"), F.col("remote"))).collect()]
    assert got == ["r:1", "r:2", "x"]


def test_event_time(spark):
    import datetime as dt

    from sluice.functions.timefmt import event_time

    df = spark.createDataFrame([("2024-01-01T08:00:07.5+08:00",), ("1704067207",), ("soon",), (None,)], "t string")
    got = [r[0] for r in df.select(event_time(F.col("t"))).collect()]
    assert got[0] == dt.datetime(2024, 1, 1, 0, 0, 7, 500000) and got[1] == dt.datetime(2024, 1, 1, 0, 0, 7)
    assert got[2] is None and got[3] is None
