import pytest
from pyspark.sql import functions as F

from sluice.functions.sign import postback_sign
from sluice.operators.validate import validate_event, validate_postback
from sluice.schema import POSTBACK_REQUIRED_FIELDS

KEY = "k"


def _params(spark, rows):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "id int, params map<string,string>")
    return df


def test_event_required_fields_in_order(spark):
    rows = [
        {"timestamp": "1", "event_type": "x"},
        {"did": "d", "event_type": "x"},
        {"did": "d", "timestamp": "1"},
        {},
        {"did": "", "timestamp": "", "event_type": ""},
    ]
    out = validate_event(_params(spark, rows)).orderBy("id").collect()
    assert [r.reason for r in out] == [
        "Missing Required field: No did",
        "Missing Required field: No timestamp",
        "Missing Required field: No event_type",
        "Missing Required field: No did",
        None,
    ]
    assert [r.status for r in out] == [400, 400, 400, 400, 200]


def test_null_params_map_is_missing_did(spark):
    df = spark.createDataFrame([(1, None)], "id int, params map<string,string>")
    assert validate_event(df).first().reason == "Missing Required field: No did"


def _signed(spark, params, key=KEY):
    df = _params(spark, [params])
    return df.select(postback_sign(F.col("params"), key)).first()[0]


def _postback(**over):
    p = {"appid": "a", "adname": "n", "adid": "1", "device": "iPhone", "idfa": "I", "point": "5", "ts": "1700000000000", "keyword": "kw"}
    p.update(over)
    return p


def test_signature_text_and_md5(spark):
    import hashlib

    p = _postback()
    text = "adid=1adname=nappid=adevice=iPhoneidfa=Ipoint=5ts=1700000000000key=k"
    assert _signed(spark, p) == hashlib.md5(text.encode()).hexdigest()


@pytest.mark.parametrize("missing", POSTBACK_REQUIRED_FIELDS)
def test_each_missing_postback_field(spark, missing):
    p = _postback()
    p["sign"] = _signed(spark, p)
    p.pop(missing)
    out = validate_postback(_params(spark, [p]), KEY).first()
    assert (out.status, out.reason) == (400, f"Missing Required field: No {missing}")


def test_sign_variants(spark):
    p = _postback()
    good = _signed(spark, p)
    rows = [dict(p, sign=good), dict(p, sign=good + ",extra"), dict(p, sign=good.upper()), dict(p, sign="0" * 32)]
    out = validate_postback(_params(spark, rows), KEY).orderBy("id").collect()
    assert [r.status for r in out] == [200, 200, 400, 400]
    assert out[2].reason == "Sign mismatched!"
    bypass = validate_postback(_params(spark, rows), KEY, bypass_sign=True).orderBy("id").collect()
    assert [r.status for r in bypass] == [200, 200, 200, 200]


@pytest.mark.parametrize(
    "ts,reason",
    [
        (" 12 ", 'Failed to parse ts:strconv.ParseInt: parsing " 12 ": invalid syntax'),
        ("1e3", 'Failed to parse ts:strconv.ParseInt: parsing "1e3": invalid syntax'),
        ("", 'Failed to parse ts:strconv.ParseInt: parsing "": invalid syntax'),
        ("99999999999999999999", 'Failed to parse ts:strconv.ParseInt: parsing "99999999999999999999": value out of range'),
        ("253402300800000", "Failed to parse ts:timestamp out of range"),
        ("-5", None),
        ("+7", None),
    ],
)
def test_postback_ts(spark, ts, reason):
    p = _postback(ts=ts)
    p["sign"] = _signed(spark, p)
    out = validate_postback(_params(spark, [p]), KEY).first()
    assert out.reason == reason
    assert out.status == (200 if reason is None else 500)
