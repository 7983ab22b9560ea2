from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.functions.forms import decode_path, parse_form, with_form_params


def parse(spark, body, query):
    df = spark.createDataFrame([(body, query)], "body string, query string")
    return df.select(parse_form(F.col("body"), F.col("query")).alias("m")).first()["m"]


def test_first_value_wins_and_body_precedes_query(spark):
    m = parse(spark, "did=b1&did=b2", "did=q1&x=1&x=2")
    assert m["did"] == "b1" and m["x"] == "1"


def test_empty_value_bare_flag_and_empty_pieces(spark):
    m = parse(spark, "a=&&flag&&", None)
    assert m == {"a": "", "flag": ""}


def test_escapes_plus_and_malformed(spark):
    m = parse(spark, None, "q=a%3Db%3Dc%26d+e&bad=%zz&k%65y=v&a%3Db=c%26d&sp=a+b")
    assert m["q"] == "a=b=c&d e"
    assert "bad" not in m
    assert m["key"] == "v"
    assert m["a=b"] == "c&d"
    assert m["sp"] == "a b"


def test_malformed_first_value_lets_later_value_win(spark):
    assert parse(spark, "a=%zz&a=1", None) == {"a": "1"}


def test_event_and_id_params_are_ordinary_keys(spark):
    m = parse(spark, "event=x&id=y", "")
    assert m == {"event": "x", "id": "y"}


def test_null_and_empty_texts_give_empty_map(spark):
    assert parse(spark, None, None) == {}
    assert parse(spark, "", "&&") == {}


def test_value_with_equals(spark):
    assert parse(spark, "a=b=c", None) == {"a": "b=c"}


def test_decode_path_keeps_plus(spark):
    df = spark.createDataFrame([("/a%20b+c",)], "p string")
    assert df.select(decode_path(F.col("p"))).first()[0] == "/a b+c"


_text = st.text(alphabet=st.characters(min_codepoint=32, max_codepoint=0x2FF), max_size=8)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(_text.filter(bool), _text), min_size=1, max_size=6))
def test_encode_parse_roundtrip(spark, pairs):
    from urllib.parse import quote_plus

    body = "&".join(f"{quote_plus(k)}={quote_plus(v)}" for k, v in pairs)
    expected = {}
    for k, v in pairs:
        expected.setdefault(k, v)
    assert parse(spark, body, None) == expected


def test_encoded_duplicate_key_first_wins(spark):
    assert parse(spark, "a=1&%61=2", None) == {"a": "1"}
    assert parse(spark, "%61=2&a=1", None) == {"a": "2"}


def test_first_value_wins_when_keys_are_encoded_and_no_setting_changes(spark):
    before = spark.conf.get("spark.sql.mapKeyDedupPolicy", "EXCEPTION")
    df = spark.createDataFrame([("a=1&%61=2&a=3",), ("%61=2&a=1",), ("a=&a=1&b&b=2",), ("a+b=1&a%20b=2&a=%zz&a=3",)], "q string")
    expected = [{"a": "1"}, {"a": "2"}, {"a": "", "b": ""}, {"a b": "1", "a": "3"}]
    assert [r.p for r in with_form_params(df, "p", F.col("q")).collect()] == expected
    assert [r.p for r in df.select(parse_form(F.col("q")).alias("p")).collect()] == expected
    assert spark.conf.get("spark.sql.mapKeyDedupPolicy", "EXCEPTION") == before
