
from sluice.operators.prefix import match_prefix
from sluice.operators.routing import route

ROUTES = {"default": "fallback", "activation": "activation", "order": "order", "registration": "registration"}


def test_route_known_unknown_default_empty(spark):
    df = spark.createDataFrame([("order",), ("click",), ("default",), ("",), (None,)], "event_type string")
    got = [r.topic for r in route(df, ROUTES).collect()]
    assert got == ["order", "fallback", "fallback", "fallback", "fallback"]


def test_route_table_with_repeats_nulls_and_many_rows(spark):
    rows = [*ROUTES.items(), ("order", "zzz"), (None, "lost"), *[(f"t{n}", f"topic{n}") for n in range(10_500)]]
    table = spark.createDataFrame(rows, "event_type string, topic string")
    df = spark.createDataFrame([("order", 1), ("x", 2), ("registration", 3), (None, 4), ("default", 5), ("t10400", 6)], "event_type string, n int")
    got = sorted((r.n, r.topic) for r in route(df, table).collect())
    assert got == [(1, "order"), (2, "fallback"), (3, "registration"), (4, "fallback"), (5, "fallback"), (6, "topic10400")]
    few = spark.createDataFrame(rows[:6], "event_type string, topic string")
    assert sorted((r.n, r.topic) for r in route(df, few).collect())[:5] == got[:5]


def test_route_requires_default(spark):
    import pytest

    df = spark.createDataFrame([("a",)], "event_type string")
    with pytest.raises(ValueError):
        route(df, {"a": "b"})


PATHS = [(1, "/ank"), (2, "/anx/y"), (3, "/zzz"), (4, "/"), (5, "/an")]


def test_longest_prefix_by_character(spark):
    df = spark.createDataFrame(PATHS, "id int, path string")
    out = {r.id: (r.prefix, r.reason) for r in match_prefix(df, ["/", "/an", "/ank"]).collect()}
    assert out[1] == ("/ank", None)
    assert out[2] == ("/an", None)
    assert out[3] == ("/", None)
    assert out[5] == ("/an", None)
    out2 = {r.id: (r.prefix, r.reason) for r in match_prefix(df, ["/ank", "/b"]).collect()}
    assert out2[3] == (None, "No handler matched.")


def test_prefix_table_equals_prefix_list_at_any_size(spark):
    df = spark.createDataFrame([*PATHS, (None, "/ank"), (9, None), (3, "/zzz")], "id int, path string")
    prefixes = ["/", "/an", "/ank", "/q"]
    few = spark.createDataFrame([(p,) for p in [*prefixes, "/", None]], "prefix string")
    many = few.union(spark.createDataFrame([(f"/none{n}",) for n in range(10_500)], "prefix string"))
    expected = sorted((r.id or 0, r.prefix or "") for r in match_prefix(df, prefixes).collect())
    for table in (few, many):
        assert sorted((r.id or 0, r.prefix or "") for r in match_prefix(df, table).collect()) == expected
    assert all(r.prefix is None for r in match_prefix(df, few.limit(0)).collect())


def test_many_prefixes_and_routes_match_brute_force(spark):
    import random

    rng = random.Random(7)
    alphabet = "/abc"
    prefixes = sorted({"".join(rng.choice(alphabet) for _ in range(rng.randint(1, 6))) for _ in range(300)})
    paths = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 9))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(paths)), "id int, path string")
    got = {r.id: r.prefix for r in match_prefix(df, prefixes).collect()}
    for i, p in enumerate(paths):
        hits = [q for q in prefixes if p.startswith(q)]
        assert got[i] == (max(hits, key=len) if hits else None)

    routes = {"default": "d", **{f"t{n}": f"topic{n % 7}" for n in range(50)}}
    types = [f"t{n}" for n in range(60)] + [None, "default", ""]
    tdf = spark.createDataFrame([(t,) for t in types], "event_type string")
    got_topics = [r.topic for r in route(tdf, routes).collect()]
    assert got_topics == [routes.get(t, "d") if t is not None else "d" for t in types]
