"""Prefix tables as nested intervals: against brute force, whatever the ranges."""

import random

import pytest

from sluice.operators.prefix import match_prefix, prefix_borders


def brute(path, prefixes):
    hits = [p for p in prefixes if p is not None and path is not None and path.startswith(p)]
    return max(hits, key=len) if hits else None


@pytest.mark.parametrize("ranges", ["1", "3", "16"])
def test_random_tables_match_brute_force(spark, ranges):
    rng = random.Random(int(ranges))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        for alphabet in ("/abc", "ab", "é￿\U0001f600a/"):
            prefixes = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 9))) for _ in range(250)] + [None, "/", "/"]
            paths = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12))) for _ in range(500)] + [None, None, "", "/"]
            paths += ["a" + alphabet[0] * 4] * 700  # one path that a third of all rows share
            df = spark.createDataFrame(list(enumerate(paths)), "id int, path string")
            table = spark.createDataFrame([(p,) for p in prefixes], "prefix string")
            got = {r.id: r.prefix for r in match_prefix(df, table).collect()}
            assert got == {i: brute(p, prefixes) for i, p in enumerate(paths)}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_empty_prefix_takes_every_path(spark):
    df = spark.createDataFrame([(1, ""), (2, "/x"), (3, None)], "id int, path string")
    table = spark.createDataFrame([("",), ("/x/y",)], "prefix string")
    assert {r.id: r.prefix for r in match_prefix(df, table).collect()} == {1: "", 2: "", 3: None}


def test_rows_keep_their_columns_and_repeats(spark):
    df = spark.createDataFrame([("/ab", "/x", 1, 2.0), ("/ab", "/x", 1, 2.0), ("/q", None, None, None)], "path string, longest string, at int, `a.b` double")
    table = spark.createDataFrame([("/a",)], "prefix string")
    got = match_prefix(df, table)
    assert got.columns == ["path", "longest", "at", "a.b", "prefix", "reason"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [("/ab", "/x", 1, 2.0, "/a", None)] * 2 + [("/q", None, None, None, None, "No handler matched.")]))


def test_borders_nest(spark):
    table = spark.createDataFrame([("/a",), ("/a/b",), ("/",), ("/c",), ("/a",), (None,)], "prefix string")
    got = sorted((bytes(r.border), r.longest) for r in prefix_borders(table).collect())
    assert got == [(b"/", "/"), (b"/a", "/a"), (b"/a/b", "/a/b"), (b"/a/b\xff", "/a"), (b"/a\xff", "/"), (b"/c", "/c"), (b"/c\xff", "/"), (b"/\xff", None)]


def test_plan_does_not_grow_with_the_lengths(spark):
    df = spark.createDataFrame([("/ab",)], "path string")

    def plan(n):
        table = spark.createDataFrame([("/" * k,) for k in range(1, n)], "prefix string")
        return match_prefix(df, table)._jdf.queryExecution().optimizedPlan().toString().count("Join")

    assert plan(3) == plan(60)
