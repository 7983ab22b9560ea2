"""Longest-prefix match of a request path against registered prefixes.

Matching is by character (``/an`` matches ``/anx``), the longest prefix wins,
no match gives ``No handler matched.``.

Prefixes given as a list are folded into the plan: for each distinct length,
longest first, the path's leading characters are tested against the set of
prefixes of that length (a hash-set ``IN``).

A prefix table given as a DataFrame is searched as nested intervals. In UTF-8
order the strings that begin with a prefix are one interval, from the prefix to
the prefix and a byte above all text; two intervals are nested or apart. So the
borders of all intervals, sorted, cut the order into pieces in which one prefix
is the longest, and a path needs just the last border at or before it. Borders
and paths are dealt out together by range, a search within each range finds the
last border, and a range without one takes it from the ranges before. The plan
is the same for any number of prefixes and lengths; no row is multiplied, and a
path that many rows share is spread over ranges by a number of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.forms import decode_path
from sluice.schema import NO_HANDLER_MSG
from sluice.session import scratch_path


def longest_prefix(path: Column, prefixes: Sequence[str]) -> Column:
    by_len: dict[int, list[str]] = {}
    for p in set(prefixes):
        by_len.setdefault(len(p), []).append(p)
    if not by_len:
        return F.lit(None).cast("string")
    expr = None
    for n in sorted(by_len, reverse=True):
        head = F.substring(path, 1, n) if n > 0 else F.lit("")
        cond = (F.length(path) >= n) & head.isin(*sorted(by_len[n]))
        expr = F.when(cond, head) if expr is None else expr.when(cond, head)
    return expr


def _with_verdict(df: DataFrame, out: str) -> DataFrame:
    return df.withColumn("reason", F.when(F.col(out).isNull(), F.lit(NO_HANDLER_MSG)))


def match_prefix(
    df: DataFrame,
    prefixes: Sequence[str] | DataFrame,
    path: str = "path",
    out: str = "prefix",
) -> DataFrame:
    """Add ``prefix`` (longest match or null) and ``reason`` (null when matched)."""
    if isinstance(prefixes, DataFrame):
        return _with_verdict(_match_by_intervals(df, prefixes, path, out), out)
    return _with_verdict(df.withColumn(out, longest_prefix(F.col(path), prefixes)), out)


def prefix_borders(table: DataFrame, prefix: str = "prefix") -> DataFrame:
    """``border`` (binary) and ``longest``: from this border to the next, the longest prefix is this one (null: none).

    The border behind a prefix belongs to the longest other prefix that it
    begins with: a prefix's beginnings are looked up among the prefixes.
    """
    own = table.select(F.col(prefix).cast("string").alias("p")).where(F.col("p").isNotNull()).distinct()
    shorter = F.explode(F.transform(F.sequence(F.lit(0), F.length("p") - 1), lambda n: F.substring(F.col("p"), F.lit(1), n))).alias("start")
    starts = own.where(F.length("p") > 0).select("p", shorter)
    known = own.withColumnRenamed("p", "q")
    outer = starts.join(known, F.col("start") == F.col("q")).groupBy("p").agg(F.max_by("q", F.length("q")).alias("outer"))
    opens = own.select(F.col("p").cast("binary").alias("border"), F.col("p").alias("longest"))
    closes = own.join(outer, "p", "left").select(F.concat(F.col("p").cast("binary"), F.unhex(F.lit("FF"))).alias("border"), F.col("outer").alias("longest"))
    return opens.unionByName(closes)


def _match_by_intervals(df: DataFrame, table: DataFrame, path: str, out: str) -> DataFrame:
    spark = df.sparkSession
    borders = prefix_borders(table)
    kept = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    # a border comes before the paths that equal it; paths have a number each, so equal ones can part
    rows = df.select(kept.alias("row"), F.col(path).cast("string").cast("binary").alias("at"), F.monotonically_increasing_id().alias("n"))
    rows = rows.withColumns({"is_border": F.lit(False), "longest": F.lit(None).cast("string")})
    marks = borders.select(F.lit(None).cast(rows.schema["row"].dataType).alias("row"), F.col("border").alias("at"), F.lit(-1).cast("long").alias("n"), F.lit(True).alias("is_border"), "longest")
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.unionByName(marks).repartitionByRange(ranges, "at", "n").withColumn("part", F.spark_partition_id())
    written = scratch_path(spark, "prefix-ranges")
    dealt.write.parquet(written)  # fixes which range a row is in
    dealt = spark.read.schema(dealt.schema).parquet(written)
    # the last border of every range, then of all ranges before one: as many rows as ranges
    found = F.struct(F.col("longest"))
    last = dealt.where("is_border").groupBy("part").agg(F.max_by(found, "at").alias("last"))
    every = spark.range(ranges).select(F.col("id").cast("int").alias("part")).join(last, "part", "left")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = every.select("part", F.last("last", ignorenulls=True).over(before).alias("carried"))
    upto = Window.partitionBy("part").orderBy(F.asc_nulls_first("at"), "n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = dealt.withColumn("here", F.last(F.when(F.col("is_border"), found), ignorenulls=True).over(upto))
    hit = F.when(F.col("at").isNotNull(), F.coalesce("here", "carried")["longest"])
    matched = here.where(~F.col("is_border")).join(F.broadcast(carried), "part", "left")
    return matched.select("row.*", hit.alias(out))


def request_paths(df: DataFrame, url: str = "url", out: str = "path") -> DataFrame:
    """Decoded path of a URL (``http://host/a%20b?x`` gives ``/a b``)."""
    raw = F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return df.withColumn(out, decode_path(raw))
