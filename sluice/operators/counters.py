"""A1-A3: the pipeline's counters. Each is a two-stage aggregation (partial
counts per task, then a merge), so a hot group never lands whole in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.schema import RECEIPT_FMT


def receipts(df: DataFrame, by: str = "request_id", ok: str = "status", out: str = "receipt") -> DataFrame:
    """A1: records written per request or per file, with the reply text."""
    n = F.count_if(F.col(ok) == 200) if ok else F.count(F.lit(1))
    return df.groupBy(by).agg(n.alias("n_written")).withColumn(out, F.format_string(RECEIPT_FMT, F.col("n_written")))


def replay_summary(df: DataFrame, verdict: str = "verdict", by: str | None = None) -> DataFrame:
    """A2: success and failed counts of a replay (optionally per ``by``, e.g. per attempt)."""
    counts = [
        F.count_if(F.col(verdict) == "ok").alias("success"),
        F.count_if(F.col(verdict) != "ok").alias("failed"),
    ]
    return df.groupBy(by).agg(*counts) if by else df.agg(*counts)


def request_count(df: DataFrame, matched: str | None = None) -> DataFrame:
    """A3: requests seen (counted once each) and, optionally, how many matched a handler."""
    aggs = [F.count(F.lit(1)).alias("n_requests")]
    if matched:
        aggs.append(F.count(F.col(matched)).alias("n_matched"))
    return df.agg(*aggs)
