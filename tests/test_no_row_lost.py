"""Every input row comes out with exactly one verdict: partitions of the verdict sum to the input."""

from pyspark.sql import functions as F

from sluice.plans import queries as Q

SF = "/root/testdata/sf0.001"


def test_verdict_partitions_cover_input(spark):
    n = spark.read.parquet(f"{SF}/events.parquet").count()
    for name, col in (("event_validation", "status"), ("postback_verdicts", "status"), ("click_verdicts", "verdict")):
        df = Q.QUERIES[name](spark, SF)
        counts = df.groupBy(col).count().collect()
        assert sum(r["count"] for r in counts) == n, name
        assert df.filter(F.col(col).isNull()).count() == 0, name


def test_replay_and_csv_cover_input(spark):
    n = spark.read.parquet(f"{SF}/events.parquet").count()
    summary = Q.QUERIES["replay_summary"](spark, SF).collect()
    assert sum(r.success + r.failed for r in summary) == n
    from sluice.plans.derive import UPLOAD_ROWS

    events = spark.read.parquet(f"{SF}/events.parquet")
    # uploads of variant 3 lack a required column and are rejected whole
    in_accepted = events.filter(F.pmod(F.floor(F.col("event_id") / UPLOAD_ROWS), F.lit(4)) != 3).count()
    rows = Q.QUERIES["csv_event_record"](spark, SF).count()
    bad = sum(r.n_rows for r in Q.QUERIES["csv_quarantine"](spark, SF).collect())
    assert rows + bad == in_accepted
