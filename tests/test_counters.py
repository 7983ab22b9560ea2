from sluice.operators.counters import receipts, replay_summary, request_count


def test_receipts_count_written_rows_per_group(spark):
    rows = [("f1", 200)] * 3 + [("f1", 500)] + [("f2", 200)] + [("f3", 500)]
    df = spark.createDataFrame(rows, "file string, status int")
    got = {r.file: (r.n_written, r.receipt) for r in receipts(df, by="file").collect()}
    assert got == {
        "f1": (3, "3 messages have been writen."),
        "f2": (1, "1 messages have been writen."),
        "f3": (0, "0 messages have been writen."),
    }


def test_replay_summary_overall_and_per_attempt(spark):
    df = spark.createDataFrame([(0, "ok"), (0, "undecodable"), (1, "ok"), (1, "ok")], "attempt int, verdict string")
    total = replay_summary(df).first()
    assert (total.success, total.failed) == (3, 1)
    per = {r.attempt: (r.success, r.failed) for r in replay_summary(df, by="attempt").collect()}
    assert per == {0: (1, 1), 1: (2, 0)}


def test_request_count_with_hot_key(spark):
    # one prefix holds most requests; the count is still exact and partial per task
    df = spark.range(10_000).selectExpr("CASE WHEN id % 10 < 7 THEN '/hot' WHEN id % 10 < 9 THEN '/b' END AS prefix").repartition(8)
    r = request_count(df, matched="prefix").first()
    assert (r.n_requests, r.n_matched) == (10_000, 9_000)
