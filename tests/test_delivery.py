"""Click delivery: results for every request, at-least-once and at-most-once."""

import pytest
from pyspark.sql import functions as F

from sluice.plans import derive
from sluice.schema import DELIVERY_RESULT
from sluice.sinks.outbox import deliver_rows, delivery_results, to_outbox, with_request_key
from sluice.streaming.click_job import claim, message_file_stream, start_click_job

SF = "/root/testdata/sf0.001"


def run(spark, tmp_path, deliver, checkpoint="ckpt", **paths):
    if not (tmp_path / "in").exists():
        derive.click_messages(spark.read.parquet(f"{SF}/events.parquet")).repartition(3).write.parquet(f"{tmp_path}/in")
    q = start_click_job(
        message_file_stream(spark, f"{tmp_path}/in", 1), f"{tmp_path}/outbox", f"{tmp_path}/{checkpoint}", "http://c", "p", deliver=deliver, available_now=True, **paths
    )
    try:
        q.awaitTermination()
    except Exception:  # the query's own error is looked at below
        pass
    return q


def test_results_are_joined_to_every_request(spark):
    df = spark.createDataFrame([(i, f"u{i}") for i in range(5)] + [(0, "u0"), (None, "u9")], "s long, url string")
    out = with_request_key(to_outbox(df, "url", "s"))
    key = {r.url: r.request_key for r in out.collect()}
    told = spark.createDataFrame([(key["u0"], 200, None), (key["u1"], 503, None), (key["u1"], 200, None), (key["u2"], None, "timeout"), (key["u9"], 200, None), ("unknown", 200, None)], DELIVERY_RESULT)
    got = [(r.url, r.status, r.error, r.outcome) for r in delivery_results(out.drop("request_key"), told).collect()]
    want = [("u0", 200, None, "delivered")] * 2 + [("u9", 200, None, "delivered"), ("u1", 503, None, "bad_reply"), ("u2", None, "timeout", "no_reply")]
    want += [("u3", None, None, "no_result"), ("u4", None, None, "no_result")]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_requests_are_sent_in_the_tasks_and_errors_are_results(spark, tmp_path):
    def get(request):
        n = int(request["source_id"])
        if n % 5 == 0:
            raise OSError("connection refused")
        return 500 if n % 3 == 0 else 200

    q = run(spark, tmp_path, deliver_rows(get), results_path=f"{tmp_path}/results")
    assert q.exception() is None
    rows = spark.read.parquet(f"{tmp_path}/results").collect()
    assert len(rows) == spark.read.parquet(f"{tmp_path}/outbox").count() > 20
    for r in rows:
        want = ("no_reply", None, "connection refused") if r.source_id % 5 == 0 else ("bad_reply", 500, None) if r.source_id % 3 == 0 else ("delivered", 200, None)
        assert (r.outcome, r.status, r.error) == want


def test_results_of_another_shape_end_the_query(spark, tmp_path):
    q = run(spark, tmp_path, lambda frame, batch_id: frame.select("url"), results_path=f"{tmp_path}/results")
    assert "expected struct<request_key" in str(q.exception())


@pytest.mark.parametrize("once", [True, False])
def test_a_failure_between_claim_and_send(spark, tmp_path, once):
    """The second batch fails when it is about to be sent. At most once it is lost, else it is sent by the restart."""
    paths = {"claims_path": f"{tmp_path}/claims"} if once else {}
    sent, broken = [], [1]

    def deliver(frame, batch_id):
        if batch_id in broken:
            broken.clear()
            raise RuntimeError("lost")
        sent.extend((batch_id, r.source_id) for r in frame.collect())

    assert run(spark, tmp_path, deliver, **paths).exception() is not None
    assert run(spark, tmp_path, deliver, **paths).exception() is None
    outbox = {(r.batch_id, r.source_id) for r in spark.read.parquet(f"{tmp_path}/outbox").collect()}
    assert {b for b, _ in outbox} == {0, 1, 2}
    assert len(sent) == len(set(sent)) and set(sent) == {x for x in outbox if x[0] != 1 or not once}


def test_a_batch_is_claimed_once(spark, tmp_path):
    assert claim(spark, f"{tmp_path}/c", 3) and not claim(spark, f"{tmp_path}/c", 3) and claim(spark, f"{tmp_path}/c", 4)


def test_requests_without_results_are_kept(spark):
    df = spark.createDataFrame([(1, "u")], "s long, url string")
    got = delivery_results(to_outbox(df, F.col("url"), F.col("s")), None).collect()
    assert [(r.source_id, r.status, r.outcome) for r in got] == [(1, None, "no_result")]
