"""Physical-plan guards for the scale properties the design relies on."""

import pytest

from sluice.plans import queries as Q

SF = "/root/testdata/sf0.001"

ROW_LOCAL = [
    "form_event_record",
    "event_validation",
    "event_routing",
    "client_address",
    "postback_verdicts",
    "postback_records",
    "click_verdicts",
    "click_urls",
    "codec_roundtrip",
    "topic_messages",
    "message_partitions",
    "dead_letter_roundtrip",
    "prefix_match",
]


def plan(spark, name):
    return Q.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ROW_LOCAL)
def test_row_local_queries_do_not_shuffle_by_key_or_join(spark, name):
    p = plan(spark, name)
    for bad in ("hashpartitioning", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct"):
        assert bad not in p, (name, bad)


def test_counter_aggregates_partially_before_its_only_shuffle(spark):
    p = plan(spark, "events_per_topic")
    assert p.count("hashpartitioning") == 1
    assert "partial_count" in p


def test_topic_dump_prunes_partitions_and_columns(spark):
    p = plan(spark, "topic_dump")
    assert "PartitionFilters: [isnotnull(topic" in p and "= clicks)" in p
    assert "ReadSchema: struct<value:binary>" in p


@pytest.mark.parametrize(
    "name,schema",
    [
        ("event_validation", "struct<request_id:bigint,query:string,body:string>"),
        ("click_verdicts", "struct<offset:bigint,value:binary>"),
        ("client_address", "struct<request_id:bigint,x_forwarded_for:string,remote_addr:string>"),
        ("prefix_match", "struct<page_id:bigint,url:string>"),
    ],
)
def test_scans_read_only_needed_columns(spark, name, schema):
    assert f"ReadSchema: {schema}" in plan(spark, name)
