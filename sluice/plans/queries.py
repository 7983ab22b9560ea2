"""The driver's query registry: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver tables (or data Spark derives from them) in
full. Output columns are flat (no MAP columns) and aliased to the names the
oracle SQL in ``sluice.plans.oracle`` uses.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.forms import with_form_params
from sluice.functions.maps import sorted_keys
from sluice.operators.assemble import client_addr
from sluice.operators.prefix import request_paths
from sluice.plans import derive, settings
from sluice.operators.codec import decode, encode
from sluice.operators.counters import replay_summary, request_count
from sluice.operators.prefix import match_prefix
from sluice.operators.routing import route, topic_for
from sluice.plans.ingest import form_messages_and_dead_letters, ingest_forms, ingest_uploads, topic_counts, unsent_letters
from sluice.plans.partner import click_outbox, judge_clicks, judge_postbacks, postback_outbox
from sluice.plans.replay import replay, replay_ledger, replay_to_tables
from sluice.schema import DEFAULT_ROUTE, RECEIPT_FMT
from sluice.session import ensure_utc, landed_path, scratch_path
from sluice.sinks.deadletter import packed
from sluice.sinks.kafka import to_messages, to_string_messages
from sluice.sinks.ledger import DeadLetterLedger
from sluice.sinks.partition import assign_partition
from sluice.sinks.send import settle
from sluice.sinks.topic_table import write_topic_table
from sluice.sources.backup_log import read_backup_log
from sluice.sources.csv_upload import file_sizes, list_uploads, read_event_csv, upload_replies
from sluice.sources.topic_table import dump_topic, read_topic_table
from sluice.streaming.click_job import message_file_stream, start_click_job
from sluice.streaming.ingest_job import request_file_stream, start_ingest_job
from sluice.streaming.upload_job import start_upload_job, start_upload_request_job, upload_file_stream, upload_request_stream
from sluice.sources.forms import url_query

Query = Callable[[SparkSession, str], DataFrame]
# Bytes of a micro-batch's files, whatever the size of the table.
BATCH_BYTES = 64 * 1024 * 1024
# Events that one task renders: Spark cuts a table by its bytes, and a few of them make many lines.
ROWS_A_TASK = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return table(spark, sf_dir, "events")


def _spread(events: DataFrame) -> DataFrame:
    """The events over as many tasks as there are rows for: a task's sort and time don't grow with the table."""
    return events.repartition(max(1, -(-events.count() // ROWS_A_TASK)))


def _ext(name: str) -> F.Column:
    return F.try_element_at(F.col("record.extension"), F.lit(name))


# Rows of a landed file: readers get splits of a fixed size, whatever tasks wrote them.
LANDED_ROWS = 12_500


def _land(spark: SparkSession, sf_dir: str, kind: str, make) -> str:
    """The folder of a derived input (request log, messages), landed once as Parquet."""
    ev = _events(spark, sf_dir)
    return landed_path(spark, kind, ev, lambda p: make(_spread(ev)).write.mode("overwrite").option("maxRecordsPerFile", LANDED_ROWS).parquet(p))


def _landed(spark: SparkSession, sf_dir: str, kind: str, make) -> DataFrame:
    return spark.read.parquet(_land(spark, sf_dir, kind, make))


def _request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spark, sf_dir, "form-requests", derive.request_log)


def _forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_forms(_request_log(spark, sf_dir), settings.ROUTES)


# --- form ingest -----------------------------------------------------------


def events_per_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: how many valid form events went to each topic."""
    return topic_counts(_forms(spark, sf_dir))


def form_event_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _forms(spark, sf_dir).filter(F.col("status") == 200)
    return df.select(
        "request_id",
        F.col("record.event").alias("event"),
        F.col("record.id").alias("id"),
        F.col("record.timestamp").alias("timestamp"),
        F.col("record.did").alias("did"),
        F.col("record.aid").alias("aid"),
        F.col("record.ip").alias("ip"),
        sorted_keys(F.col("record.extension")).alias("ext_keys"),
        _ext("event_type").alias("ext_event_type"),
        _ext("value").alias("ext_value"),
        _ext("k").alias("ext_k"),
        _ext("note").alias("ext_note"),
        _ext("q").alias("ext_q"),
        _ext("flag").alias("ext_flag"),
        _ext("event").alias("ext_event"),
        _ext("bad").alias("ext_bad"),
    )


def event_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _forms(spark, sf_dir).select("request_id", "status", "reason")


def event_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _forms(spark, sf_dir)
    return df.select("request_id", F.try_element_at("params", F.lit("event_type")).alias("event_type"), "topic")


def form_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 for form events: the reply text per request (one record per valid request)."""
    df = _forms(spark, sf_dir)
    reply = F.when(F.col("status") == 200, F.format_string(RECEIPT_FMT, F.lit(1))).otherwise(F.col("reason"))
    return df.select("request_id", "status", reply.alias("reply"))


def client_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _request_log(spark, sf_dir)
    return df.select("request_id", client_addr(F.col("x_forwarded_for"), F.col("remote_addr")).alias("client_addr"))


def form_url_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    df = request_paths(with_form_params(pages, "params", url_query("url")))
    entries = F.transform(F.map_entries("params"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    p = F.col("params")
    return df.select(
        "page_id",
        "path",
        F.size(p).alias("n_params"),
        F.array_join(F.array_sort(entries), "&").alias("params"),
        F.try_element_at(p, F.lit("page")).alias("page"),
        F.try_element_at(p, F.lit("ref")).alias("ref"),
        F.try_element_at(p, F.lit("utm_source")).alias("utm_source"),
    )


# --- partner postbacks and clicks ---------------------------------------


def _postback_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spark, sf_dir, "postback-requests", lambda ev: derive.postback_requests(ev, settings.PARTNER_KEY))


def _postbacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _postback_log(spark, sf_dir)
    return judge_postbacks(log, settings.PARTNER_KEY)


def postback_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _postbacks(spark, sf_dir).select("request_id", "status", "reason")


def postback_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _postbacks(spark, sf_dir).filter(F.col("status") == 200)
    return df.select(
        "request_id",
        F.col("record.event").alias("event"),
        F.col("record.id").alias("id"),
        F.col("record.timestamp").alias("timestamp"),
        F.col("record.did").alias("did"),
        F.col("record.aid").alias("aid"),
        F.col("record.ip").alias("ip"),
        F.col("record.os").alias("os"),
        sorted_keys(F.col("record.extension")).alias("ext_keys"),
        _ext("appid").alias("ext_appid"),
        _ext("adname").alias("ext_adname"),
        _ext("adid").alias("ext_adid"),
        _ext("device").alias("ext_device"),
        _ext("point").alias("ext_point"),
        _ext("channel").alias("ext_channel"),
    )


def postback_outbox_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ad-server notification per accepted postback, plus its topic (always default)."""
    out = postback_outbox(_postbacks(spark, sf_dir), settings.POSTBACK_BASE_URL)
    return out.withColumn("topic", topic_for(F.lit(DEFAULT_ROUTE), settings.ROUTES))


def _clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spark, sf_dir, "click-messages", derive.click_messages)


def click_verdicts_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_clicks(_clicks(spark, sf_dir)).select("offset", "verdict")


def click_urls_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return click_outbox(_clicks(spark, sf_dir), settings.CLICK_BASE_URL, settings.PARTNER_PID)


# --- dead letters and replay --------------------------------------------


def _backup_logs(spark: SparkSession, sf_dir: str) -> str:
    ev = _events(spark, sf_dir)
    return landed_path(spark, "backup-logs", ev, lambda p: derive.write_backup_logs(_spread(ev), p))


def _replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay(read_backup_log(spark, _backup_logs(spark, sf_dir)), settings.ROUTES)


def dead_letter_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _replayed(spark, sf_dir)
    return df.select(
        "attempt",
        "verdict",
        F.col("record.aid").alias("aid"),
        F.col("record.did").alias("did"),
        F.col("record.timestamp").alias("timestamp"),
        _ext("event_type").alias("event_type"),
        _ext("value").alias("value"),
        _ext("k").alias("k"),
        "topic",
    )


def replay_summary_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay_summary(_replayed(spark, sf_dir), by="attempt")


def replay_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: replay writes successes to the topic table and failures to the next attempt."""
    root = scratch_path(spark, "replay")
    replay_to_tables(_replayed(spark, sf_dir), f"{root}/topics", f"{root}/dead_letter")
    topics = spark.read.parquet(f"{root}/topics").groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
    dead = DeadLetterLedger(spark, f"{root}/dead_letter").letters().groupBy("attempt", "error").agg(F.sum("copies").alias("n"))
    return topics.select(F.lit("topic").alias("table"), F.col("topic").alias("part"), F.lit(None).cast("string").alias("error"), "n").unionByName(
        dead.select(F.lit("dead_letter").alias("table"), F.col("attempt").cast("string").alias("part"), "error", "n")
    )


def retry_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _replayed(spark, sf_dir).filter(F.col("retry") != "ok")
    return df.groupBy("attempt", "next_attempt", "retry").agg(F.count(F.lit(1)).alias("n_lines"))


# --- codec, messages, partitions -----------------------------------------


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select(derive.stored_record().alias("record"))


def codec_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9 then P10: every record survives encode/decode unchanged."""
    enc = _stored(spark, sf_dir).select(encode(F.col("record")).alias("value"))
    df = decode(enc)
    return df.select(
        "decoded",
        *[F.col(f"record.{c}").alias(c) for c in ("event", "id", "timestamp", "did", "aid", "ip", "os", "exchange")],
        sorted_keys(F.col("record.extension")).alias("ext_keys"),
        _ext("event_type").alias("ext_event_type"),
        _ext("value").alias("ext_value"),
        _ext("k").alias("ext_k"),
    )


def _routed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _stored(spark, sf_dir)
    return route(df, settings.ROUTES, event_type=F.try_element_at(F.col("record.extension"), F.lit("event_type")))


def topic_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: one message per record, each carrying its own topic; payload decodes back."""
    msgs = to_messages(_routed_records(spark, sf_dir), encode(F.col("record")))
    text = F.col("value").cast("string")
    return msgs.select(
        "topic",
        "partition",
        F.col("key").isNull().alias("no_key"),
        F.get_json_object(text, "$.aid").alias("aid"),
        F.get_json_object(text, "$.extension.event_type").alias("event_type"),
    )


def string_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: string payload variant."""
    msgs = to_string_messages(_routed_records(spark, sf_dir), F.to_json(F.col("record")))
    return msgs.select("topic", F.get_json_object("value", "$.aid").alias("aid"), F.get_json_object("value", "$.timestamp").alias("timestamp"))


def message_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: manual partition 3 for every message; hash/random leave it to the producer."""
    df = _stored(spark, sf_dir).select(F.col("record.aid").alias("aid"))
    df = assign_partition(df, "manual", 3, out="manual_partition")
    df = assign_partition(df, "hash", out="hash_partition")
    return assign_partition(df, "random", out="random_partition")


# --- request dispatch ------------------------------------------------------


def _dispatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = request_paths(table(spark, sf_dir, "pages").select("page_id", "url"))
    return match_prefix(pages, list(settings.PREFIXES))


def prefix_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dispatched(spark, sf_dir).select("page_id", "path", "prefix", "reason")


def request_count_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return request_count(_dispatched(spark, sf_dir), matched="prefix")


# --- CSV uploads -------------------------------------------------------------


def _upload_root(spark: SparkSession, sf_dir: str) -> str:
    ev = _events(spark, sf_dir)
    return landed_path(spark, "uploads", ev, lambda p: derive.write_uploads(_spread(ev), p))


def _upload_id(path: str = "file_path") -> F.Column:
    return F.regexp_extract(path, r"upload_id=([0-9]+)", 1).cast("long").alias("upload_id")


def _uploads(spark: SparkSession, sf_dir: str, until_fault: bool = False) -> tuple[DataFrame, DataFrame]:
    rows, files = read_event_csv(spark, _upload_root(spark, sf_dir), glob="*.txt", until_fault=until_fault)
    return rows.withColumn("upload_id", _upload_id()), files.withColumn("upload_id", _upload_id())


def _upload_request_folder(spark: SparkSession, sf_dir: str) -> str:
    root, ev = _upload_root(spark, sf_dir), _events(spark, sf_dir)

    def land(path: str) -> None:
        files = list_uploads(spark, root, "*.txt")
        derive.upload_requests(ev, files, root).repartition(4, "file_path").write.mode("overwrite").parquet(path)

    return landed_path(spark, "upload-requests", ev, land)


def csv_event_record(spark: SparkSession, sf_dir: str, until_fault: bool = False) -> DataFrame:
    rows, _ = _uploads(spark, sf_dir, until_fault)
    rows = route(rows.filter(F.col("status") == 200), settings.ROUTES, event_type="event_type")
    return rows.select(
        "upload_id",
        F.col("record.event").alias("event"),
        F.col("record.id").alias("id"),
        F.col("record.did").alias("did"),
        F.col("record.timestamp").alias("timestamp"),
        F.col("record.aid").alias("aid"),
        F.col("record.ip").alias("ip"),
        sorted_keys(F.col("record.extension")).alias("ext_keys"),
        _ext("event_type").alias("ext_event_type"),
        _ext("value").alias("ext_value"),
        _ext("k").alias("ext_k"),
        _ext("note").alias("ext_note"),
        "topic",
    )


def csv_prefix_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 the original's way: each upload's records before its first faulty one."""
    return csv_event_record(spark, sf_dir, until_fault=True)


def upload_replies_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The original's reply to every upload request: header-only, empty, missing and oversized ones too."""
    requests = spark.read.parquet(_upload_request_folder(spark, sf_dir))
    rows, files = read_event_csv(spark, _upload_root(spark, sf_dir), glob="*.txt", manifest=requests, until_fault=True)
    return upload_replies(rows, files, until_fault=True).select(_upload_id(), "status", "n_written", "reply")


def stream_upload_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1/K4 in a stream of upload requests: the sink refuses every ninth message; replies and the letters kept."""
    source = _upload_request_folder(spark, sf_dir)
    root = scratch_path(spark, "uploadreplies")

    def sink(messages: DataFrame, batch_id: int) -> DataFrame:
        """Refuses what is on every ninth line of an upload."""
        refused = F.regexp_extract("origin", r"#([0-9]+)\z", 1).cast("long") % 9 == 0
        write_topic_table(messages.where(~refused), f"{root}/topics", batch_id)
        return messages.select("message_id", F.when(refused, F.lit("refused")).alias("error"))

    q = start_upload_request_job(
        upload_request_stream(spark, source, 2), settings.ROUTES, f"{root}/topics", f"{root}/dead_letter", f"{root}/replies", f"{root}/checkpoint", available_now=True, sink=sink
    )
    _ended(q)
    letters = DeadLetterLedger(spark, f"{root}/dead_letter").letters().groupBy(_upload_id("origin")).agg(F.count_if(F.col("kind") == "unsent").alias("n_unsent"), F.count_if(F.col("kind") == "rejected").alias("n_rejected"))
    replies = spark.read.parquet(f"{root}/replies").select(_upload_id(), "status", "n_written", "reply")
    return replies.join(letters, "upload_id", "left").na.fill(0, ["n_unsent", "n_rejected"])


def upload_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 -> J1 -> K1/K4: upload rows become topic messages; bad rows and files become dead letters."""
    rows, files = _uploads(spark, sf_dir)
    messages, dead = ingest_uploads(rows, files, settings.ROUTES)
    per_topic = messages.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
    per_error = dead.groupBy("error").agg(F.count(F.lit(1)).alias("n"))
    return per_topic.select(F.lit("message").alias("kind"), F.col("topic").alias("name"), "n").unionByName(
        per_error.select(F.lit("dead_letter").alias("kind"), F.col("error").alias("name"), "n")
    )


def stream_upload_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV uploads ingested by a file-stream query, a few files per micro-batch; same output as ``upload_messages``."""
    uploads = _upload_root(spark, sf_dir)
    root = scratch_path(spark, "uploadstream")
    q = start_upload_job(
        upload_file_stream(spark, uploads, glob="*.txt"),
        settings.ROUTES,
        f"{root}/topics",
        f"{root}/dead_letter",
        f"{root}/checkpoint",
        available_now=True,
    )
    _ended(q)
    topics = spark.read.parquet(f"{root}/topics").groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
    dead = DeadLetterLedger(spark, f"{root}/dead_letter").letters().groupBy("error").agg(F.sum("copies").alias("n"))
    return topics.select(F.lit("message").alias("kind"), F.col("topic").alias("name"), "n").unionByName(
        dead.select(F.lit("dead_letter").alias("kind"), F.col("error").alias("name"), "n")
    )


def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = _uploads(spark, sf_dir)
    bad = rows.filter(F.col("status") != 200)
    return bad.groupBy("upload_id", "status", "reason").agg(F.count(F.lit(1)).alias("n_rows"))


def csv_file_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, files = _uploads(spark, sf_dir)
    return files.select("upload_id", "status", "reason")


def upload_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: the receipt of every upload that was read, of 0 messages too."""
    rows, files = _uploads(spark, sf_dir)
    read = upload_replies(rows, files).where(F.col("status") == 200)
    return read.select(_upload_id(), "n_written", F.col("reply").alias("receipt"))


# --- streaming ---------------------------------------------------------------


def _ended(q) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def stream_click_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The click job as a Structured Streaming query over a file stream of messages.

    The messages Spark derives from ``events`` are landed as Parquet, streamed
    with ``availableNow`` in micro-batches of so many bytes, and the outbox the job
    wrote is returned (same rows as ``click_urls``).
    """
    source = _land(spark, sf_dir, "click-messages", derive.click_messages)
    root = scratch_path(spark, "clickstream")
    q = start_click_job(
        message_file_stream(spark, source, max_bytes_per_trigger=BATCH_BYTES),
        f"{root}/outbox",
        f"{root}/checkpoint",
        settings.CLICK_BASE_URL,
        settings.PARTNER_PID,
        available_now=True,
    )
    _ended(q)
    return spark.read.parquet(f"{root}/outbox").drop("batch_id")


def dead_letter_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: rejected form requests appended to the dead-letter ledger, twice to no effect, read back by reason."""
    _, dead = form_messages_and_dead_letters(_forms(spark, sf_dir))
    ledger = DeadLetterLedger(spark, scratch_path(spark, "dead_letter"))
    for commit in ("first", "first", "again"):
        ledger.append(dead, commit)
    back = ledger.letters()
    return back.groupBy("attempt", "error").agg(
        F.count(F.lit(1)).alias("n_letters"),
        F.count_if(F.col("data").isNotNull() & F.col("record").isNotNull()).alias("n_with_payload"),
    )


def stream_form_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form ingest as a streaming query: valid events per topic read back from the topic table."""
    source = _land(spark, sf_dir, "form-requests", derive.request_log)
    root = scratch_path(spark, "ingeststream")
    q = start_ingest_job(
        request_file_stream(spark, source, max_bytes_per_trigger=BATCH_BYTES),
        settings.ROUTES,
        f"{root}/topics",
        f"{root}/dead_letter",
        f"{root}/checkpoint",
        available_now=True,
    )
    _ended(q)
    return spark.read.parquet(f"{root}/topics").groupBy("topic").agg(F.count(F.lit(1)).alias("n_events"))


def _topic_table(spark: SparkSession, sf_dir: str) -> str:
    def land(path: str) -> None:
        messages, _ = form_messages_and_dead_letters(ingest_forms(_request_log(spark, sf_dir), settings.ROUTES))
        write_topic_table(messages, path)

    return landed_path(spark, "topic-table", _events(spark, sf_dir), land)


def topic_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land valid form events in the topic table, then dump one topic (pruned scan) and decode it."""
    df = dump_topic(spark, _topic_table(spark, sf_dir), settings.ROUTES["click"])
    return df.select(
        "topic",
        "decoded",
        F.col("record.did").alias("did"),
        F.col("record.timestamp").alias("timestamp"),
        F.col("record.aid").alias("aid"),
        F.col("record.ip").alias("ip"),
        _ext("event_type").alias("event_type"),
        _ext("value").alias("value"),
    )


def partition_manual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3, manual mode alone: every message pinned to partition 3."""
    msgs = to_messages(_routed_records(spark, sf_dir), encode(F.col("record")), partition=None)
    msgs = assign_partition(msgs, "manual", 3)
    return msgs.select("topic", "partition", F.get_json_object(F.col("value").cast("string"), "$.aid").alias("aid"))


def csv_header_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 alone: which uploads name every required column."""
    _, files = _uploads(spark, sf_dir)
    missing = F.when(F.col("reason").startswith("Missing Required field"), F.col("reason"))
    return files.select("upload_id", missing.isNull().alias("header_ok"), missing.alias("missing"))


def upload_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4 alone: which uploads are within the 10 MiB cap; told from the listing, without reading them."""
    return file_sizes(list_uploads(spark, _upload_root(spark, sf_dir), "*.txt")).select(_upload_id(), "within_cap")


# --- the dead-letter loop, results of sends and deliveries ---------------------------


def _refusing(topics: str):
    """A sender that takes request N at its try ``N % 4`` and refuses it before; what it takes is written."""

    def send(messages: DataFrame, batch: str) -> DataFrame:
        number = F.regexp_extract("origin", r"([0-9]+)\z", 1).cast("long")
        now = F.col("attempt") + 1 if "attempt" in messages.columns else F.lit(0)
        refused = number % 4 > now
        write_topic_table(messages.where(~refused).select("topic", "partition", "key", "value"), topics, batch)
        return messages.select("message_id", F.when(refused, F.lit("refused")).alias("error"))

    return send


def _closed_loop(spark: SparkSession, sf_dir: str) -> tuple[DeadLetterLedger, str]:
    """Form events sent, the refused ones kept and replayed three times; every step is run twice. Some payloads are damaged."""
    root = scratch_path(spark, "deadletterloop")
    topics, ledger = f"{root}/topics", DeadLetterLedger(spark, f"{root}/dead_letter")
    judged = f"{root}/judged"
    # messages and letters are made from one judgement, and of these columns; a valid request's form is in its record
    form = [F.when(F.col("status") != 200, F.col(c)).alias(c) for c in ("params", "body", "query")]
    _forms(spark, sf_dir).select("request_id", "status", "reason", *form, "record", "topic").write.option("compression", "zstd").parquet(judged)
    messages, dead = form_messages_and_dead_letters(spark.read.parquet(judged))
    sent = settle(messages, _refusing(topics), "ingest")
    number = F.regexp_extract("origin", r"([0-9]+)\z", 1)
    damaged = F.when(number.cast("long") % 43 == 5, F.encode(F.concat(F.lit("no record "), number), "UTF-8")).otherwise(F.col("value"))
    letters = dead.unionByName(unsent_letters(sent.failures(messages).withColumn("value", damaged)))
    letters.write.option("compression", "zstd").parquet(f"{root}/letters")  # reported three times, made once
    for commit in ("ingest", "ingest", "ingest-again"):
        ledger.append(spark.read.parquet(f"{root}/letters"), commit)
    for k in (1, 1, 2, 2, 3):
        replay_ledger(ledger, _refusing(topics), settings.ROUTES, f"replay-{k}")
    return ledger, topics


def dead_letter_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4/K5: every try of every letter, with its payload."""
    ledger, _ = _closed_loop(spark, sf_dir)
    letters = decode(ledger.letters().drop("record"), value="data")
    states = ledger.states().select(packed("letter_id").alias("name"), "attempt", "outcome", "error")
    told = letters.select(
        packed("letter_id").alias("name"),
        F.regexp_extract("origin", r"([0-9]+)\z", 1).cast("long").alias("request_id"),
        "kind",
        "copies",
        "topic",
        F.col("record.did").alias("did"),
        F.when(F.col("decoded"), F.col("record.timestamp")).alias("timestamp"),
        _ext("value").alias("value"),
    )
    return told.join(states, "name").select("request_id", "kind", "copies", "attempt", "outcome", "error", "topic", "did", "timestamp", "value")


def replayed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: the payloads on every topic after the replays: each valid event once."""
    _, topics = _closed_loop(spark, sf_dir)
    df = decode(read_topic_table(spark, topics), value="value")
    return df.select("topic", F.col("record.did").alias("did"), F.col("record.timestamp").alias("timestamp"), F.col("record.aid").alias("aid"), _ext("event_type").alias("event_type"), _ext("value").alias("value"))


def replay_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: what each replay sent and what failed in it, by what became of the letters."""
    ledger, _ = _closed_loop(spark, sf_dir)
    return ledger.summary()


def stream_send_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 in a stream: messages sent, failed and requests rejected by the job's counts, by the sink's table and by the ledger."""
    source = _land(spark, sf_dir, "form-requests", derive.request_log)
    root = scratch_path(spark, "sendcounts")

    def sink(messages: DataFrame, batch_id: int) -> DataFrame:
        refused = F.regexp_extract("origin", r"([0-9]+)\z", 1).cast("long") % 5 == 0
        write_topic_table(messages.where(~refused), f"{root}/topics", batch_id)
        return messages.select("message_id", F.when(refused, F.lit("refused")).alias("error"))

    _ended(
        start_ingest_job(
            request_file_stream(spark, source, max_bytes_per_trigger=BATCH_BYTES), settings.ROUTES, f"{root}/topics", f"{root}/dead_letter", f"{root}/checkpoint", sink=sink, available_now=True, counts_path=f"{root}/counts"
        )
    )
    told = spark.read.parquet(f"{root}/counts").agg(F.sum("success").alias("success"), F.sum("failed").alias("failed"), F.sum("rejected").alias("rejected"))
    kind, none = F.col("kind"), F.lit(0).cast("long")
    letters = DeadLetterLedger(spark, f"{root}/dead_letter").letters().agg(none.alias("success"), F.count_if(kind == "unsent").alias("failed"), F.count_if(kind == "rejected").alias("rejected"))
    taken = spark.read.parquet(f"{root}/topics").agg(F.count(F.lit(1)).alias("success"), none.alias("failed"), none.alias("rejected"))
    kept = letters.unionByName(taken).agg(*[F.sum(c).alias(c) for c in ("success", "failed", "rejected")])
    return told.select(F.lit("counted").alias("by"), "*").unionByName(kept.select(F.lit("kept").alias("by"), "*"))


def _delivering(told: Callable[[DataFrame], DataFrame | None], **paths: str):
    """The click job over the landed messages, as in ``stream_click_urls``."""

    def run(spark: SparkSession, sf_dir: str, checkpoint: str) -> None:
        source = _land(spark, sf_dir, "click-messages", derive.click_messages)
        outbox = f"{checkpoint}-outbox"
        stream = message_file_stream(spark, source, max_bytes_per_trigger=BATCH_BYTES)
        _ended(start_click_job(stream, outbox, checkpoint, settings.CLICK_BASE_URL, settings.PARTNER_PID, deliver=told, available_now=True, **paths))

    return run


def delivery_results_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: every click request with what came of it; replies other than 200, errors and requests without a result stay."""
    root = scratch_path(spark, "delivery")

    def told(requests: DataFrame, batch_id: int) -> DataFrame:
        n = F.col("source_id")
        silent = n % 11 == 0
        status = F.when(~silent, F.when(n % 7 == 0, F.lit(503)).otherwise(F.lit(200)))
        return requests.where(n % 13 != 1).select("request_key", status.alias("status"), F.when(silent, F.lit("timeout")).alias("error"))

    _delivering(told, results_path=f"{root}/results")(spark, sf_dir, f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/results").select("source_id", "url", "status", "error", "outcome")


def click_at_most_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 the original's way: batches are claimed before they are sent; a second run over the same messages sends nothing."""
    root = scratch_path(spark, "claims")

    def told(requests: DataFrame, batch_id: int) -> None:
        requests.select("source_id", "url").write.mode("append").parquet(f"{root}/sent")

    for run in ("first", "second"):
        _delivering(told, claims_path=f"{root}/claims")(spark, sf_dir, f"{root}/{run}")
    return spark.read.parquet(f"{root}/sent").groupBy("source_id", "url").agg(F.count(F.lit(1)).alias("n_sent"))


def keyed_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3, keyed hash: all messages of a device on one partition of twelve."""
    df = _stored(spark, sf_dir).select(F.col("record.did").alias("did"))
    df = assign_partition(df, "hash", n=12, key="did")
    one = F.col("partition").between(0, 11)
    return df.groupBy("did").agg(F.count(F.lit(1)).alias("n_messages"), F.countDistinct("partition").alias("n_partitions"), F.bool_and(one).alias("in_range"))


def prefix_table_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 with a table of many nested prefixes: the longest that each page's URL begins with."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return match_prefix(pages, derive.prefix_table(pages), path="url").select("page_id", "prefix", "reason")


QUERIES: dict[str, Query] = {
    "events_per_topic": events_per_topic,
    "form_event_record": form_event_record,
    "event_validation": event_validation,
    "event_routing": event_routing,
    "form_replies": form_replies,
    "client_address": client_address,
    "form_url_params": form_url_params,
    "postback_verdicts": postback_verdicts,
    "postback_records": postback_records,
    "postback_outbox": postback_outbox_q,
    "click_verdicts": click_verdicts_q,
    "click_urls": click_urls_q,
    "dead_letter_roundtrip": dead_letter_roundtrip,
    "replay_summary": replay_summary_q,
    "retry_generation": retry_generation,
    "codec_roundtrip": codec_roundtrip,
    "topic_messages": topic_messages,
    "string_message": string_message,
    "message_partitions": message_partitions,
    "prefix_match": prefix_match,
    "request_count": request_count_q,
    "csv_event_record": csv_event_record,
    "csv_quarantine": csv_quarantine,
    "csv_file_verdicts": csv_file_verdicts,
    "upload_receipts": upload_receipts,
    "stream_click_urls": stream_click_urls,
    "dead_letter_table": dead_letter_table,
    "stream_form_ingest": stream_form_ingest,
    "topic_dump": topic_dump,
    "replay_tables": replay_tables,
    "partition_manual": partition_manual,
    "csv_header_check": csv_header_check,
    "upload_size": upload_size,
    "upload_messages": upload_messages,
    "stream_upload_ingest": stream_upload_ingest,
    "dead_letter_replay": dead_letter_replay,
    "replayed_messages": replayed_messages,
    "replay_counts": replay_counts,
    "stream_send_counts": stream_send_counts,
    "delivery_results": delivery_results_q,
    "click_at_most_once": click_at_most_once,
    "csv_prefix_rows": csv_prefix_rows,
    "upload_replies": upload_replies_q,
    "stream_upload_replies": stream_upload_replies,
    "prefix_table_match": prefix_table_match,
    "keyed_partitions": keyed_partitions,
}


def land_inputs(spark: SparkSession, sf_dir: str) -> None:
    """Land every derived input that the queries read, so that a query's time is its own."""
    for land in (_request_log, _postback_log, _clicks, _backup_logs, _upload_root, _upload_request_folder, _topic_table):
        land(spark, sf_dir)
