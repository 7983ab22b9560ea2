"""The dead-letter ledger: idempotent appends, replays until sent or exhausted, payloads at every try."""

import json

import pytest
from pyspark.sql import functions as F

from sluice.operators.assemble import record
from sluice.operators.codec import encode
from sluice.plans.replay import lines_to_letters, replay_ledger, replay_to_tables
from sluice.sinks.deadletter import message_id, to_dead_letters
from sluice.sinks.ledger import DeadLetterLedger
from sluice.sources.backup_log import read_backup_log

ROUTES = {"default": "d", "click": "clicks"}


def letters(spark, numbers, attempt=0, origin=True):
    ext = F.create_map(F.lit("event_type"), F.when(F.col("n") % 2 == 0, F.lit("click")).otherwise(F.lit("view")))
    df = spark.createDataFrame([(n,) for n in numbers], "n long")
    data = encode(record(event=F.lit("TrackerEvent"), id=F.lit(""), timestamp=F.lit("1"), aid=F.concat(F.lit("a"), F.col("n").cast("string")), extension=ext))
    where = F.concat(F.lit("request:"), F.col("n").cast("string")) if origin else None
    return to_dead_letters(df, F.lit("boom"), None, data, F.lit("old"), attempt, where)


@pytest.fixture
def ledger(spark, tmp_path):
    return DeadLetterLedger(spark, f"file:{tmp_path}/dead")


def refusing(*numbers, sent=None):
    """A sender that refuses some requests and remembers what it took."""

    def send(messages, batch):
        refused = F.regexp_extract("origin", r"([0-9]+)\z", 1).cast("long").isin(-1, *numbers)
        if sent is not None:
            sent.extend((batch, r.topic, json.loads(bytes(r.value))["aid"]) for r in messages.where(~refused).collect())
        return messages.select("message_id", F.when(refused, F.lit("no")).alias("error"))

    return send


def test_an_append_is_idempotent_by_name_and_by_letter(spark, ledger):
    assert ledger.append(letters(spark, range(10)), "one") == 10
    ledger.append(letters(spark, range(10)), "one")
    ledger.append(letters(spark, range(5, 15)), "two")
    assert ledger.letters().count() == ledger.states().count() == 15
    # a commit that is run again with less replaces what it wrote, the others stay
    ledger.append(letters(spark, [0, 1]), "one")
    assert sorted(r.origin for r in ledger.letters().select("origin").collect()) == sorted(f"request:{n}" for n in {0, 1, *range(10, 15)})


def test_an_unfinished_commit_is_done_again(spark, ledger):
    ledger.append(letters(spark, [1, 2]), "one")
    # as after a crash between the two tables: letters without their states are not pending, and the commit can run again
    letters_only = letters(spark, [3]).withColumns({"copies": F.lit(1).cast("long")})
    letters_only.write.parquet(f"{ledger.path}/commit=two")
    assert ledger.pending().count() == 2 and not ledger.is_committed("two")
    ledger.append(letters(spark, [3]), "two")
    assert ledger.pending().count() == 3 and ledger.letters().count() == 3


def test_equal_failures_are_one_letter_with_copies(spark, ledger):
    ledger.append(letters(spark, [7, 7, 7, 8], origin=False), "one")
    assert sorted(r.copies for r in ledger.letters().collect()) == [1, 3]
    assert ledger.pending().agg(F.sum("copies")).first()[0] == 4


def test_digest_tells_absent_from_empty(spark):
    rows = [(t, o, d) for t in (None, "", "x") for o in (None, "", "x") for d in (None, bytearray(b""), bytearray(b"x"))]
    df = spark.createDataFrame(rows, "t string, o string, d binary")
    ids = [r[0] for r in df.select(message_id(F.col("t"), F.col("o"), F.col("d"))).collect()]
    assert None not in ids and len(set(ids)) == len(rows)


def test_replays_send_each_letter_once_with_its_payload(spark, ledger):
    ledger.append(letters(spark, range(6)), "ingest")
    sent = []
    assert replay_ledger(ledger, refusing(1, 2, sent=sent), ROUTES, "first") == (4, 2)
    assert replay_ledger(ledger, refusing(sent=sent), ROUTES, "first") == (4, 2)  # ended: nothing is sent again
    assert replay_ledger(ledger, refusing(1, sent=sent), ROUTES, "second") == (1, 1)
    assert replay_ledger(ledger, refusing(sent=sent), ROUTES, "third") == (1, 0)
    assert replay_ledger(ledger, refusing(sent=sent), ROUTES, "fourth") == (0, 0)
    assert sorted(sent) == sorted(
        [("first", "clicks", "a0"), ("first", "d", "a3"), ("first", "clicks", "a4"), ("first", "d", "a5"), ("second", "clicks", "a2"), ("third", "d", "a1")]
    )
    first = ledger.letters().where("origin = 'request:1'").select("letter_id")
    got = sorted((r.attempt, r.outcome, r.error) for r in ledger.states().join(first, "letter_id").collect())
    assert got == [(0, "failed", "boom"), (1, "failed", "no"), (2, "failed", "no"), (3, "sent", None)]
    counts = {r.commit: (r.success, r.failed) for r in ledger.summary().collect()}
    assert counts == {"ingest": (0, 6), "first": (4, 2), "second": (1, 1), "third": (1, 0)}


def test_generations_end(spark, ledger):
    ledger.append(letters(spark, [1]), "ingest")
    for k in range(4):
        replay_ledger(ledger, refusing(1), ROUTES, f"r{k}", limit=2)
    assert sorted((r.attempt, r.outcome) for r in ledger.states().collect()) == [(0, "failed"), (1, "failed"), (2, "failed"), (3, "exhausted")]
    assert ledger.pending().count() == 0 and ledger.letters().count() == 1


def test_a_refused_batch_fails_whole_and_undecodable_letters_are_not_sent(spark, ledger):
    ledger.append(letters(spark, [1, 2]), "ingest")
    bad = spark.createDataFrame([(bytearray(b"no record"),)], "d binary")
    ledger.append(to_dead_letters(bad, F.lit("x"), None, F.col("d"), F.lit("t")), "bad")
    seen = []

    def broken(messages, batch):
        seen.append(messages.count())
        raise RuntimeError("down")

    assert replay_ledger(ledger, broken, ROUTES, "r") == (0, 3) and seen == [2]
    errors = sorted(r.error for r in ledger.states().where("attempt = 1").collect())
    assert errors == ["Failed to send message to kafka:down"] * 2 + ["undecodable"]


def test_backup_logs_join_the_loop(spark, ledger, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    good = json.dumps({"event": "TrackerEvent", "id": "", "timestamp": "1", "extension": {"event_type": "click"}}).encode()
    listed = " ".join(map(str, good))
    (logs / "backup.log").write_text(f"2024/01/01 00:00:00 data: [{listed}]\n2024/01/01 00:00:00 data: [1 300]\n")
    (logs / "backup.log.99").write_text(f"data: [{listed}]\n")
    lines = read_backup_log(spark, str(logs))
    ledger.append(lines_to_letters(lines), "logs")
    ledger.append(lines_to_letters(lines), "logs-again")
    assert sorted(r.attempt for r in ledger.pending().collect()) == [0, 0, 100]

    def refuse(messages, batch):
        return messages.select("message_id", F.lit("no").alias("error"))

    replay_ledger(ledger, refuse, ROUTES, "r")
    assert sorted((r.attempt, r.outcome, r.error) for r in ledger.last_states().collect()) == [(1, "failed", "no"), (1, "failed", "undecodable"), (101, "exhausted", "no")]
    kept = [bytes(r.data) for r in ledger.letters().collect()]
    assert b"2024/01/01 00:00:00 data: [1 300]" in kept


def test_replaying_the_same_files_into_tables_again_changes_nothing(spark, tmp_path):
    from sluice.plans.replay import replay

    logs = tmp_path / "logs"
    logs.mkdir()
    good = json.dumps({"event": "TrackerEvent", "id": "", "timestamp": "1", "extension": {"event_type": "click"}}).encode()
    (logs / "backup.log").write_text(f"data: [{' '.join(map(str, good))}]\ndata: [1 2]\ndata: [1 2]\n")
    for _ in range(2):
        replay_to_tables(replay(read_backup_log(spark, str(logs)), ROUTES), f"{tmp_path}/topics", f"{tmp_path}/dead")
    rows = spark.read.parquet(f"{tmp_path}/topics").collect()
    assert [(r.topic, json.loads(bytes(r.value))["extension"]["event_type"]) for r in rows] == [("clicks", "click")]
    dead = DeadLetterLedger(spark, f"{tmp_path}/dead").letters().collect()
    assert [(r.attempt, r.error, bytes(r.data), r.copies) for r in dead] == [(1, "undecodable", b"\x01\x02", 2)]


def test_commits_are_named_like_folders(spark, ledger):
    for name in ("a/b", "a b", "", "x=1"):
        with pytest.raises(ValueError):
            ledger.append(letters(spark, [1]), name)
