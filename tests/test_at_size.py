"""Steps whose cost must not grow faster than their input: landing, micro-batches, appends to the ledger."""

from pyspark.sql import functions as F

from sluice.operators.assemble import record
from sluice.operators.codec import encode
from sluice.plans import derive, settings
from sluice.plans import queries as Q
from sluice.schema import MAX_UPLOAD_BYTES
from sluice.sinks import ledger as L
from sluice.sinks.deadletter import packed, to_dead_letters, unpacked
from sluice.streaming.click_job import message_file_stream, start_click_job
from sluice.streaming.ingest_job import request_file_stream, start_ingest_job
from sluice.streaming.upload_job import start_upload_job, upload_file_stream


def events(spark, n):
    i = F.col("id")
    ts = F.timestamp_seconds(i + 1_700_000_000).cast("timestamp_ntz")
    return spark.range(n, numPartitions=1).select(
        i.alias("event_id"), ts.alias("ts"), (i % 50).alias("user_id"), F.lit("click").alias("event_type"), i.cast("double").alias("value"), F.lit('{"k": 3}').alias("props")
    )


def letters(spark, numbers):
    df = spark.createDataFrame([(n,) for n in numbers], "n long")
    data = encode(record(event=F.lit("TrackerEvent"), id=F.lit(""), timestamp=F.lit("1"), aid=F.col("n").cast("string")))
    return to_dead_letters(df, F.lit("boom"), None, data, F.lit("t"), 0, F.col("n").cast("string"))


def test_rendering_is_spread_by_rows(spark):
    some = events(spark, 2 * Q.ROWS_A_TASK + 1)
    spread = Q._spread(some)
    assert some.rdd.getNumPartitions() == 1 and spread.rdd.getNumPartitions() == 3
    assert spread.agg(F.count("*"), F.sum("event_id")).first() == some.agg(F.count("*"), F.sum("event_id")).first()


def test_an_append_stages_payloads_only_if_letters_repeat(spark, tmp_path, monkeypatch):
    staged, path = [], L.scratch_path
    monkeypatch.setattr(L, "scratch_path", lambda s, name: staged.append(name) or path(s, name))
    ledger = L.DeadLetterLedger(spark, f"file:{tmp_path}/dead")
    assert ledger.append(letters(spark, range(6)), "one") == 6
    assert ledger.append(letters(spark, range(6)), "again") == 6  # all known
    assert ledger.append(letters(spark, range(4, 9)), "some") == 5  # some known
    assert "ledger-append" not in staged
    assert ledger.append(letters(spark, [8, 9, 9]), "repeats") == 3
    assert "ledger-append" in staged
    got = sorted((int(r.origin), r.commit, r.copies) for r in ledger.letters().collect())
    assert got == [*[(n, "one", 1) for n in range(6)], *[(n, "some", 1) for n in range(6, 9)], (9, "repeats", 2)]
    assert ledger.states().count() == 10 and ledger.summary().where("commit = 'some'").first().failed == 3


def test_small_files_share_a_micro_batch(spark, tmp_path):
    events(spark, 40).repartition(2).transform(derive.click_messages).write.parquet(f"{tmp_path}/clicks")
    events(spark, 40).repartition(2).transform(derive.request_log).write.parquet(f"{tmp_path}/forms")
    for k, (bound, batches) in enumerate(((1, 2), (Q.BATCH_BYTES, 1))):
        out = f"{tmp_path}/{k}"
        Q._ended(start_ingest_job(request_file_stream(spark, f"{tmp_path}/forms", max_bytes_per_trigger=bound), settings.ROUTES, f"{out}/t", f"{out}/d", f"{out}/c", available_now=True, counts_path=f"{out}/n"))
        assert spark.read.parquet(f"{out}/n").count() == batches
        took = []
        Q._ended(start_click_job(message_file_stream(spark, f"{tmp_path}/clicks", max_bytes_per_trigger=bound), f"{out}/o", f"{out}/cc", "b", "p", available_now=True, deliver=lambda r, b: took.append(b)))
        assert len(took) == batches


def test_more_than_a_hundred_small_uploads_share_a_micro_batch(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for n in range(120):
        (folder / f"{n}.csv").write_text(f"did,timestamp,event_type\nd{n},1,click\n")
    out = tmp_path / "out"
    Q._ended(start_upload_job(upload_file_stream(spark, str(folder)), {"default": "d"}, f"{out}/t", f"{out}/d", f"{out}/c", available_now=True, counts_path=f"{out}/n"))
    assert [r.success for r in spark.read.parquet(f"{out}/n").collect()] == [120]


def test_uploads_above_the_cap_are_filled_after_the_sort(spark, tmp_path):
    some = events(spark, 4 * derive.UPLOAD_ROWS)  # upload 3 has one above the cap beside it
    derive.write_uploads(some, str(tmp_path / "up"))
    sizes = {r.path.split("upload_id=")[1].split("/")[0]: r.length for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path / "up")).select("path", "length").collect()}
    head = len(",".join(derive.UPLOAD_HEADERS[0]))
    assert sizes[str(derive.OVERSIZED + 3)] == head + 1 + MAX_UPLOAD_BYTES + 1
    assert sizes[str(derive.HEADER_ONLY + 1)] == head + 1 and len(sizes) == 6


def test_packed_names_are_told_apart_and_come_back(spark):
    digest = "0f" * 32
    names = [digest, digest.upper(), digest + "\n", digest[:-1], "x" * 32, "", "é", " " * 33, None]
    rows = spark.createDataFrame([(n,) for n in names], "name string").select("name", packed("name").alias("p"))
    got = [(r.name, bytes(r.p) if r.p is not None else None, r.back) for r in rows.select("*", unpacked("p").alias("back")).collect()]
    assert [n for n, _, _ in got] == [b for _, _, b in got] == names
    assert len({p for _, p, _ in got}) == len(names) and len(got[0][1]) == 32


def test_only_an_append_that_others_may_know_stages_its_names(spark, tmp_path, monkeypatch):
    staged, path = [], L.scratch_path
    monkeypatch.setattr(L, "scratch_path", lambda s, name: staged.append(name) or path(s, name))
    ledger = L.DeadLetterLedger(spark, f"file:{tmp_path}/dead")
    for _ in range(2):
        assert ledger.append(letters(spark, range(6)), "one") == 6
    assert staged == []
    assert ledger.append(letters(spark, range(6)), "again") == 6
    assert staged == ["ledger-tries"] and ledger.letters().count() == ledger.states().count() == 6


def test_a_replay_joins_its_tries_only_with_tries_of_the_same_number(spark, tmp_path, monkeypatch):
    ledger, written = L.DeadLetterLedger(spark, f"file:{tmp_path}/dead"), []
    ledger.append(letters(spark, range(6)), "one")
    write = L.DeadLetterLedger._write
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(L.DeadLetterLedger, "_write", lambda self, df, *a: written.append(plan(df)) or write(self, df, *a))
    ids = [r.letter_id for r in ledger.letters().orderBy("letter_id").collect()]
    tried = spark.createDataFrame([(i, 0, "no") for i in ids[:4]], "letter_id string, attempt int, error string")
    ledger.settle(tried, "replay")
    assert "Join" not in written[-1] and ledger.states().count() == 10
    ledger.settle(tried.union(spark.createDataFrame([(ids[5], 0, None)], tried.schema)), "other")
    assert "Join" in written[-1]
    assert [r.letter_id for r in ledger.states().where("commit = 'other'").collect()] == [ids[5]]
    assert sorted((r.letter_id, r.attempt) for r in ledger.pending().collect()) == sorted([*[(i, 1) for i in ids[:4]], (ids[4], 0)])
