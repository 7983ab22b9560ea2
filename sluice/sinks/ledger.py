"""K4/K5/A2: the dead-letter ledger.

Two append-only Parquet tables. ``path`` holds each letter once, by its digest;
``path.states`` logs each try of it (``failed``, ``sent``, ``exhausted``).
Every append is a named commit: a folder ``commit=NAME`` that a re-run replaces,
holding only what no other commit holds (an anti-join on the digest, or on
digest and try). So a batch that is reported twice, or a replay that is run
again, changes nothing. The states' folder is written last and its success
marker is the commit: a letter counts once its state does.

A letter that is reported more than once within one commit is one row with the
number of ``copies``. One writer at a time is assumed, as a streaming query or
a scheduled replay is.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.schema import DEAD_LETTER, MAX_RETRY_GENERATIONS, UNSENT
from sluice.session import _fs_exists, scratch_path
from sluice.sinks.deadletter import packed, unpacked

LETTERS = T.StructType([*DEAD_LETTER.fields, T.StructField("copies", T.LongType()), T.StructField("commit", T.StringType())])
STATES = T.StructType(
    [
        T.StructField("letter_id", T.StringType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("outcome", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("commit", T.StringType()),
    ]
)
FAILED, SENT, EXHAUSTED = "failed", "sent", "exhausted"


class DeadLetterLedger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.states_path = spark, path.rstrip("/"), path.rstrip("/") + ".states"

    def _read(self, path: str, schema: T.StructType) -> DataFrame:
        if not _fs_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def letters(self) -> DataFrame:
        return self._read(self.path, LETTERS)

    def states(self) -> DataFrame:
        return self._read(self.states_path, STATES)

    def is_committed(self, commit: str) -> bool:
        return _fs_exists(self.spark, f"{self.states_path}/commit={commit}/_SUCCESS")

    def _checked(self, commit: str) -> str:
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", commit):
            raise ValueError(f"a commit's name is a folder's: {commit!r} holds other than letters, digits, _ . and -")
        return commit

    def _has_other(self, path: str, commit: str) -> bool:
        """Whether another commit has a folder; the first one found ends the search."""
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(path)
        fs = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return fs.exists(folder) and any(s.getPath().getName() not in (f"commit={commit}", "_SUCCESS") for s in fs.listStatus(folder))

    def _known(self, table: DataFrame, path: str, keys: list[str], tries: DataFrame, commit: str) -> tuple[int, DataFrame | None]:
        """How many of ``tries`` another commit holds, by their keys, and the keys of the others; only keys are moved."""
        if not self._has_other(path, commit):
            return 0, None
        others = table.where(F.col("commit") != commit).withColumn("name", packed("letter_id")).select(*keys)
        return tries.select(*keys).join(others, keys, "left_semi").count(), others

    def _write(self, fresh: DataFrame, path: str, commit: str) -> None:
        fresh.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/commit={commit}")

    def append(self, dead: DataFrame, commit: str) -> int:
        """Letters that failed (``to_dead_letters``), each at its ``attempt``; again under the same name, or another, they are known.

        Returns how many were reported, counted as their names are. Names and
        attempts are looked at first: payloads are shuffled only if letters
        repeat within the commit, or if some but not all are known. Where no
        other commit can know them, only hashes of them are counted: fewer
        hashes than rows means that letters may repeat.
        """
        commit = self._checked(commit)
        counts = [F.sum("copies").alias("n"), F.count(F.lit(1)).alias("tries"), F.sum("attempts").alias("attempts"), F.min("first").alias("first"), F.max("last").alias("last")]
        of_try = [F.count(F.lit(1)).alias("copies"), F.count("attempt").alias("attempts"), F.min("attempt").alias("first"), F.max("attempt").alias("last")]
        known_letters = known_states = 0, None
        if self._has_other(self.path, commit) or self._has_other(self.states_path, commit):
            path, seen = scratch_path(self.spark, "ledger-tries"), Observation()
            tries = dead.groupBy(packed("letter_id").alias("name"), "attempt").agg(*of_try).observe(seen, *counts)
            tries.select("name", "attempt").write.option("compression", "zstd").parquet(path)
            tries, got = self.spark.read.parquet(path), seen.get
            known_letters = self._known(self.letters(), self.path, ["name"], tries, commit)
            known_states = self._known(self.states(), self.states_path, ["name", "attempt"], tries, commit)
        else:
            got = dead.groupBy(F.xxhash64("letter_id", "attempt").alias("hash")).agg(*of_try).agg(*counts).head().asDict()
        reported, n = got.get("n") or 0, got.get("tries") or 0

        def fresh(rows: DataFrame, keys: list[str], known: tuple[int, DataFrame | None]) -> DataFrame:
            count, others = known
            if not count:
                return rows
            return rows.where(F.lit(False)) if count == n else rows.withColumn("name", packed("letter_id")).join(others, keys, "left_anti").select(*rows.columns)

        single = reported == n == (got.get("attempts") or 0) and got.get("first") == got.get("last")
        if single:  # every row is a letter of its own
            told = letters = dead.withColumn("copies", F.lit(1).cast("long"))
        else:
            staged = scratch_path(self.spark, "ledger-append")
            values = [F.min(c).alias(c) for c in DEAD_LETTER.fieldNames() if c not in ("letter_id", "attempt")]
            # one time of failure, one list of copies, for both tables
            dead.groupBy("letter_id", "attempt").agg(*values, F.count(F.lit(1)).alias("copies")).write.option("compression", "zstd").parquet(staged)
            told = self.spark.read.parquet(staged)
            first = told.groupBy("letter_id").agg(F.min_by(F.struct(*[c for c in told.columns if c != "letter_id"]), "attempt").alias("t"))
            letters = first.select("letter_id", "t.*")
        self._write(fresh(letters.select(*LETTERS.fieldNames()[:-1]), ["name"], known_letters), self.path, commit)
        if single and not known_letters[0]:  # all of them were written
            told = self.spark.read.schema(LETTERS).parquet(f"{self.path}/commit={commit}")
        outcome = F.when((F.col("kind") == UNSENT) & (F.col("attempt") > MAX_RETRY_GENERATIONS), F.lit(EXHAUSTED)).otherwise(F.lit(FAILED))
        states = told.select("letter_id", "attempt", outcome.alias("outcome"), "error")
        self._write(fresh(states, ["name", "attempt"], known_states), self.states_path, commit)
        return reported

    def _append_states(self, states: DataFrame, commit: str) -> None:
        """Only logged tries of the same numbers can be known: a replay's are new, and then nothing is joined."""
        first, last = states.agg(F.min("attempt"), F.max("attempt")).head()
        known = self.states().where((F.col("commit") != commit) & F.col("attempt").between(F.lit(first), F.lit(last)))
        if first is not None and not known.isEmpty():
            known = known.select(packed("letter_id").alias("name"), "attempt")
            states = states.withColumn("name", packed("letter_id")).join(known, ["name", "attempt"], "left_anti").select(*states.columns)
        self._write(states, self.states_path, commit)

    def last_states(self) -> DataFrame:
        """One row a letter: its last try and what came of it. A letter that was sent once is sent."""
        order = F.struct(F.col("outcome") == SENT, "attempt")
        last = F.max_by(F.struct("attempt", "outcome", "error"), order).alias("s")
        return self.states().groupBy("letter_id").agg(last).select("letter_id", "s.*")

    def pending(self) -> DataFrame:
        """Letters to be tried again, with the ``attempt`` that failed last."""
        tries = [F.bool_or(F.col("outcome") == SENT).alias("sent"), F.max("attempt").alias("attempt"), F.max(F.when(F.col("outcome") == EXHAUSTED, F.col("attempt"))).alias("end")]
        last = self.states().groupBy(packed("letter_id").alias("name")).agg(*tries)
        failed = last.where(~F.col("sent") & (F.col("end").isNull() | (F.col("end") < F.col("attempt")))).select("name", "attempt")
        rest = [c for c in LETTERS.fieldNames() if c not in ("letter_id", "attempt", "commit")]
        letters = self.letters().where(F.col("kind") == UNSENT).select(packed("letter_id").alias("name"), *rest)
        return letters.join(failed, "name").select(unpacked("name").alias("letter_id"), *rest, "attempt")

    def settle(self, tried: DataFrame, commit: str, limit: int = MAX_RETRY_GENERATIONS) -> None:
        """Log a replay: ``tried`` holds letter_id, the ``attempt`` before it and its ``error`` (null when sent)."""
        commit = self._checked(commit)
        now = F.col("attempt") + 1
        outcome = F.when(F.col("error").isNull(), F.lit(SENT)).when(now > limit, F.lit(EXHAUSTED)).otherwise(F.lit(FAILED))
        self._append_states(tried.select("letter_id", now.alias("attempt"), outcome.alias("outcome"), "error"), commit)

    def summary(self, by: Mapping[str, Column] | None = None) -> DataFrame:
        """A2: sent and failed letters of every commit's tries."""
        keys = {"commit": F.col("commit"), **(by or {})}
        return self.states().groupBy(*[c.alias(n) for n, c in keys.items()]).agg(
            F.count_if(F.col("outcome") == SENT).alias("success"), F.count_if(F.col("outcome") != SENT).alias("failed")
        )
