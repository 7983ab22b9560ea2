"""Token counts by source, language and tokenizer version, kept up to date by signed deltas.

A batch of changes is counted once: what its documents had before is
subtracted, what they have now is added, and the signed sums are written as
the batch's delta. Totals are the sum of all deltas, so they are additive over
batches, and a batch that is committed already changes nothing when it comes
again. The delta's success marker is the commit; the documents' new counts are
written before it and are read only for committed batches.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import _fs_exists
from .common import Scratch, Words, slices, table
from .packing import token_buffers, tokenizer_path

# Tokenizer versions: name and file; no file counts words between white space.
VERSIONS = {"words-1": None, "word_bpe_49k": "word_bpe_49k.json"}
KEYS = ("source", "lang", "tokenizer")
SUMS = ("n_docs", "n_tokens", "n_chars")


def counted(docs: DataFrame, versions: dict[str, str | None]) -> DataFrame:
    """doc_id, source, lang, tokenizer, n_docs (1), n_tokens, n_chars: a row for each document and version."""
    paths = [p and tokenizer_path(p) for p in versions.values()]
    fields = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in ("doc_id", "source", "lang"))

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        buffers = [p and token_buffers(p) for p in paths]
        for batch in slices(batches):
            texts = batch.column(3)
            by_version = [[len(b) // 4 for b in f(texts)] if f else Words(texts).sizes.tolist() for f in buffers]
            chars = pc.fill_null(pc.utf8_length(texts), 0).cast(pa.int64())
            counts = pa.array([list(x) for x in zip(*by_version, strict=True)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], chars, counts], names=["doc_id", "source", "lang", "n_chars", "counts"])

    rows = docs.select("doc_id", "source", "lang", "text").mapInArrow(count, f"{fields}, n_chars long, counts array<bigint>")
    named = F.arrays_zip(F.array(*map(F.lit, versions)).alias("tokenizer"), F.col("counts").alias("n_tokens"))
    out = rows.select("doc_id", "source", "lang", "n_chars", F.explode(named).alias("x"))
    return out.select("doc_id", "source", "lang", "x.tokenizer", F.lit(1).cast("long").alias("n_docs"), "x.n_tokens", "n_chars")


class TokenRollup:
    """Rollup under ``path``, a folder that all executors share.

    ``apply`` takes a batch number and its changes: rows op ('put' or
    'delete'), doc_id, source, lang, text. A put replaces all that its doc_id
    had, a delete removes it; unknown ids are deleted without effect. Rows of
    a batch that repeat a doc_id add up; if any of them is a put, deletes of
    that id in the batch only mean the replacement. Null ids are one id; null
    texts have no tokens; null sources and languages are groups of their own.
    An empty batch commits and changes nothing. Batches are applied in the
    order of their numbers; one that comes late ends with an error.

    What is committed is read from the folder, so a rollup that is opened
    again goes on where the last one stopped. Every ``compact`` batches the
    documents' current counts are written as one table, in the batch's own
    folder and before its commit; a batch reads the last such table and the
    batches behind it, however many came before.
    """

    def __init__(self, spark: SparkSession, path: str, versions: dict[str, str | None] = VERSIONS, compact: int = 16):
        self.spark, self.path, self.versions, self.compact = spark, path, versions, compact

    def _folder(self, kind: str, batch: int) -> str:
        return f"{self.path}/{kind}/batch={batch}"

    def committed(self, batch: int) -> bool:
        return _fs_exists(self.spark, f"{self._folder('deltas', batch)}/_SUCCESS")

    @property
    def batches(self) -> list[int]:
        """Numbers of the committed batches, rising."""
        if not _fs_exists(self.spark, f"{self.path}/deltas"):
            return []
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/deltas")
        listed = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
        numbers = [int(f.getPath().getName().split("=")[1]) for f in listed if f.getPath().getName().startswith("batch=")]
        return sorted(n for n in numbers if self.committed(n))

    def apply(self, batch: int, changes: DataFrame) -> bool:
        """Commit a batch; False if it is committed already."""
        batches = self.batches
        if batch in batches:
            return False
        if batches and batch < batches[-1]:
            raise ValueError(f"batch {batch} comes after batch {batches[-1]}")
        puts = counted(changes.where("op = 'put'"), self.versions)
        gone = changes.where("op = 'delete'").select("doc_id", *[F.lit(None).cast("string").alias(c) for c in KEYS], *[F.lit(0).cast("long").alias(c) for c in SUMS])
        # doc_ids' counts after the batch; a delete is a row of zeros
        puts.unionByName(gone).write.mode("overwrite").parquet(self._folder("states", batch))
        now = self.spark.read.parquet(self._folder("states", batch))
        signed = now.select(*KEYS, *SUMS)
        if batches:
            was = self._states(batches)
            ids = now.select(F.col("doc_id").alias("changed")).distinct()
            old = was.join(ids, was["doc_id"].eqNullSafe(F.col("changed")), "left_semi")
            signed = signed.unionByName(old.select(*KEYS, *[(-F.col(c)).alias(c) for c in SUMS]))
        delta = signed.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS]).where(" or ".join(f"{c} != 0" for c in SUMS))
        if (len(batches) + 1) % self.compact == 0:
            whole = [*batches, batch]
            self._states(whole, len(batches)).where("n_docs > 0").write.mode("overwrite").parquet(self._folder("current", batch))
            self._sums(whole[:-1], delta).write.mode("overwrite").parquet(self._folder("sums", batch))
        delta.write.mode("overwrite").parquet(self._folder("deltas", batch))
        return True

    def _since(self, kind: str, batches: list[int], before: int | None = None) -> tuple[list[str], list[int]]:
        """The last compacted table of the batches (of the first ``before``), if any, and the batches behind it."""
        for at in range((len(batches) if before is None else before) - 1, -1, -1):
            if (at + 1) % self.compact == 0 and _fs_exists(self.spark, f"{self._folder(kind, batches[at])}/_SUCCESS"):
                return [self._folder(kind, batches[at])], batches[at + 1 :]
        return [], batches

    def _states(self, batches: list[int], before: int | None = None) -> DataFrame:
        """Current counts of all documents: their rows of the last batch that has the doc_id."""
        compacted, later = self._since("current", batches, before)
        parts = [(0, p) for p in compacted] + [(1 + k, self._folder("states", b)) for k, b in enumerate(later)]
        rows = None
        for order, path in parts:
            part = self.spark.read.parquet(path).withColumn("batch", F.lit(order))
            rows = part if rows is None else rows.unionByName(part)
        last = rows.groupBy(F.col("doc_id").alias("id")).agg(F.max("batch").alias("last"))
        return rows.join(last, rows["doc_id"].eqNullSafe(F.col("id")) & (F.col("batch") == F.col("last"))).drop("id", "last", "batch")

    def _sums(self, batches: list[int], *more: DataFrame) -> DataFrame:
        compacted, later = self._since("sums", batches)
        rows = None
        for part in [*[self.spark.read.parquet(p) for p in (*compacted, *[self._folder("deltas", b) for b in later])], *more]:
            rows = part if rows is None else rows.unionByName(part)
        return rows.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens, n_chars over all committed batches; groups that came to nothing are left out."""
        batches = self.batches
        if not batches:
            raise ValueError("no batch is committed")
        return self._sums(batches).where("n_docs != 0")


def roll_up(docs: DataFrame, path: str, versions: dict[str, str | None] = VERSIONS) -> TokenRollup:
    """A rollup of ``docs`` after three batches: all rows put, texts with repeated lines revised, later exact copies deleted.

    The revision keeps the first of a text's equal lines. Of documents with
    equal texts the one with the least doc_id stays.
    """
    docs = docs.select("doc_id", "source", "lang", "text")
    rollup = TokenRollup(docs.sparkSession, path, versions)
    rollup.apply(1, docs.withColumn("op", F.lit("put")))
    once = F.array_join(F.array_distinct(F.split("text", "\n")), "\n")
    revised = docs.withColumn("once", once).where("once != text").select("doc_id", "source", "lang", F.col("once").alias("text"), F.lit("put").alias("op"))
    rollup.apply(2, revised)
    hashed = docs.where("text is not null and doc_id is not null").select("doc_id", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit("text"), F.reverse("text")).alias("h2"))
    firsts = hashed.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first != last")
    copies = hashed.join(firsts, ["h1", "h2"]).where("doc_id != first").select("doc_id").distinct()
    empty = [F.lit(None).cast(docs.schema[c].dataType).alias(c) for c in ("source", "lang", "text")]
    rollup.apply(3, copies.select("doc_id", *empty, F.lit("delete").alias("op")))
    rollup.apply(2, revised)  # comes again, as after a lost acknowledgement: no effect
    return rollup


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roll_up(table(spark, sf_dir, "documents"), Scratch(spark, "tokencounts").path("rollup")).totals()
