"""A training corpus from ``documents``: quality rules, line dedup, near-dedup, decontamination, packing.

Each stage takes what the one before it kept, written as Parquet and read
again. All but the last return the columns of ``documents``; the last returns
the packed pieces. Stages leave other columns alone. Rows that repeat both
doc_id and text are one document and are treated alike; rows that repeat a
doc_id with another text are documents of their own. Null and empty texts go
with the quality rules. Empty tables pass through as empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import decontam, linededup, neardup, packing, quality
from sluice.llm.common import SPACE, Scratch, small_or_shuffled, table


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with doc_id and a hash of the text as its doc_id, so that the operators judge documents and not ids."""
    return docs.withColumn("doc_id", F.struct("doc_id", F.xxhash64("text").alias("text_hash")))


def without(docs: DataFrame, gone: DataFrame, name: str) -> DataFrame:
    """``docs`` less the documents in ``gone``, whose doc_id is a key of ``keyed``."""
    ids = gone.select(F.col("doc_id.doc_id").alias("gone_id"), F.col("doc_id.text_hash").alias("gone_hash"))
    written = Scratch(docs.sparkSession, name).write(ids, "gone")
    # the other columns travel in one, so that their names can't clash
    whole = docs.select(F.struct(*docs.columns).alias("whole"))
    same = F.col("whole.doc_id").eqNullSafe(F.col("gone_id")) & (F.xxhash64("whole.text") == F.col("gone_hash"))
    return whole.join(small_or_shuffled(written), same, "left_anti").select("whole.*")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return without(docs, quality.judge(keyed(docs)).where(~F.col("kept")), "pipeline-quality")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without copied and nearly copied lines; one that loses its last line with a word goes. n_chars follows."""
    lost = F.size("exact") + F.size("near") > 0
    # the other columns travel in one, so that their names can't clash
    keyed = docs.select("doc_id", "text", F.struct(*docs.columns).alias("whole"))
    less = linededup.dedup_lines(keyed).where(~lost | F.coalesce(F.col("text").rlike(f"[^{SPACE}]"), F.lit(False)))
    columns = {c: F.col("whole")[c] for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(lost, F.length("text")).otherwise(columns["n_chars"]).cast(docs.schema["n_chars"].dataType)
    return less.select(*[c.alias(n) for n, c in columns.items()])


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of near copies: 80 of 100 five-word shingles shared.

    32 bands: a pair at that similarity shares no band with probability below 4e-6.
    """
    return without(docs, neardup.group_documents(keyed(docs), percent=80, bands=32).where(~F.col("kept")), "pipeline-neardup")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by ``benchmark``."""
    judged = decontam.decontaminate(keyed(docs), table(spark, sf_dir, "benchmark"))
    return without(docs, judged.where("contaminated"), "pipeline-decontam")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their sequences and places."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", minhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

# The packing's tokenizer cannot be expressed in SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the packed pieces."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, sf_dir), f"stage{at}")
    return docs
