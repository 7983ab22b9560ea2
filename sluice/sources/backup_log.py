"""Read legacy backup logs and recover the encoded payload of each ``data:`` line.

A line qualifies only if it is, in full, an optional ``yyyy/MM/dd HH:mm:ss``
prefix, ``data: [``, decimal bytes separated by blanks, and ``]``. A
``record:`` line whose text merely contains ``data:`` does not. The retry
generation comes from the file name: ``backup.log`` is attempt 0,
``backup.log.N`` attempt N+1, null if N is no 32-bit number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.bytelist import list_text_is_valid, list_text_numbers, numbers_to_bytes
from sluice.functions.forms import materialize

DATA_LINE = r"^(?:[0-9]{4}/[0-9]{2}/[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2} )?data: \[([0-9 ]*)\]$"
GENERATION = r"backup\.log(?:\.([0-9]+))?(?:/|$)"


def parse_backup_lines(lines: DataFrame, value: str = "value", path: str | None = "file_path") -> DataFrame:
    """Keep qualifying lines; add ``data`` (bytes, null if a number is out of range) and ``attempt``."""
    v = F.col(value)
    # cheap substring test first: most lines of a log are error/record lines
    df = lines.filter((F.instr(v, "data: [") > 0) & v.rlike(DATA_LINE))
    df = materialize(df, {"_inner": F.regexp_extract(v, DATA_LINE, 1)})
    df = materialize(df, {"_nums": list_text_numbers(F.col("_inner"))})
    ok = list_text_is_valid(F.col("_inner"), F.col("_nums"))
    df = materialize(df, {"bytes_ok": ok})
    df = df.withColumn("data", F.when(F.col("bytes_ok"), numbers_to_bytes(F.col("_nums")))).drop("_inner", "_nums")
    cols = {}
    if path:
        gen = F.regexp_extract(F.col(path), GENERATION, 1)
        cols["attempt"] = F.when(gen == "", F.lit(0)).otherwise(gen.try_cast("int") + 1)
    return df.withColumns(cols)


def read_backup_log(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Backup log text files -> qualifying ``data:`` lines with payload bytes and attempt."""
    raw = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file_path"))
    return parse_backup_lines(raw)
