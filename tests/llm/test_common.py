import time
from pathlib import Path

from pyspark.sql import functions as F

from sluice.llm.common import Scratch


def test_a_written_table_leaves_no_shuffle_files_for_long(spark):
    jvm = spark.sparkContext._jvm
    manager = jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = [Path(str(d)) for d in manager.localDirs()]

    def files():
        return {p.name for d in folders for p in d.rglob("shuffle_*.data")}

    before = files()
    scratch = Scratch(spark, "test-common")
    counts = spark.range(5000).groupBy((F.col("id") % 700).alias("k")).count()
    out = scratch.write(counts, "counts")
    first = files() - before
    # the driver may hold the last query, not those before it
    for _ in range(3):
        scratch.write(spark.range(1), "other")
    for _ in range(50):
        if not files() & first:
            break
        time.sleep(0.1)
    assert not files() & first
    assert out.count() == 700
