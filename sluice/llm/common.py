"""Small helpers that the operators share: reading, staging in the shared folder, checked broadcasts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# White space of the word patterns: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"\x20\x09-\x0D"
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Written intermediate tables of one operator run, in the session's shared folder.

    A written table cuts the lineage, survives a lost executor and fixes what
    a task decided once (row keys, ranks). What its query left in the driver's
    heap and on the executors' disks is let go at once, as operators write
    dozens of tables. ``drop`` removes the tables that the returned DataFrame
    no longer reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = scratch_path(spark, name)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        free_shuffles(self.spark)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.written_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            remove(self.spark, t.written_path)


def remove(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def free_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of queries that are done, which it does once their plans are collected, and keeps the driver's heap small."""
    spark.sparkContext._jvm.System.gc()


def small_or_shuffled(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``most`` rows; else as it is, to be joined by a shuffle."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


# Texts that a task splits into words at a time.
TEXTS_AT_ONCE = 512


def slices(batches, rows: int = TEXTS_AT_ONCE):
    """Arrow batches cut to at most ``rows`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


# What becomes of each byte of a text: A-Z in lower case, white space a blank, all else as it is.
PLAIN = bytes(32 if b in b" \t\n\v\f\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))


class Words:
    """Words of a run of texts, as numbers of the run's distinct words.

    ``names`` are the distinct words in UTF-8, ``index`` the word numbers of
    all texts in order, ``sizes`` the number of words of each text.
    """

    def __init__(self, texts, table: bytes = PLAIN):
        """``texts``: an Arrow array of strings; nulls are empty. ``table`` maps each byte, and what it maps to a blank parts words."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        filled = pc.fill_null(texts.cast(pa.large_string()), "")
        bounds = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
        data = np.frombuffer(filled.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        data = np.frombuffer(table, np.uint8)[data]
        inside = data != 32
        edge = np.zeros(len(data) + 1, bool)
        edge[bounds] = True
        before = np.concatenate([[False], inside[:-1]]) & ~edge[:-1] if len(data) else inside
        after = np.concatenate([inside[1:], [False]]) & ~edge[1:] if len(data) else inside
        starts = np.flatnonzero(inside & ~before)
        n = len(starts)
        # words and the gaps between them alternate over the same bytes
        cuts = np.empty(2 * n, np.int64)
        cuts[::2], cuts[1::2] = starts, np.flatnonzero(inside & ~after) + 1
        if n:
            both = pa.LargeBinaryArray.from_buffers(pa.large_binary(), 2 * n - 1, [None, pa.py_buffer(cuts), pa.py_buffer(data)])
            coded = both.take(pa.array(np.arange(0, 2 * n - 1, 2))).dictionary_encode()
            self.names = coded.dictionary.to_pylist()
            self.index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        else:
            self.names, self.index = [], np.zeros(0, np.int64)
        self.sizes = np.diff(np.searchsorted(starts, bounds)).astype(np.int64)

    @property
    def ends(self):
        import numpy as np

        return np.cumsum(self.sizes)


def gathered(starts, lengths):
    """Places start, start + 1, ... of every run of ``lengths`` cells, run after run."""
    import numpy as np

    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - before, lengths)
