"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` stores the token postings of the training texts as segments:
a row holds the sorted terms of a run of documents, a list of positions for
each term, and the documents' places. ``search`` reads the segments back and
intersects the offset-adjusted lists of each query phrase, beginning with the
phrase's rarest term in that segment. Segments are independent, so neither
building nor searching shuffles a posting.

Queries go out in blocks of a bounded number of words; more words make more
blocks, whose results are put together per document.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, Words, gathered, slices, table

WINDOW = 13
SEGMENT_TEXTS = 1024
BLOCK_WORDS = 1_000_000
# A document is contaminated if at least this share of its words (1 in ...) is hit.
HIT_SHARE = 20

# Bytes of a word: digits, letters in lower case, and everything outside ASCII.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words of a text: A-Z in lower case, runs of digits, letters and characters outside ASCII."""
    return (text or "").encode().translate(_TABLE).split()


def build_index(docs: DataFrame, segment_texts: int = SEGMENT_TEXTS) -> DataFrame:
    """Segments of the positional index over ``doc_id`` and ``text``, one row each.

    ``doc_ids``, ``firsts`` and ``sizes`` name the documents, their first
    position and their word count. Term i of ``terms`` (joined by blanks, in
    order) has the positions from ``ends[i-1]`` to ``ends[i]`` of
    ``positions``. One position stays free between documents. A segment has
    at most ``segment_texts`` documents. Null texts have no words.
    """
    schema = T.StructType(
        [T.StructField("segment", T.LongType()), T.StructField("doc_ids", T.ArrayType(docs.schema["doc_id"].dataType))]
        + [T.StructField(c, T.BinaryType()) for c in ("firsts", "sizes", "terms", "ends", "positions")]
    )

    def build(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        segment = TaskContext.get().partitionId() << 32
        for batch in slices(batches, segment_texts):
            words = Words(batch.column(1), _TABLE)
            sizes, names = words.sizes, words.names
            firsts = np.cumsum(sizes + 1) - sizes - 1
            positions = gathered(firsts, sizes)
            by_name = sorted(range(len(names)), key=names.__getitem__)
            rank = np.empty(len(names), np.int64)
            rank[by_name] = np.arange(len(names))
            ranked = rank[words.index]
            order = np.argsort(ranked, kind="stable")
            ends = np.cumsum(np.bincount(ranked, minlength=len(names)))
            row = [
                [segment],
                [batch.column(0).to_pylist()],
                [firsts.tobytes()],
                [sizes.tobytes()],
                [b" ".join(names[i] for i in by_name)],
                [ends.astype(np.int64).tobytes()],
                [positions[order].astype(np.int32 if sizes.sum() < 1 << 30 else np.int64).tobytes()],
            ]
            segment += 1
            kinds = [pa.int64(), pa.list_(batch.schema.field(0).type), *[pa.binary()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(build, schema)


class Segment:
    """One row of the index, opened for intersecting."""

    def __init__(self, row: dict):
        import numpy as np

        self.doc_ids = row["doc_ids"]
        self.firsts, self.sizes, self.ends = (np.frombuffer(row[c], np.int64) for c in ("firsts", "sizes", "ends"))
        n = int(self.sizes.sum())
        self.positions = np.frombuffer(row["positions"], np.int32 if len(row["positions"]) == 4 * n else np.int64).astype(np.int64)
        self.rank = {t: i for i, t in enumerate(row["terms"].split())}
        self.starts = np.concatenate([[0], self.ends[:-1]]) if len(self.ends) else self.ends
        self.lengths = self.ends - self.starts
        # term * span + position: ascending over the whole of the lists, so one search tests any term's list
        self.span = n + len(self.sizes) + 1
        self.keys = np.repeat(np.arange(len(self.ends)), self.lengths) * self.span + self.positions

    def has(self, terms, positions):
        """Whether each term's list has the position beside it."""
        import numpy as np

        wanted = terms * self.span + positions
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return (positions >= 0) & (self.keys[at] == wanted)

    def lists(self, terms):
        """(index into ``terms``, position) for every posting of every term."""
        import numpy as np

        lengths = self.lengths[terms]
        which = np.repeat(np.arange(len(terms)), lengths)
        inner = np.arange(len(which)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        return which, self.positions[np.repeat(self.starts[terms], lengths) + inner]

    def phrases(self, terms):
        """(row of ``terms``, first position) of every exact occurrence; a row is a phrase of term ranks."""
        import numpy as np

        rows = np.arange(len(terms))
        order = np.argsort(self.lengths[terms], axis=1, kind="stable")
        which, at = self.lists(terms[rows, order[:, 0]])
        at = at - order[which, 0]
        for k in range(1, terms.shape[1]):
            offset = order[which, k]
            keep = self.has(terms[which, offset], at + offset)
            which, at = which[keep], at[keep]
        return which, at

    def near(self, terms, reach: int):
        """(row of ``terms``, position of its rarest term) where all its terms lie within ``reach`` positions of it.

        Positions of other documents never count: the test stays between the document's first and last word.
        """
        import numpy as np

        rows = np.arange(len(terms))
        order = np.argsort(self.lengths[terms], axis=1, kind="stable")
        which, at = self.lists(terms[rows, order[:, 0]])
        doc = np.searchsorted(self.firsts, at, side="right") - 1
        low = np.maximum(at - reach, self.firsts[doc])
        high = np.minimum(at + reach, self.firsts[doc] + self.sizes[doc] - 1)
        for k in range(1, terms.shape[1]):
            term = terms[which, order[which, k]] * self.span
            keep = np.searchsorted(self.keys, term + high, side="right") > np.searchsorted(self.keys, term + low)
            which, at, low, high = which[keep], at[keep], low[keep], high[keep]
        return which, at


def query_windows(items: list[tuple[str, list[bytes]]], window: int) -> dict[int, tuple[list, list]]:
    """By length: the distinct windows (terms), and for each the numbers of the items that have it."""
    found: dict[int, dict[tuple, set[int]]] = {}
    for i, (_, words) in enumerate(items):
        length = min(window, len(words))
        for at in range(len(words) - length + 1 if words else 0):
            found.setdefault(length, {}).setdefault(tuple(words[at : at + length]), set()).add(i)
    return {n: (list(w), [sorted(x) for x in w.values()]) for n, w in found.items()}


def search(index: DataFrame, items: list[tuple[str, list[bytes]]], window: int = WINDOW, reach: int | None = None) -> DataFrame:
    """One row per indexed document: doc_id, row (its key), n_words, hits (positions) and items (identities).

    Without ``reach`` a document word inside an exact occurrence of any window
    of an item is hit. With ``reach`` a match is a place of a window's rarest
    term that has all the window's other terms within ``reach`` words, in any
    order, and only that place is hit.
    """
    id_type = index.schema["doc_ids"].dataType.elementType
    schema = T.StructType(
        [T.StructField("row", T.StringType()), T.StructField("doc_id", id_type), T.StructField("n_words", T.LongType())]
        + [T.StructField("hits", T.ArrayType(T.IntegerType())), T.StructField("items", T.ArrayType(T.StringType()))]
    )
    sent = index.sparkSession.sparkContext.broadcast(([i for i, _ in items], query_windows(items, window)))

    def find(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        names, windows = sent.value
        for batch in batches:
            for row in batch.to_pylist():
                segment = Segment(row)
                hits: dict[int, set[int]] = {}
                owners: dict[int, set[int]] = {}
                for length, (terms, having) in windows.items():
                    ranks = [[segment.rank.get(t, -1) for t in w] for w in terms]
                    ranks = np.array(ranks, np.int64).reshape(-1, length)
                    present = np.flatnonzero((ranks >= 0).all(axis=1))
                    if not len(present):
                        continue
                    ranks = ranks[present]
                    which, at = segment.phrases(ranks) if reach is None else segment.near(ranks, reach)
                    doc = np.searchsorted(segment.firsts, at, side="right") - 1
                    for d, p, w in zip(doc.tolist(), (at - segment.firsts[doc]).tolist(), present[which].tolist(), strict=True):
                        hits.setdefault(d, set()).update(range(p, p + length) if reach is None else [p])
                        owners.setdefault(d, set()).update(having[w])
                n = len(segment.doc_ids)
                arrays = [
                    pa.array([f"{row['segment']}:{d}" for d in range(n)], pa.string()),
                    pa.array(segment.doc_ids, batch.schema.field("doc_ids").type.value_type),
                    pa.array(segment.sizes, pa.int64()),
                    pa.array([sorted(hits.get(d, ())) for d in range(n)], pa.list_(pa.int32())),
                    pa.array([[names[i] for i in sorted(owners.get(d, ())) if names[i] is not None] for d in range(n)], pa.list_(pa.string())),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return index.mapInArrow(find, schema)


def item_blocks(benchmark: DataFrame, most_words: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """The items with words, read in blocks that hold about ``most_words`` words each (an item is never split)."""
    texts = benchmark.where("text is not null").select(F.col("item_id").cast("string").alias("item_id"), "text")
    chars = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = chars // (2 * most_words) + 1  # a word and its separator have two bytes at least
    for block in range(n):
        rows = texts.where(F.pmod(F.xxhash64("text"), F.lit(n)) == block).collect()
        items = [(r.item_id, words_of(r.text)) for r in rows]
        if found := [x for x in items if x[1]]:
            yield found


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, segment_texts: int = SEGMENT_TEXTS, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Null or empty texts have no words and are never contaminated; items with
    a null text are left out. What an item without an id holds is hit, but the
    item is neither counted nor named. Rows of a repeated item_id count as one
    item with the windows of all its rows. Repeated documents are judged one
    by one. An empty benchmark hits nothing; empty documents give no rows.
    Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "decontam")
    index = scratch.write(build_index(docs, segment_texts), "segments")
    parts: list[DataFrame] = []
    held = None
    for items in item_blocks(benchmark, block_words):
        # a block's result is written before the next one is read, so one block is held at a time
        if held is not None:
            parts.append(scratch.write(search(index, held, window), "block"))
        held = items
    last = search(index, held or [], window)
    found = scratch.write(last, "block") if parts else last
    if parts:
        for part in parts:
            found = found.unionByName(part)
        found = found.groupBy("row").agg(
            F.any_value("doc_id").alias("doc_id"),
            F.max("n_words").alias("n_words"),
            F.flatten(F.collect_list("hits")).alias("hits"),
            F.flatten(F.collect_list("items")).alias("items"),
        )
    n_hit = F.size(F.array_distinct("hits")).cast("long")
    items = F.array_distinct("items")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.encode(F.array_join(F.array_sort(items), ","), "utf-8"), 256).alias("items_sha256"),
        ((n_hit > 0) & (HIT_SHARE * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(lower_ascii, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii FROM documents)
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(lower_ascii, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii FROM benchmark WHERE text IS NOT NULL)
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[p : p + least(len(w), 13) - 1], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS p FROM b WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT n FROM windows
), places AS (
  SELECT doc_id, n, p, array_to_string(w[p : p + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, lengths WHERE len(w) >= n)
), found AS (SELECT doc_id, item_id, n, p FROM places JOIN windows USING (n, phrase)
), hit AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(item_id) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS joined
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(joined, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
