"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

Two permutations make every signature coordinate: the first scatters the
shingle hashes over 2**32 places, the second, circularly shifted by k, orders
them for coordinate k. Equal bands are only candidates; each link is
confirmed on the full shingle sets.

Texts with equal sets form one class from the start. Within a bucket the
classes are first compared with its most central member alone; only pairs that
this leaves in different components are compared next, so a bucket of m copies
of one text costs m comparisons and not m squared, and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, Words, slices, small_or_shuffled, table
from .graph import components

WORDS = 5
LINK_PERCENT = 85
# 24 bands of 5 rows: a pair at the threshold shares no band with probability below 1e-6.
BANDS, ROWS = 24, 5


def shingle_hashes(texts, words: int = WORDS) -> list:
    """For each text of an Arrow array its shingles' 64-bit hashes, sorted and distinct."""
    import numpy as np
    import xxhash

    split = Words(texts)
    names = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in split.names), np.uint64, len(split.names))
    hashes = names[split.index]
    factor = np.uint64(0x9E3779B97F4A7C15)
    out, end = [], 0
    for n in split.sizes.tolist():
        part, end = hashes[end : end + n], end + n
        length = min(n, words)
        found = np.full(n - length + 1 if n else 0, length, np.uint64)
        for i in range(length):
            found *= factor
            found += part[i : n - length + 1 + i]
            found ^= found >> np.uint64(29)
        out.append(np.unique(found))
    return out


def signer(bands: int = BANDS, rows: int = ROWS, block: int = 256):
    """A function shingle hashes -> one 64-bit key for each band of the circulant signature."""
    import numpy as np

    u32 = np.uint32
    shifts = np.arange(bands * rows, dtype=u32)[:, None]
    tags = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)

    def permute(x, first: int, second: int):
        x ^= x >> u32(16)
        x *= u32(first)
        x ^= x >> u32(15)
        x *= u32(second)
        return x

    def bands_of(hashes):
        places = (hashes ^ (hashes >> np.uint64(32))).astype(u32)
        places = permute(places, 0x21F0AAAD, 0x735A2D97)
        places ^= places >> u32(15)
        low = np.full(bands * rows, 0xFFFFFFFF, u32)
        for at in range(0, len(places), block):
            values = permute(places[None, at : at + block] + shifts, 0x7FEB352D, 0x846CA68B)
            np.minimum(low, values.min(axis=1), out=low)
        keys = tags.copy()
        for r in range(rows):
            keys = (keys ^ low.reshape(bands, rows)[:, r]) * np.uint64(0x9E3779B97F4A7C15)
            keys ^= keys >> np.uint64(32)
        return keys.view(np.int64)

    return bands_of


def digest_of(hashes) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(hashes.tobytes())


def signatures(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """Row key, doc_id, set size, set digest (null for an empty set or a null doc_id) and band keys."""
    schema = T.StructType(
        [
            T.StructField("row_key", T.LongType()),
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("digest", T.BinaryType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )

    def sign(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        bands_of = signer(bands, rows)
        key = TaskContext.get().partitionId() << 36
        for batch in slices(batches):
            keys, sizes, digests, signed = [], [], [], []
            for doc_id, hashes in zip(batch.column(0), shingle_hashes(batch.column(1), words), strict=True):
                use = len(hashes) and doc_id.is_valid
                keys.append(key)
                sizes.append(len(hashes))
                digests.append(digest_of(hashes) if use else None)
                signed.append(bands_of(hashes) if use else None)
                key += 1
            arrays = [pa.array(keys, pa.int64()), batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(signed, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(sign, schema)


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """Digest and full set (sorted 64-bit hashes as bytes) of each document."""

    def sets(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in slices(batches):
            found = shingle_hashes(batch.column(0), words)
            yield pa.RecordBatch.from_arrays(
                [pa.array([digest_of(x) for x in found], pa.binary()), pa.array([x.tobytes() for x in found], pa.binary())],
                names=["digest", "hashes"],
            )

    return docs.select("text").mapInArrow(sets, "digest binary, hashes binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""

    def confirm(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(both) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with_b = pairs.join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("y")), "b")
    with_both = with_b.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("x")), "a")
    return with_both.select("a", "b", "x", "y").mapInArrow(confirm, "a long, b long")


def close_sizes(n, m, percent: int):
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def group_documents(
    docs: DataFrame, words: int = WORDS, percent: int = LINK_PERCENT, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    A null or text without words has no shingles and is linked with nothing.
    A row with a null doc_id is linked with nothing either: component_id null
    and kept true. Repeated rows share a component and are all kept or not,
    as their doc_id says; rows that repeat a doc_id with another text count as
    documents of their own. Columns besides doc_id and text are ignored; an
    empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "neardup")
    signed = scratch.write(signatures(docs, words, bands, rows), "signed")
    classes = scratch.write(
        signed.where(F.col("digest").isNotNull())
        .groupBy("digest")
        .agg(
            F.min("row_key").alias("node"),
            F.min("doc_id").alias("first_id"),
            F.count(F.lit(1)).alias("copies"),
            F.min("n_shingles").alias("n"),
            F.min_by("bands", "row_key").alias("bands"),
        ),
        "classes",
    )
    entries = classes.select(F.explode("bands").alias("bucket"), "node", "n")
    sizes = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    members = scratch.write(entries.join(sizes, "bucket"), "members")
    links = linked_nodes(docs, classes, members, scratch, words, percent)

    grouped = classes.join(links, "node", "left")
    firsts = grouped.where("root is not null").groupBy("root").agg(F.min("first_id").alias("group_id"))
    found = grouped.join(firsts, "root", "left").select("digest", "copies", F.coalesce("group_id", "first_id").alias("component_id"), F.col("group_id").isNotNull().alias("linked"))
    named = scratch.write(found.where("copies > 1 or linked").select("digest", "component_id"), "named")
    out = signed.join(named, "digest", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def linked_nodes(docs: DataFrame, classes: DataFrame, members: DataFrame, scratch: Scratch, words: int, percent: int) -> DataFrame:
    """(node, root) of the classes that share a confirmed link with another class."""
    used = members.select("node").distinct()
    picked = classes.join(used, "node", "left_semi").select("node", "digest", "first_id")
    ids = scratch.write(picked, "used")
    texts = docs.join(small_or_shuffled(ids.select(F.col("first_id").alias("doc_id"))), "doc_id", "left_semi")
    sets = scratch.write(
        shingle_sets(texts, words)
        .join(small_or_shuffled(ids.select("digest", "node")), "digest")
        .groupBy("node")
        .agg(F.min("hashes").alias("hashes")),
        "sets",
    )
    # The text that others were copied from shares buckets with most of them: compare each bucket with that member first.
    weights = members.groupBy("node").agg(F.sum("m").alias("weight"))
    members = scratch.write(members.join(weights, "node").select("bucket", "node", "n", "weight"), "weighed")
    tried = scratch.write(star_pairs(members, percent), "pairs")
    links = scratch.write(confirmed(tried, sets, percent), "links")
    roots = scratch.write(components(links, scratch), "roots")

    # The rest: pairs of one bucket that are still in different components and not compared yet. Shingles that no other
    # open member has cannot be common, which bounds a pair's intersection and rules out most pairs of loose copies.
    rooted = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = rooted.groupBy("bucket").agg(F.min("root").alias("r"), F.max("root").alias("s")).where("r != s").select("bucket")
    open_ = rooted.join(mixed, "bucket", "left_semi").select("bucket", "node", "n", "root")
    open_ = scratch.write(open_, "open")
    alone = single_shingles(sets.join(open_.select("node").distinct(), "node", "left_semi"))
    bound = open_.join(scratch.write(alone, "alone"), "node", "left").withColumn("most", F.col("n") - F.coalesce("alone", F.lit(0)))
    bound = bound.join(open_.groupBy("node").agg(F.collect_list("bucket").alias("all")), "node")

    def side(name: str) -> DataFrame:
        return bound.select("bucket", *[F.col(c).alias(f"{name}_{c}") for c in ("node", "n", "root", "most", "all")])

    # a pair is formed in the least of the buckets that it shares
    here = F.col("bucket") == F.array_min(F.array_intersect("a_all", "b_all"))
    possible = (100 + percent) * F.least("a_most", "b_most") >= percent * (F.col("a_n") + F.col("b_n"))
    rest = (
        side("a")
        .join(side("b"), "bucket")
        .where((F.col("a_node") < F.col("b_node")) & (F.col("a_root") != F.col("b_root")) & possible & here)
        .select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
        .join(tried, ["a", "b"], "left_anti")
    )
    rest = scratch.write(rest, "rest")
    more = scratch.write(confirmed(rest, sets, percent), "more")
    out = scratch.write(components(links.union(more), scratch), "roots")
    scratch.drop(sets, open_, members)
    return out


def single_shingles(sets: DataFrame) -> DataFrame:
    """(node, alone): how many shingles of each set are in no other of these sets, if any."""

    def unpack(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in slices(batches, 64):
            found = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(1)]
            nodes = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), [len(x) for x in found])
            hashes = np.concatenate(found) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(hashes)], names=["node", "hash"])

    rows = sets.select("node", "hashes").mapInArrow(unpack, "node long, hash long")
    once = rows.groupBy("hash").agg(F.min("node").alias("node"), F.count(F.lit(1)).alias("c")).where("c = 1")
    return once.groupBy("node").agg(F.count(F.lit(1)).alias("alone"))


def star_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of each bucket's heaviest member, the first of equals, and its other members of a close size."""
    best = F.struct("weight", (-F.col("node")).alias("less"), "n")
    centers = members.groupBy("bucket").agg(F.max(best).alias("c"))
    both = members.join(centers.select("bucket", (-F.col("c.less")).alias("center"), F.col("c.n").alias("cn")), "bucket")
    apart = both.where((F.col("node") != F.col("center")) & close_sizes(F.col("n"), F.col("cn"), percent))
    return apart.select(F.least("node", "center").alias("a"), F.greatest("node", "center").alias("b")).distinct()


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_documents(table(spark, sf_dir, "documents"))


OP10_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[p : p + least(len(w), 5) - 1], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS p FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (shingle) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN n AS na ON na.doc_id = a JOIN n AS nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least_id AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN least_id USING (doc_id)
"""
