"""Source divergence audit: how each source's word use differs within its language.

Every (lang, source) group and every language gives each kept term a smoothed
share in billionths, ``1 + floor(1e9 * (count + 5) / (N + 5 V))``, in exact
arithmetic. Two reports come of it:

* ``pair``: for each group every other source of the language, by the sum of
  the absolute differences of their shares over all kept terms;
* ``term``: for each group the terms whose share is above the language's, by
  the difference, to rank 50.

The term report is found by a dominance skyband. A group's difference never
falls as the group's count rises or as the language's count falls, and ties go
to the earlier term in UTF-8. So a term that ``k`` others dominate in all three
is not among the first ``k``. Each partition keeps the terms that fewer than
``k`` others of it dominate, the skybands are merged by group, and only what is
left is ranked exactly. A term of the whole skyband is in its partition's, so
the result doesn't depend on the partitions.

Defined results: null text, lang and source count as ''. A group without terms
is a group with count 0 of every term. A language without kept terms has pairs
of value 0 and no term rows. Repeated rows are documents of their own. An empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, Words, slices, table

MIN_DOCS = 30
RANKS = 50
SMOOTHING = 5
BILLION = 1_000_000_000
# ASCII letters in lower case and all beyond ASCII make terms; everything else parts them.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))
# Partial counts that a task holds before it passes them on.
HELD_ROWS = 300_000
# Sizes of one task's share of a comparison: terms of a bucket, sources of a block.
BUCKET_TERMS, BLOCK_SOURCES = 2048, 256
# Rows of one merge task, and rows compared with a skyband at a time.
MERGED_ROWS, COMPARED_ROWS = 20_000, 1024
# Rows from which a partition reduces what it holds to skybands.
BAND_ROWS = 40_000


def count_terms(docs: DataFrame) -> DataFrame:
    """Counts of each term by lang and source: n occurrences in n_docs documents. Term '' (both 0) marks the group itself."""

    def count(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        keys = ["lang", "source", "term"]

        def merged(parts: list):
            sums = pa.concat_tables(parts).group_by(keys).aggregate([("n", "sum"), ("n_docs", "sum")])
            return sums.select([*keys, "n_sum", "n_docs_sum"]).rename_columns([*keys, "n", "n_docs"])

        def rows(held):
            yield from held.combine_chunks().to_batches(max_chunksize=50_000)

        parts, n_rows = [], 0
        for batch in slices(batches):
            lang, source = (pc.fill_null(batch.column(k), "").dictionary_encode() for k in (1, 2))
            n_sources = max(1, len(source.dictionary))
            of_doc = lang.indices.to_numpy().astype(np.int64) * n_sources + source.indices.to_numpy()
            words = Words(batch.column(0), TERM_BYTES)
            n_words = max(1, len(words.names))
            # occurrences in each document, then in each group
            in_doc, n = np.unique(np.repeat(np.arange(len(of_doc)), words.sizes) * n_words + words.index, return_counts=True)
            cell = of_doc[in_doc // n_words] * n_words + in_doc % n_words
            cells, at = np.unique(cell, return_inverse=True)
            total, docs_with = (np.bincount(at, w, len(cells)).astype(np.int64) for w in (n, None))
            marks = np.unique(of_doc)
            group = np.concatenate([cells // n_words, marks])
            names = pa.array([*words.names, b""], pa.binary()).cast(pa.string())
            term = names.take(pa.array(np.concatenate([cells % n_words, np.full(len(marks), len(words.names))])))
            none = np.zeros(len(marks), np.int64)
            parts.append(
                pa.table(
                    {
                        "lang": lang.dictionary.take(pa.array(group // n_sources)),
                        "source": source.dictionary.take(pa.array(group % n_sources)),
                        "term": term,
                        "n": np.concatenate([total, none]),
                        "n_docs": np.concatenate([docs_with, none]),
                    }
                )
            )
            n_rows += len(group)
            if n_rows > HELD_ROWS:
                parts = [merged(parts)]
                n_rows = parts[0].num_rows
                if n_rows > HELD_ROWS // 2:
                    yield from rows(parts[0])
                    parts, n_rows = [], 0
        if parts:
            yield from rows(merged(parts))

    read = docs.select(F.col("text").cast("string"), F.col("lang").cast("string"), F.col("source").cast("string"))
    partial = read.mapInArrow(count, "lang string, source string, term string, n long, n_docs long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """Smoothed share in billionths; null without terms."""
    exact = [c.cast("decimal(20,0)") for c in (count + SMOOTHING, total + SMOOTHING * terms)]
    billionths = F.lit(BILLION).cast("decimal(10,0)") * exact[0]
    # the remainder is taken off first, so the division leaves nothing to round
    return F.when(terms > 0, (1 + (billionths - billionths % exact[1]) / exact[1]).cast("long"))


def kept_below(n: list, lang_n: list, term: list, k: int):
    """Places of the rows that fewer than ``k`` others dominate, in any order.

    A row dominates another by a count at least as high, a language count at
    most as high, and an earlier term. Sorted that way, dominators come first;
    and who has ``k`` dominators has ``k`` within the skyband, so each block is
    compared with the skyband before it and with itself.
    """
    import numpy as np

    n, lang_n = np.asarray(n, np.int64), np.asarray(lang_n, np.int64)
    spelt = np.asarray([t.encode() for t in term], object)
    place = np.empty(len(n), np.int64)
    place[np.argsort(spelt, kind="stable")] = np.arange(len(n))
    order = np.lexsort((place, lang_n, -n))
    count, least, name = n[order], lang_n[order], place[order]
    band = np.zeros(0, np.int64)
    for start in range(0, len(order), COMPARED_ROWS):
        block = np.arange(start, min(start + COMPARED_ROWS, len(order)))
        found = np.zeros(len(block), np.int64)
        for at in range(0, len(band) + 1, COMPARED_ROWS):
            some = band[at : at + COMPARED_ROWS]
            live = np.flatnonzero(found < k)
            if not len(live) or not len(some):
                break
            rows = block[live, None]
            found[live] += ((count[some] >= count[rows]) & (least[some] <= least[rows]) & (name[some] < name[rows])).sum(1)
        live = np.flatnonzero(found < k)
        rows, others = block[live, None], block[None, :]
        found[live] += ((count[others] >= count[rows]) & (least[others] <= least[rows]) & (name[others] < name[rows])).sum(1)
        band = np.concatenate([band, block[found < k]])
    return order[band]


def partition_skybands(rows: DataFrame, k: int = RANKS) -> DataFrame:
    """The rows (lang, source, term, n, lang_n, value) of each partition that fewer than ``k`` others of their group in it dominate."""

    def keep(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def bands(parts: list):
            import pandas as pd

            frame = pa.Table.from_batches(parts).to_pandas()
            places = frame.groupby(["lang", "source"], sort=False).indices.values()
            left = [f.iloc[kept_below(f.n, f.lang_n, list(f.term), k)] for f in map(frame.iloc.__getitem__, places)]
            return pa.RecordBatch.from_pandas(pd.concat(left), parts[0].schema, preserve_index=False)

        held, n_rows = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n_rows += batch.num_rows
            if n_rows > BAND_ROWS:
                held = [bands(held)]
                n_rows = held[0].num_rows
                if n_rows > BAND_ROWS // 2:
                    yield held[0]
                    held, n_rows = [], 0
        if held:
            yield bands(held)

    return rows.mapInArrow(keep, rows.schema)


def merge_skybands(bands: DataFrame, k: int = RANKS) -> DataFrame:
    """One skyband of each group; a group of over MERGED_ROWS rows is merged in shares, whose union holds it."""

    def merge(frame):
        return frame.iloc[kept_below(frame.n, frame.lang_n, list(frame.term), k)]

    shares = bands.groupBy("lang", "source").agg(F.ceil(F.count(F.lit(1)) / MERGED_ROWS).alias("n_shares"))
    dealt = bands.join(shares, ["lang", "source"]).withColumn("share", F.pmod(F.xxhash64("term"), "n_shares"))
    return dealt.select(*bands.columns, "share").groupBy("lang", "source", "share").applyInPandas(merge, dealt.select(*bands.columns, "share").schema).drop("share")


def compare_sources(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Lang, source, item and value of every ordered pair of sources of a language.

    ``rows``: lang, source, term, p; ``groups``: lang, source, n_terms, p0 (the
    share of an absent term). Terms are dealt out in buckets, the sources in
    blocks; a task compares two blocks over one bucket and passes on sums.
    """
    sizes = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("n_sources"), F.max("n_terms").alias("n_terms"))
    sizes = sizes.select("lang", F.ceil(F.col("n_sources") / BLOCK_SOURCES).alias("n_blocks"), F.greatest(F.lit(1), F.ceil(F.col("n_terms") / BUCKET_TERMS)).alias("n_buckets"))
    block = F.pmod(F.xxhash64("source"), "n_blocks").alias("block")
    bucket = F.pmod(F.xxhash64("term"), "n_buckets").alias("bucket")
    sized = rows.join(sizes, "lang").select("lang", "source", "term", "p", block, bucket, "n_blocks")
    in_bucket = sized.groupBy("lang", "bucket").agg(F.countDistinct("term").alias("bucket_terms"))

    def facing(df: DataFrame, *cols: str) -> DataFrame:
        """Each row once for every pair of blocks that holds its own."""
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)).alias("other")
        df = df.select("*", other)
        return df.select("lang", "bucket", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block", *cols)

    all_buckets = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_buckets") - 1)).alias("bucket")
    each = groups.join(sizes.drop("n_terms"), "lang").select("lang", "source", "p0", block, "n_blocks", all_buckets)
    each = each.join(in_bucket, ["lang", "bucket"], "left").na.fill(0, ["bucket_terms"])

    def differences(key, shares, sources):
        import numpy as np
        import pandas as pd

        place = {s: i for i, s in enumerate(sources.source)}
        zero = sources.p0.fillna(0).to_numpy(np.int64)
        at, terms = pd.factorize(shares.term)
        cells = np.broadcast_to(zero, (len(terms), len(zero))).copy()
        if len(shares):
            cells[at, shares.source.map(place).to_numpy(np.int64)] = shares.p.to_numpy(np.int64)
        # terms of the bucket that no source here has
        absent = int(sources.bucket_terms.max()) - len(terms)
        blocks, names, found = sources.block.to_numpy(), sources.source.to_numpy(object), []
        one, two = key[2], key[3]
        for i in np.flatnonzero(blocks == one):
            value = np.abs(cells - cells[:, i : i + 1]).sum(0) + absent * np.abs(zero - zero[i])
            partners = np.flatnonzero(blocks == two)
            partners = partners[partners != i]
            found.append(pd.DataFrame({"lang": key[0], "source": names[i], "item": names[partners], "value": value[partners]}))
            if one != two:
                found.append(pd.DataFrame({"lang": key[0], "source": names[partners], "item": names[i], "value": value[partners]}))
        return pd.concat(found) if found else pd.DataFrame({"lang": [], "source": [], "item": [], "value": []})

    keys = ["lang", "bucket", "one", "two"]
    left, right = facing(sized, "source", "term", "p"), facing(each, "source", "p0", "bucket_terms")
    sums = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(differences, "lang string, source string, item string, value long")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit_sources(docs: DataFrame, min_docs: int = MIN_DOCS, ranks: int = RANKS) -> DataFrame:
    """Lang, source, part (``pair`` or ``term``), item, value and rank; see the module's text."""
    scratch = Scratch(docs.sparkSession, "divergence")
    counts = scratch.write(count_terms(docs), "counts")
    words = counts.where("term <> ''")
    kept = words.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("n_docs").alias("lang_docs")).where(F.col("lang_docs") >= min_docs)
    of_kept = scratch.write(words.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "kept")
    langs = of_kept.groupBy("lang", "term").agg(F.max("lang_n").alias("lang_n")).groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms"), F.sum("lang_n").alias("lang_total"))
    totals = of_kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.where("term = ''").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.na.fill(0, ["total", "n_terms", "lang_total"])
    groups = scratch.write(groups.withColumn("p0", share(F.lit(0), F.col("total"), F.col("n_terms"))), "groups")
    p = share(F.col("n"), F.col("total"), F.col("n_terms"))
    q = share(F.col("lang_n"), F.col("lang_total"), F.col("n_terms"))
    shares = of_kept.join(groups, ["lang", "source"]).select("lang", "source", "term", "n", "lang_n", p.alias("p"), q.alias("q"))
    shares = scratch.write(shares, "shares")
    pairs = compare_sources(shares.select("lang", "source", "term", "p"), groups.select("lang", "source", "n_terms", "p0"))
    above = shares.where("p > q").select("lang", "source", "term", "n", "lang_n", (F.col("p") - F.col("q")).alias("value"))
    bands = scratch.write(partition_skybands(above, ranks), "bands")
    terms = merge_skybands(bands, ranks).select("lang", "source", F.col("term").alias("item"), "value")

    def ranked(df: DataFrame, part: str) -> DataFrame:
        within = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(within).alias("rank"))

    return ranked(pairs, "pair").unionByName(ranked(terms, "term").where(F.col("rank") <= ranks))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_sources(table(spark, sf_dir, "documents"))


OP11_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words
  FROM documents),
w AS (SELECT r, lang, source, unnest(words) AS term FROM d),
kept AS (
  SELECT lang, term, count(*) AS lang_n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= {MIN_DOCS}),
langs AS (SELECT lang, count(*) AS v, sum(lang_n)::HUGEINT AS total FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
g AS (
  SELECT x.lang, x.source, coalesce(sum(c.n), 0)::HUGEINT AS total
  FROM (SELECT DISTINCT lang, source FROM d) x LEFT JOIN c ON c.lang = x.lang AND c.source = x.source
  GROUP BY x.lang, x.source),
p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
    1 + ({BILLION}::HUGEINT * (coalesce(c.n, 0) + {SMOOTHING})) // (g.total + {SMOOTHING} * langs.v) AS p,
    1 + ({BILLION}::HUGEINT * (kept.lang_n + {SMOOTHING})) // (langs.total + {SMOOTHING} * langs.v) AS q
  FROM g JOIN langs ON langs.lang = g.lang JOIN kept ON kept.lang = g.lang
    LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pairs.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= {RANKS}
"""
