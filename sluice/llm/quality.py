"""Quality rules: fixed word rules, then Jensen-Shannon distance to the language's own histograms.

Built-in functions only. Every document's histograms of character classes and of
its language's common words are compared with the whole corpus's
histogram for that language. Short texts are guarded: chance alone moves their
histograms, so the bound on the distances widens as words get fewer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, Scratch, small_or_shuffled, table

MIN_WORDS = 20
REPEAT_PERCENT = 30
REPEAT_WINDOW = 8
# The mean of the two distances (0 to 1) above which a text is rejected; without a list of common words the
# character classes alone decide, by a bound of their own. Below FULL_WORDS words the bounds rise evenly, by
# WIDER and WIDER_CLASS for SHORT_WORDS words and fewer.
MAX_DISTANCE, MAX_CLASS_DISTANCE = 0.2, 0.33
WIDER, WIDER_CLASS, SHORT_WORDS, FULL_WORDS = 0.1, 0.04, 60, 120
# Common words of languages, as many of each: fixed values.
LISTED = 12
COMMON_WORDS = {
    "en": "the of and to in a is that for it was on",
    "fr": "de la le et les des en un que une est pour",
    "de": "der die und in den von zu das mit sich des auf",
    "es": "de la que el en y a los se del las un",
}
# Character classes: fixed values.
CLASSES = {
    "lower": "[a-z]",
    "upper": "[A-Z]",
    "digit": "[0-9]",
    "space": f"[{SPACE}]",
    "symbol": r"[#*$%&|<>]",
    "other_letter": r"[^\x00-\x7F]",
}


def text_words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"[^{SPACE}]+"), F.lit(0))


def count_of(text: Column, chars: str) -> Column:
    """Characters of ``text`` in the bracketed class ``chars``."""
    inverse = f"[{chars[2:]}" if chars.startswith("[^") else f"[^{chars[1:]}"
    return F.length(F.regexp_replace(text, f"{inverse}+", "")).cast("long")


def with_windows(docs: DataFrame) -> DataFrame:
    """``docs`` with ``windows``: hashes of the 8-word windows of ``words``, doubled from neighbours; [] with fewer words.

    Every doubling is a column of its own, since an expression used twice in another is evaluated twice.
    """
    enough = F.size("words") >= REPEAT_WINDOW
    docs = docs.withColumn("windows", F.when(enough, F.transform("words", lambda w: F.xxhash64(w))).otherwise(F.array().cast("array<bigint>")))
    step = 1
    while step < REPEAT_WINDOW:
        n = F.greatest(F.size("windows") - step, F.lit(0))
        both = F.zip_with(F.slice("windows", 1, n), F.slice("windows", step + 1, n), lambda x, y: F.xxhash64(x, y))
        docs = docs.withColumn("windows", both)
        step *= 2
    return docs


def with_repeated_words(docs: DataFrame) -> DataFrame:
    """``docs`` with n_repeat_words from its ``windows``: words inside windows that occur twice or more, each once.

    Each step is a column of its own, since a lambda evaluates what stands in it for every element.
    """

    def same(x: Column, y: Column) -> Column:
        return F.coalesce(x["h"] == y["h"], F.lit(False))

    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    pairs = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    docs = docs.withColumn("in_order", F.when(repeats, F.array_sort(pairs)))
    again = F.filter("in_order", lambda x, k: same(x, F.get("in_order", k - 1)) | same(x, F.get("in_order", k + 1)))
    docs = docs.withColumn("places", F.sort_array(F.transform(again, lambda x: x["i"])))
    n = F.size("places") - 1
    steps = F.zip_with(F.slice("places", 1, n), F.slice("places", 2, n), lambda a, b: F.least(b - a, F.lit(REPEAT_WINDOW)))
    covered = F.when(F.col("places").isNotNull(), F.aggregate(steps, F.lit(REPEAT_WINDOW), lambda s, x: s + x))
    return docs.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("in_order", "places", "windows")


def base_counts(docs: DataFrame) -> DataFrame:
    """``docs`` (row columns and text) with words and the base counts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda s: s.rlike(f"[^{SPACE}]"))
    counted = (
        with_windows(docs.withColumn("words", text_words(F.col("text"))))
        .withColumn("lines", lines)
        .withColumns(
            {
                "n_words": F.size("words").cast("long"),
                "word_chars": F.length(F.array_join("words", "")).cast("long"),
                "n_symbols": count_of(text, CLASSES["symbol"]),
                "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            }
        )
        .drop("lines")
    )
    return with_repeated_words(counted)


def common_words(lang: Column) -> Column:
    """The language's common words, null for a language without a list."""
    lists = [F.when(lang == k, F.array(*map(F.lit, v.split()))) for k, v in COMMON_WORDS.items()]
    return F.coalesce(*lists)


def with_word_histogram(docs: DataFrame) -> DataFrame:
    """``docs`` with ``usual``: counts of its language's common words in ``words``, then of all other words; null without a list.

    The words are joined with a blank on either side of each, so cutting out
    " word " shortens the text by a known length each time.
    """
    padded = F.lower(F.concat(F.lit(" "), F.array_join("words", "  "), F.lit(" ")))
    docs = docs.withColumns({"common": common_words(F.col("lang")), "padded": padded})

    def count(k: int) -> Column:
        sought = F.concat(F.lit(" "), F.get("common", F.lit(k)), F.lit(" "))
        cut = F.octet_length("padded") - F.octet_length(F.replace(F.col("padded"), sought, F.lit("")))
        return (cut / F.octet_length(sought)).cast("double")

    docs = docs.withColumn("seen", F.when(F.col("common").isNotNull(), F.array(*[count(k) for k in range(LISTED)])))
    rest = F.size("words") - F.aggregate("seen", F.lit(0.0), lambda s, x: s + x)
    return docs.withColumn("usual", F.concat("seen", F.array(rest))).drop("common", "padded", "seen")


def class_histogram(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    counts = [count_of(text, c) for c in CLASSES.values()]
    rest = F.length(text).cast("long") - sum(counts[1:], counts[0])
    return F.array(*counts, rest).cast("array<double>")


def total(h: str) -> Column:
    return F.aggregate(h, F.lit(0.0), lambda s, x: s + x)


def with_js_distance(docs: DataFrame, name: str, h: str, g: str) -> DataFrame:
    """``docs`` with column ``name``: square root of the Jensen-Shannon divergence (base 2) of histograms h and g; null if one is empty."""

    def part(p: Column, m: Column) -> Column:
        return F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)

    docs = docs.withColumns({"n": total(h), "m": total(g)})
    terms = F.zip_with(
        h, g, lambda p, q: (part(p / F.col("n"), (p / F.col("n") + q / F.col("m")) / 2) + part(q / F.col("m"), (p / F.col("n") + q / F.col("m")) / 2)) / 2
    )
    divergence = F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)
    distance = F.when((F.col("n") > 0) & (F.col("m") > 0), F.sqrt(F.greatest(divergence, F.lit(0.0))))
    return docs.withColumn(name, distance).drop("n", "m")


def judge(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the base counts, base_failed, kept and the two distances.

    Null or empty texts have no words, so base_failed. A null language has no
    reference: its documents are judged by the base rules alone. A language
    without a list of common words is judged by its character classes. Repeated
    rows are judged one by one; an empty table gives no rows. Columns other
    than doc_id, text and lang are ignored.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    docs = docs.select("doc_id", "text", "lang")
    seen = with_word_histogram(base_counts(docs)).select(
        "doc_id",
        "lang",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        class_histogram(F.col("text")).alias("classes"),
        "usual",
    )
    seen = scratch.write(seen, "counts")

    def summed(column: str, size: int) -> list[Column]:
        return [F.sum(F.get(column, F.lit(i))).alias(f"{column}{i}") for i in range(size)]

    def put_together(column: str, size: int) -> Column:
        return F.array(*[F.col(f"{column}{i}") for i in range(size)]).alias(f"{column}_ref")

    sizes = {"classes": len(CLASSES) + 1, "usual": LISTED + 1}
    sums = seen.groupBy("lang").agg(*[c for k, n in sizes.items() for c in summed(k, n)])
    refs = scratch.write(sums.select("lang", *[put_together(k, n) for k, n in sizes.items()]), "references")
    both = seen.join(small_or_shuffled(refs), "lang", "left")
    both = with_js_distance(both, "class_distance", "classes", "classes_ref")
    both = with_js_distance(both, "word_distance", "usual", "usual_ref")
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    mean = (F.col("class_distance") + F.col("word_distance")) / 2
    short = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.lit(FULL_WORDS) - F.col("n_words")) / F.lit(float(FULL_WORDS - SHORT_WORDS))))
    too_far = F.col("class_distance") > MAX_CLASS_DISTANCE + WIDER_CLASS * short
    far = F.coalesce(mean > MAX_DISTANCE + WIDER * short, too_far, F.lit(False))
    return (
        both.withColumn("base_failed", base_failed)
        .select(
            "doc_id",
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            "base_failed",
            (~F.col("base_failed") & ~far).alias("kept"),
            "class_distance",
            "word_distance",
        )
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).drop("class_distance", "word_distance")


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), ids AS (SELECT *, row_number() OVER (ORDER BY doc_id) AS r FROM d
), grams AS (
  SELECT r, p, array_to_string(w[p : p + 7], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS p FROM ids WHERE len(w) >= 8)
), again AS (
  SELECT r, count(DISTINCT q) AS n FROM (
    SELECT r, unnest(range(p, p + 8)) AS q FROM (SELECT r, p, count(*) OVER (PARTITION BY r, g) AS c FROM grams) WHERE c > 1) GROUP BY r
), lines AS (
  SELECT r, count(*) - count(DISTINCT s) AS n FROM (SELECT r, unnest(string_split(t, chr(10))) AS s FROM ids)
  WHERE regexp_matches(s, '[^\x20\x09-\x0D]') GROUP BY r
), listed(lang, common) AS (VALUES
  LISTS
), h AS (
  SELECT ids.r, doc_id, ids.lang, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(lines.n, 0) AS n_dup_lines, coalesce(again.n, 0) AS n_repeat_words,
    list_transform(['[a-z]', '[A-Z]', '[0-9]', '[\x20\x09-\x0D]', '[#*$%&|<>]', '[^\x00-\x7F]'],
      lambda c: length(t) - length(regexp_replace(t, c, '', 'g'))) AS six, length(t) AS n_text,
    list_transform(w, lambda x: lower(x)) AS lw, common
  FROM ids LEFT JOIN lines USING (r) LEFT JOIN again USING (r) LEFT JOIN listed ON ids.lang = listed.lang
), bins AS (
  SELECT r, lang, 0 AS kind, unnest(range(0, 7)) AS bin, unnest(list_append(six, n_text - list_sum(six))) AS c FROM h
  UNION ALL
  SELECT r, lang, 1, unnest(range(0, 13)), unnest(list_append(seen, n_words - list_sum(seen)))
  FROM (SELECT r, lang, n_words, list_transform(common, lambda k: len(list_filter(lw, lambda x: x = k))) AS seen FROM h WHERE common IS NOT NULL)
), refs AS (SELECT lang, kind, bin, sum(c) AS c FROM bins WHERE lang IS NOT NULL GROUP BY 1, 2, 3
), shares AS (
  SELECT b.r, b.kind, b.c / sum(b.c) OVER (PARTITION BY b.r, b.kind) AS p, f.c / sum(f.c) OVER (PARTITION BY b.r, b.kind) AS q,
    sum(b.c) OVER (PARTITION BY b.r, b.kind) AS total
  FROM bins b JOIN refs f USING (lang, kind, bin)
), js AS (
  SELECT r, kind, sqrt(greatest(sum(
    (CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2), 0)) AS d
  FROM shares WHERE total > 0 GROUP BY 1, 2
), verdict AS (
  SELECT h.*, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, a.d AS class_distance, b.d AS word_distance,
    least(1.0::DOUBLE, greatest(0.0::DOUBLE, (120 - n_words)::DOUBLE / 60)) AS short
  FROM h LEFT JOIN js a ON a.r = h.r AND a.kind = 0 LEFT JOIN js b ON b.r = h.r AND b.kind = 1
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce((class_distance + word_distance) / 2 > 0.2::DOUBLE + 0.1::DOUBLE * short,
    class_distance > 0.33::DOUBLE + 0.04::DOUBLE * short, FALSE) AS kept
FROM verdict
""".replace("LISTS", ", ".join(f"('{k}', {v.split()})" for k, v in COMMON_WORDS.items()))
