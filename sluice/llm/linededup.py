"""Line dedup across documents: exact copies by grouping, near copies by a segment-partition edit join.

Built-in functions only. A line of l characters may be reached by ``allowed``
edits (by its length, at most MAX_EDITS, which covers a changed word). It is
cut into one segment more than that, placed from its nearer end, so a line
within that many edits keeps at least one segment unchanged near its place
there. Segments are the index; longer or equal lines probe it with their
substrings, only at places that the edits and the length difference leave open.
Candidates are verified by the bounded edit distance.

Buckets are compared with their most central line before anything else, and
only pairs still in different components after that, so a bucket of m near
copies costs m comparisons and not m squared, and no link is lost. A pair is
formed in the first bucket that it shares, if lengths and letter counts allow
it. In a large bucket whose lines share little else, it must also share one
more unchanged piece, which is part of the key there.
"""

from __future__ import annotations

from functools import reduce
from string import ascii_lowercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, small_or_shuffled, table
from .graph import components

# Edits that the query allows to a line, whatever its length.
MAX_EDITS = 8
# One edit is allowed for each such number of characters of the shorter line.
CHARS_PER_EDIT = 20
# From so many times CHARS_PER_EDIT characters on a class has twice as many lengths.
WIDE_FROM = 8
# Passes over the segments, so that only one pass's keys are on disk at a time.
PASSES = 3
# Characters compared at once to find what two lines share at their ends.
BLOCKS = (256, 128, 64, 32, 16, 8)
# In buckets of more rows pairs are formed by a finer key, unless lines share more segments than COPIED, as copies do.
LARGE, COPIED = 8, 2
# Characters whose counts are compared; a long holds LANES of them, a byte each, up to 127.
LETTERS = [*ascii_lowercase, " ", ","]
LANES = 7
WORDS = [f"k{g}" for g in range(len(LETTERS) // LANES)]
COUNTS = [*WORDS, "counted"]


def allowed_edits(length: Column, most: int, per: int) -> Column:
    return F.least(F.lit(most), F.floor(length / per)).cast("int")


def has_word(line: Column) -> Column:
    return F.ltrim(line, F.lit(" \t\n\x0b\f\r")) != ""


def document_lines(docs: DataFrame) -> DataFrame:
    """row (position in the document), line: the documents' lines that have a word."""
    split = F.posexplode(F.split(F.coalesce(F.col("text"), F.lit("")), "\n"))
    return docs.select("*", split.alias("line_no", "line")).where(has_word(F.col("line")))


def class_sql(n: str, most: int, per: int) -> str:
    """The class of length ``n``: ``per`` neighbouring lengths, or twice as many where a class of them is a small part of the length."""
    wide = max(most, WIDE_FROM)
    return f"int(if({n} < {wide * per}, {n} div {per}, {wide} + ({n} - {wide * per}) div {2 * per}))"


def least_sql(c: str, most: int, per: int) -> str:
    """The least length of class ``c``."""
    wide = max(most, WIDE_FROM)
    return f"if({c} <= {wide}, {per} * ({c}), {per} * (2 * ({c}) - {wide}))"


def key_sql(shift: str) -> str:
    """Key of segment i of class c (t, size) in a line (n characters, code) at a place ``shift`` characters on; ``code`` has four bytes a character."""
    start = f"if(i <= t div 2, i * size, n - (t - i + 1) * size) + {shift}"
    return f"xxhash64(c, i, substring(code, int(4 * ({start}) + 1), int(4 * size)))"


def sized(lines: DataFrame, most: int, per: int) -> DataFrame:
    """``lines`` of a class c with t, the edits allowed to it, and the size of its t + 1 segments."""
    return lines.withColumns({"t": F.least(F.lit(most), "c"), "size": F.expr(f"int(({least_sql('c', most, per)}) div (least({most}, c) + 1))")})


def bucket_rows(lines: DataFrame, most: int, per: int, at: int = 0, passes: int = 1, own: bool = False) -> DataFrame:
    """(bucket, node, tag): bucket keys of the lines (node, line, n); the tag holds class, segment and whether it is one of the line's own segments.

    Of ``passes`` the one numbered ``at`` has every so-manieth segment; no key is in two passes. With ``own`` only the own ones.

    A class of lengths c is indexed by t + 1 segments of equal size, t the
    edits allowed to it: those up to the middle are placed from the line's
    start, the others from its end. Let a line be within t edits. If every
    segment i from the start is touched or has more than i edits before it,
    the first half has more edits than segments, and so from the end; both
    together would be more than t. So some segment i is unchanged and at most
    i places off, counted from its end of the line. With d characters more,
    d between what the class and t leave, it is also at most (t - d) / 2
    places to one side and (t + d) / 2 to the other. A key hashes c, i and the substring.
    """
    allowed, c_of = f"least({most}, n div {per})", class_sql("n", most, per)
    fewest, greatest = f"greatest(0, n - ({least_sql('c + 1', most, per)}) + 1)", f"least(t, n - ({least_sql('c', most, per)}))"
    c_from = c_of if own else class_sql(f"greatest({per}, n - {allowed})", most, per)
    classes = lines.select("node", "n", F.expr("encode(line, 'UTF-32')").alias("code"), F.expr(f"explode(sequence({c_from}, {c_of}))").alias("c"))
    classes = sized(classes, most, per).where(F.expr(f"{fewest} <= t and t >= {at}"))
    segments = classes.select("*", F.expr(f"explode(sequence({at}, t, {passes}))").alias("i"))
    if own:
        places = segments.withColumn("shift", F.lit(0))
    else:
        less, more = f"int((t - {fewest}) div 2)", f"int((t + {greatest}) div 2)"
        shifts = f"explode(if(i <= t div 2, sequence(-least(i, {less}), least(i, {more})), sequence(-least(t - i, {more}), least(t - i, {less}))))"
        places = segments.select("*", F.expr(shifts).alias("shift"))
    tag = f"((bigint(c) * 64 + i) * 64 + shift + 32) * 2 + int(shift = 0 and c = {c_of})"
    return places.select(F.expr(key_sql("shift")).alias("bucket"), "node", F.expr(tag).alias("tag"))


def tagged(rows: DataFrame, most: int, per: int) -> DataFrame:
    """``rows`` with what their ``tag`` holds: class c (t, size), segment i, its ``shift``, and whether it is the line's own."""
    told = rows.withColumns({"c": F.expr("int(tag div 8192)"), "i": F.expr("int(tag div 128 % 64)"), "shift": F.expr("int(tag div 2 % 64) - 32"), "own": F.expr("tag % 2 = 1")})
    return sized(told, most, per)


def finer_rows(rows: DataFrame, own: bool) -> DataFrame:
    """``rows`` (tagged, of lines n, code) with ``finer``: keys of the bucket and one piece more of the line.

    Two lines that share segment i in an alignment of at most t edits have all
    of them left and right of it. The two sides are cut into t + 1 pieces, p on
    the left and r on the right, so that one side has fewer edits than pieces.
    That side lies between fixed ends, the line's and the segment's, so the
    argument of ``bucket_rows`` holds for it: some piece q of m is unchanged and
    at most min(q, m - 1 - q) places off, counted from its nearer end. Sizes follow from the class alone.
    """
    start = "int(if(i <= t div 2, i * size, n - (t - i + 1) * size) + shift)"
    sides = rows.withColumn("start", F.expr(start)).withColumn("p", F.expr("if(i = 0, 0, i + int(i > t - i))"))
    pieces = sides.select("*", F.expr("explode(sequence(0, t))").alias("at")).withColumns({"left": F.expr("at < p"), "q": F.expr("if(at < p, at, at - p)"), "m": F.expr("if(at < p, p, t + 1 - p)")})
    pieces = pieces.withColumn("piece", F.expr("int(if(left, i * size, (t - i) * size) div m)"))
    off = "0" if own else "explode(sequence(-least(q, m - 1 - q), least(q, m - 1 - q)))"
    places = pieces.select("*", F.expr(off).alias("off"))
    place = "if(q <= (m - 1) div 2, if(left, 0, start + size) + q * piece, if(left, start, n) - (m - q) * piece) + off"
    finer = F.expr(f"xxhash64(bucket, at, substring(code, int(4 * ({place}) + 1), int(4 * piece)))")
    return places.select(finer.alias("finer"), *[c for c in rows.columns if c != "code"])


def banded_distance(long: Column, short: Column, band: int) -> Column:
    """Edit distance of two arrays of characters if at most ``band``, else some number above it.

    Bit r of a word stands for row j - band + r of column j, so the band moves
    one row down with each column and any length fits in 2 * band + 1 bits.
    The count follows the diagonal that ends in the last cell. ``long`` must
    have from 0 to ``band`` characters more than ``short``.
    """
    mask = (1 << (2 * band + 1)) - 1
    extra = F.size(long) - F.size(short)

    def bits(x: Column) -> Column:
        return x.bitwiseAND(F.lit(mask).cast("bigint"))

    def column(state: Column, j: Column) -> Column:
        char = F.get(short, j)
        equal = F.lit(0).cast("bigint")
        for r in range(2 * band + 1):
            here = F.when((j + (r - band) >= 0) & (F.get(long, F.greatest(j + (r - band), F.lit(0))) == char), F.lit(1 << r))
            equal = equal + here.otherwise(0).cast("bigint")
        # stepwise structs, so that each word is evaluated once
        first = F.array(F.struct(state["vp"].alias("vp"), state["vn"].alias("vn"), state["dist"].alias("dist"), equal.alias("x")))
        second = F.transform(
            first,
            lambda s: F.struct(
                s["vp"].alias("vp"),
                s["vn"].alias("vn"),
                s["dist"].alias("dist"),
                bits((s["x"].bitwiseAND(s["vp"]) + s["vp"]).bitwiseXOR(s["vp"]).bitwiseOR(s["x"]).bitwiseOR(s["vn"])).alias("d0"),
            ),
        )

        def close(s: Column) -> Column:
            d0, vp, vn = s["d0"], s["vp"], s["vn"]
            hp = bits(vn.bitwiseOR(F.bitwise_not(d0.bitwiseOR(vp))))
            hn = d0.bitwiseAND(vp)
            down = F.shiftright(d0, 1)
            on_diagonal = F.call_function("shiftright", d0, F.lit(band) + extra).bitwiseAND(F.lit(1).cast("bigint"))
            return F.struct(
                bits(hn.bitwiseOR(F.bitwise_not(down.bitwiseOR(hp)))).alias("vp"),
                down.bitwiseAND(hp).alias("vn"),
                (s["dist"] + F.lit(1) - on_diagonal.cast("int")).alias("dist"),
            )

        return F.get(F.transform(second, close), F.lit(0))

    start = F.struct(
        F.lit(mask & ~((1 << band) - 1)).cast("bigint").alias("vp"),
        F.lit(0).cast("bigint").alias("vn"),
        extra.cast("int").alias("dist"),
    )
    columns = F.when(F.size(short) > 0, F.sequence(F.lit(0), F.size(short) - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(columns, start, column, lambda s: s["dist"])


def without_ends(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """``pairs`` with the strings ``a`` and ``b`` less most of what they share at their start and their end.

    Blocks of halving size are compared, so up to 504 characters go at each
    end and at most 7 shared ones stay; the edit distance is the same.
    """
    columns = [c for c in pairs.columns if c not in (a, b)]
    out = pairs.withColumns({"ca": F.encode(a, "UTF-32"), "cb": F.encode(b, "UTF-32"), "room": F.least(F.length(a), F.length(b)), "p": F.lit(0), "q": F.lit(0)})

    def same(start_a: str, start_b: str, size: int) -> str:
        return f"substring(ca, 4 * ({start_a}) + 1, {4 * size}) = substring(cb, 4 * ({start_b}) + 1, {4 * size})"

    for size in BLOCKS:
        out = out.withColumn("p", F.expr(f"p + if(p + {size} <= room and {same('p', 'p', size)}, {size}, 0)"))
    for size in BLOCKS:
        from_end = same(f"length(ca) div 4 - q - {size}", f"length(cb) div 4 - q - {size}", size).replace("4 * (", "4 * int(")
        out = out.withColumn("q", F.expr(f"q + if(p + q + {size} <= room and {from_end}, {size}, 0)"))
    cores = [F.expr(f"substring({c}, p + 1, length({c}) - p - q)").alias(c) for c in (a, b)]
    return out.select(*columns, *cores)


def confirmed(pairs: DataFrame, lines: DataFrame, scratch: Scratch, most: int, per: int) -> DataFrame:
    """The pairs (a, b) of nodes whose lines are within the edits allowed to the shorter one."""
    sides = {x: lines.select(F.col("node").alias(x), *[F.col(f).alias(f"{x}_{f}") for f in ("line", "n", *COUNTS)]) for x in "ab"}
    close = pairs.join(sides["a"], "a").join(sides["b"], "b").where(alike("a", "b", most, per))
    t = allowed_edits(F.least("a_n", "b_n"), most, per)
    cores = without_ends(close.select("a", "b", t.alias("t"), "a_line", "b_line"), "a_line", "b_line")
    measured = cores.select("a", "b", "t", F.levenshtein("a_line", "b_line", most).alias("distance"))  # -1: above ``most``
    # written before it is filtered, as a filter would repeat the steps above
    return scratch.write(measured, "distances").where("distance between 0 and t").select("a", "b")


def letter_counts(line: Column) -> Column:
    """How often each of LETTERS occurs."""
    return F.array(*[F.octet_length(line) - F.octet_length(F.replace(line, F.lit(g), F.lit(""))) for g in LETTERS])


def packed(lines: DataFrame) -> DataFrame:
    """``lines`` with COUNTS, which hold the array ``letters`` and its sum."""
    counts = [F.least(F.get("letters", F.lit(k)), F.lit(127)).cast("bigint") for k in range(len(LETTERS))]
    lanes = [F.shiftleft(c, 8 * (k % LANES)) for k, c in enumerate(counts)]
    words = {w: reduce(Column.bitwiseOR, lanes[g * LANES : (g + 1) * LANES]) for g, w in enumerate(WORDS)}
    return lines.withColumns(words | {"counted": reduce(Column.__add__, counts)}).drop("letters")


def surplus_sql(x: str, y: str) -> str:
    """How many of the counted letters ``x`` has more than ``y``, or less where that is 255 or more.

    Each byte of (x | high bits) - y keeps its high bit where x has not fewer, and then the surplus below it.
    A remainder by 255 is the sum of the bytes, less 255 where it is as many.
    """
    high, low, terms = 0x80808080808080, 0x1010101010101, []
    for w in WORDS:
        less = f"(({x}_{w} | {high}L) - {y}_{w})"
        terms.append(f"({less} & ((shiftright({less}, 7) & {low}L) * 127L)) % 255L")
    return " + ".join(terms)


def alike(x: str, y: str, most: int, per: int) -> Column:
    """Whether lengths and letters allow ``x`` and ``y`` to be near: an edit adds one character at most, and takes one at most."""
    t = allowed_edits(F.least(f"{x}_n", f"{y}_n"), most, per)
    more = F.greatest(F.lit(0), F.col(f"{y}_counted") - F.col(f"{x}_counted"))
    return (F.abs(F.col(f"{x}_n") - F.col(f"{y}_n")) <= t) & (F.expr(surplus_sql(x, y)) + more <= t)


def across(x: DataFrame, y: DataFrame, key: str, most: int, per: int) -> DataFrame:
    """(a, b): pairs of a row of ``x``, which are lines' own, and one of ``y`` with the same ``key``, of different roots and not too far by lengths and letters.

    With ``before`` and ``own_before``, only if no earlier bucket of ``x`` is one of ``y`` too.
    """
    ends = ("node", "root", "n", "plain", *COUNTS)
    first = "before" in y.columns
    x = x.select(key, *[F.col(f).alias(f"i_{f}") for f in (*ends, *["own_before"] * first)])
    y = y.select(key, *[F.col(f).alias(f"j_{f}") for f in (*ends, "own", *["before"] * first)])
    # where both are own and both would form the pair, one does
    once = ~F.col("j_own") | (F.col("i_plain") != F.col("j_plain")) | (F.col("i_node") < F.col("j_node"))
    wanted = (F.col("i_root") != F.col("j_root")) & (F.col("i_node") != F.col("j_node")) & once & alike("i", "j", most, per)
    if first:
        wanted = wanted & ~F.arrays_overlap("i_own_before", "j_before")
    return x.join(y, key).where(wanted).select(F.least("i_node", "j_node").alias("a"), F.greatest("i_node", "j_node").alias("b"))


def centered(whole: DataFrame) -> DataFrame:
    """(bucket, center): of each bucket's lines whose own it is, the one that shares its own segments with the most lines."""
    sizes = whole.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"))
    own = whole.where("tag % 2 = 1").join(sizes, "bucket").select("bucket", "node", "rows")
    scores = own.groupBy("node").agg(F.sum("rows").alias("score"))
    return own.select("bucket", "node").join(scores, "node").groupBy("bucket").agg(F.max_by("node", F.struct("score", "node")).alias("center"))


def with_buckets_before(rows: DataFrame) -> DataFrame:
    """``rows`` (bucket, node, tag, large and the node's columns) with ``plain`` and the node's buckets of the same class and an earlier segment.

    A row is plain, so that its pairs are formed by the bucket alone, if the
    bucket is small or the line shares many own segments, as copies do: then
    one more piece would hardly tell pairs apart. ``before`` has all the
    node's earlier buckets, ``own_before`` those that are own and plain.
    """
    node = [c for c in rows.columns if c not in ("bucket", "tag", "large")]
    of_class = rows.groupBy(*node, F.expr("tag div 8192").alias("c")).agg(F.collect_list(F.struct("bucket", "tag", "large")).alias("all"))
    told = of_class.withColumn("copied", F.expr(f"size(filter(all, s -> s.tag % 2 = 1)) > {COPIED}"))
    each = told.select("*", F.expr("inline(all)")).withColumn("plain", F.expr("copied or not large"))
    before = "filter(all, s -> s.tag div 128 < tag div 128)"
    own_before = "if(plain and tag % 2 = 1, filter(all, s -> s.tag div 128 < tag div 128 and s.tag % 2 = 1 and (copied or not s.large)).bucket, array())"
    return each.select("bucket", "tag", "large", *node, "plain", F.expr(f"{before}.bucket").alias("before"), F.expr(own_before).alias("own_before"))


def near_lines(lines: DataFrame, scratch: Scratch, most: int, per: int) -> DataFrame:
    """(node, root) of the distinct lines (node, line, n) that have a near copy; root is the least node of the component."""
    written = []
    for at in range(PASSES):
        keys = bucket_rows(lines, most, per, at, PASSES)
        centers = bucket_rows(lines, most, per, at, PASSES, own=True).groupBy("bucket").agg(F.min("node").alias("center"))
        written.append(scratch.write(keys.join(centers.hint("shuffle_hash"), "bucket").where("node != center"), "members"))
    members = reduce(DataFrame.union, written)
    # the first own line has its own segment there, not moved
    firsts = members.select("bucket", F.col("center").alias("node"), F.expr("tag div 128 * 128 + 65").alias("tag"))
    whole = scratch.write(members.drop("center").union(firsts).distinct(), "whole")
    scratch.drop(*written)
    star = whole.join(centered(whole), "bucket").where("node != center")
    tried = scratch.write(star.select(F.least("node", "center").alias("a"), F.greatest("node", "center").alias("b")).distinct(), "pairs")
    used = scratch.write(whole.select("node").distinct(), "used")
    used_lines = lines.join(small_or_shuffled(used), "node", "left_semi").withColumn("letters", letter_counts(F.col("line")))
    lines = packed(scratch.write(used_lines, "lines"))
    links = confirmed(tried, lines, scratch, most, per)
    roots = scratch.write(components(links, scratch), "roots")
    rooted = whole.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = rooted.groupBy("bucket").agg(F.min("root").alias("r"), F.max("root").alias("s"), F.count(F.lit(1)).alias("rows")).where("r != s")
    opened = rooted.join(mixed.select("bucket", (F.col("rows") > LARGE).alias("large")), "bucket")
    # lengths and letter counts rule out most pairs before they are formed
    open_ = scratch.write(with_buckets_before(opened.join(lines.drop("line"), "node")), "open")
    told = tagged(open_, most, per)
    plain = across(told.where("own and plain"), told, "bucket", most, per)
    # pairs of the other rows are formed within those that share one more piece
    asked = open_.where("not plain and tag % 2 = 1").select("bucket").distinct()
    coded = tagged(open_.drop("before", "own_before").join(asked, "bucket", "left_semi").join(lines.select("node", F.expr("encode(line, 'UTF-32')").alias("code")), "node"), most, per)
    fine = across(finer_rows(coded.where("own and not plain"), own=True), finer_rows(coded, own=False), "finer", most, per)
    rest = plain.union(fine).distinct().join(tried, ["a", "b"], "left_anti")
    rest = scratch.write(rest, "rest")
    more = confirmed(rest, lines, scratch, most, per)
    out = scratch.write(components(links.union(more), scratch), "roots")
    scratch.drop(whole, open_, roots)
    return out


def dropped_lines(docs: DataFrame, scratch: Scratch, most: int, per: int) -> DataFrame:
    """(doc_id, text_hash, exact, near): the numbers of the lines that go, for documents that lose any."""
    lines = document_lines(docs.select("doc_id", "text_hash", "text")).drop("text")
    order = F.struct("doc_id", "text_hash", "line_no")
    hashes = {"h1": F.xxhash64("line"), "h2": F.xxhash64(F.lit("line"), F.reverse("line"))}
    classes = lines.groupBy("line").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("copies"))
    # numbered and written at once, so that no recomputed task can number a line anew
    nodes = scratch.write(
        classes.select("line", F.length("line").alias("n"), "first", "copies", F.monotonically_increasing_id().alias("node")), "nodes"
    )
    roots = near_lines(nodes.where(F.col("n") >= per).select("node", "line", "n"), scratch, most, per)
    heads = nodes.join(roots, "node").groupBy("root").agg(F.min("first").alias("head"))
    later = nodes.withColumns(hashes).drop("line", "n").join(small_or_shuffled(roots), "node", "left").join(heads, "root", "left")
    marks = later.select("h1", "h2", "first", "copies", F.coalesce(F.col("head") < F.col("first"), F.lit(False)).alias("near"))
    marks = scratch.write(marks.where("copies > 1 or near").drop("copies"), "marks")
    scratch.drop(nodes)
    judged = lines.withColumns(hashes).select("h1", "h2", order.alias("place")).join(marks, ["h1", "h2"])
    lost = judged.withColumn("copy", F.col("place") != F.col("first")).where("copy or near")
    return lost.groupBy("place.doc_id", "place.text_hash").agg(
        F.collect_set(F.when(F.col("copy"), F.col("place.line_no"))).alias("exact"),
        F.collect_set(F.when(~F.col("copy"), F.col("place.line_no"))).alias("near"),
    )


def with_text_less_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with ``left``: ``text`` less the lines whose numbers (from 0) are in ``exact`` or ``near``.

    Marks and lines are merged in order, a mark before its line. The merged
    column is referred to by name, as a lambda evaluates what stands in it for every element.
    """
    lost = F.concat("exact", "near")
    no_line = F.lit(None).cast("string")
    marks = F.transform(lost, lambda i: F.struct(i.alias("i"), F.lit(0).alias("kind"), no_line.alias("line")))
    lines = F.transform(F.split("text", "\n"), lambda s, i: F.struct(i.alias("i"), F.lit(1).alias("kind"), s.alias("line")))
    docs = docs.withColumn("merged", F.when(F.size(lost) > 0, F.array_sort(F.concat(marks, lines))))

    def stays(x: Column, k: Column) -> Column:
        before = F.get("merged", k - 1)
        return (x["kind"] == 1) & ~F.coalesce((before["kind"] == 0) & (before["i"] == x["i"]), F.lit(False))

    text = F.array_join(F.transform(F.filter("merged", stays), lambda x: x["line"]), "\n")
    return docs.withColumn("left", F.when(F.col("merged").isNotNull(), text).otherwise(F.col("text"))).drop("merged")


def dedup_lines(docs: DataFrame, most: int = 2, per: int = CHARS_PER_EDIT) -> DataFrame:
    """``docs`` with its text less the copied lines, and the numbers (from 0) of the lines gone in ``exact`` and ``near``.

    Of equal lines the first stays, by doc_id, then by text and place; of a
    component of near lines the one that comes first. A line may differ by one
    edit for each ``per`` characters, at most ``most``. Lines without a word
    always stay. Lines below ``per`` characters are compared for equality
    only. Null texts stay null. Rows that repeat both doc_id and text are one
    document here: they lose the same lines. An empty table gives no rows.
    Other columns pass through untouched, whatever their names; only
    ``exact`` and ``near`` must not be among them.
    """
    scratch = Scratch(docs.sparkSession, "linededup")
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id"), F.col("text"), F.xxhash64("text").alias("text_hash"))
    gone = scratch.write(dropped_lines(keyed.select("doc_id", "text_hash", "text"), scratch, most, per), "gone")
    right = small_or_shuffled(gone).select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), "exact", "near")
    both = keyed.join(right, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")), "left")
    none = F.array().cast("array<int>")
    both = both.withColumns({c: F.coalesce(c, none) for c in ("exact", "near")})
    both = with_text_less_lines(both)
    kept = [F.col("left").alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns]
    return both.select(*kept, "exact", "near")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines with a word, those gone as copies and as near copies, and a digest of the text that stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("text").alias("whole"))
    n_lines = F.size(F.filter(F.split(F.coalesce("whole", F.lit("")), "\n"), has_word))
    return dedup_lines(docs, MAX_EDITS).select(
        "doc_id",
        n_lines.cast("long").alias("n_lines"),
        F.size("exact").cast("long").alias("n_exact"),
        F.size("near").cast("long").alias("n_near"),
        F.sha2(F.encode(F.coalesce("text", F.lit("")), "utf-8"), 256).alias("kept_sha256"),
    )
