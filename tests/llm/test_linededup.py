import random
import re

from pyspark.sql import functions as F

from sluice.llm import linededup

WORD = re.compile("[^\x20\x09-\x0d]")


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def brute(texts):
    first, places = {}, []
    for i, t in enumerate(texts):
        for n, s in enumerate((t or "").split("\n")):
            if WORD.search(s):
                first.setdefault(s, (i, n))
                places.append((i, n, s))
    group = {s: s for s in first}

    def root(s):
        while group[s] != s:
            s = group[s]
        return s

    lines = list(first)
    for k, a in enumerate(lines):
        for b in lines[:k]:
            t = min(2, min(len(a), len(b)) // 20)
            if t and abs(len(a) - len(b)) <= t and distance(a, b) <= t:
                group[root(a)] = root(b)
    head = {}
    for s in lines:
        head[root(s)] = min(head.get(root(s), first[s]), first[s])
    out = []
    for i, t in enumerate(texts):
        kept, exact, near = [], [], []
        for n, s in enumerate((t or "").split("\n")):
            if WORD.search(s) and first[s] != (i, n):
                exact.append(n)
            elif WORD.search(s) and head[root(s)] < first[s]:
                near.append(n)
            else:
                kept.append(s)
        out.append((i, None if t is None else "\n".join(kept), exact, near))
    return out


def judged(docs):
    return sorted((r.doc_id, r.text, sorted(r.exact), sorted(r.near)) for r in linededup.dedup_lines(docs).collect())


def test_equals_brute_force(documents, odd_texts):
    rng = random.Random(9)

    def edited(s, n):
        s = list(s)
        for _ in range(n):
            kind, at = rng.randrange(3), rng.randrange(len(s))
            if kind == 0:
                s[at] = rng.choice("abéß")
            elif kind == 1:
                s.insert(at, rng.choice("abéß"))
            else:
                s.pop(at)
        return "".join(s)

    base = ["".join(rng.choice("abcdef éß") for _ in range(n)) + "x" for n in (5, 19, 20, 21, 39, 40, 41, 60, 90)]
    lines = base + [edited(s, n) for s in base for n in (1, 1, 2, 2, 3, 4)] + base[:3]
    rng.shuffle(lines)
    texts = ["\n".join(lines[i : i + 4]) for i in range(0, len(lines), 4)] + list(odd_texts) + ["a\r\nb\n\n \n"]
    assert judged(documents(texts)) == brute(texts)


def test_lines_of_one_bucket_are_compared_among_themselves(documents):
    a, b = "q" * 20, "z" * 20
    middle = "the very same middle"  # the segment that all lines share
    # the second and third are near each other and far from the first
    texts = [f"{a}{middle}{a}", f"{b}{middle}{b}", f"{b}{middle}{b[1:]}y", f"{a}{middle}{b}", f"x{a[1:]}{middle}{b}"]
    assert judged(documents(texts)) == brute(texts)
    assert [bool(near) for *_, near in brute(texts)] == [False, False, True, False, True]


def test_banded_distance_is_exact_up_to_the_band(spark):
    rng = random.Random(2)
    pairs = []
    for _ in range(400):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(0, 9)))
        b = "".join(rng.choice("ab") for _ in range(rng.randint(0, 9)))
        if 0 <= len(a) - len(b) <= 2:
            pairs.append((a, b, distance(a, b)))
    frame = spark.createDataFrame([(list(a), list(b), d) for a, b, d in pairs], "a array<string>, b array<string>, d int")
    got = frame.select("d", linededup.banded_distance(F.col("a"), F.col("b"), 2).alias("e")).collect()
    assert all((r.d == r.e) if r.d <= 2 else r.e > 2 for r in got)


def test_repeats_nulls_and_empty_tables(documents):
    docs = documents(["same line", "same line", None, "same line"], ids=[4, 4, 5, None])
    assert sorted((r.doc_id or 0, r.text or "-") for r in linededup.dedup_lines(docs).collect()) == [(0, "same line"), (4, "-"), (4, "-"), (5, "-")]
    assert linededup.dedup_lines(documents([])).collect() == []
    assert linededup.dedup_lines(documents(["x"])).drop("exact", "near").columns == documents(["x"]).columns


def test_long_lines_with_one_word_replaced_are_near(spark, tmp_path):
    rng = random.Random(4)

    def word():
        return "".join(rng.choice("abcdefghijklmnoprstu") for _ in range(rng.randint(3, 8)))

    lines, texts = [[word() for _ in range(32)] for _ in range(20)], []
    for k, words in enumerate(lines):
        at = rng.randrange(len(words))
        other = words[:at] + [("vwxyzvwx" if k % 2 else "vwxy")] + words[at + 1 :]
        texts += [" ".join(words), " ".join(other)]
    assert all(distance(a, b) > 2 for a, b in zip(texts[::2], texts[1::2], strict=True))
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.n_near for r in linededup.op2_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {i: i % 2 for i in range(len(texts))}


def test_more_edits_equal_brute_force(documents):
    rng = random.Random(12)
    base = ["".join(rng.choice("abcdefgh é") for _ in range(n)) + "x" for n in (38, 59, 99, 139, 158, 160, 199, 330)]
    lines = list(base)
    for s in base:
        for n in (1, 3, 5, 7, 8, 9, 10):
            chars = list(s)
            for _ in range(n):
                at = rng.randrange(len(chars))
                chars[at : at + rng.randrange(2)] = rng.choice(["", "q", "r"])
            lines.append("".join(chars))
    rng.shuffle(lines)
    group = list(range(len(lines)))
    for k, a in enumerate(lines):
        for j in range(k):
            if distance(a, lines[j]) <= min(8, min(len(a), len(lines[j])) // 20):
                group = [group[j] if g == group[k] else g for g in group]
    want = [k for k, s in enumerate(lines) if group.index(group[k]) < k and lines.index(s) == k]
    assert want and sorted(r.doc_id for r in linededup.dedup_lines(documents(lines), 8).collect() if r.near) == want


def test_lines_less_their_ends_keep_their_distance(spark):
    rng = random.Random(6)
    pairs = [("", ""), ("", "a"), ("a" * 16, "a" * 24), ("ab" * 30, "ab" * 26), ("é" * 600, "é" * 590 + "x" * 10)]
    for n in (8, 20, 90, 300, 700):
        s = "".join(rng.choice("abcé\U0001f600") for _ in range(n))
        at = rng.randrange(n)
        pairs += [(s, s), (s, s[:at] + "zz" + s[at:]), (s[:at] + "z" + s[at + 1 :], s), (s, s[:at] + s[at + 3 :])]
    frame = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(pairs)], "k int, a string, b string")
    got = {r.k: (r.a, r.b) for r in linededup.without_ends(frame, "a", "b").collect()}
    for k, (a, b) in enumerate(pairs):
        x, y = got[k]
        assert distance(x, y) == distance(a, b)
        assert a != b or len(a) > 504 or len(x) < 8


def test_pairs_of_a_large_bucket_equal_brute_force(documents, monkeypatch):
    monkeypatch.setattr(linededup, "LARGE", 0)
    monkeypatch.setattr(linededup, "letter_counts", lambda line: F.array(*[F.lit(0)] * len(linededup.LETTERS)))
    rng, lines = random.Random(21), []
    for n in (20, 39, 45, 66, 88, 125, 170, 215, 330):
        middle = "".join(rng.choice("abcdef é") for _ in range(n // 3))
        for k in range(4):
            # lines that share their middle and are near in groups, far otherwise
            s = "".join(rng.choice("abcdef") for _ in range(n // 3)) + middle + "".join(rng.choice("abcdef") for _ in range(n - 2 * (n // 3)))
            lines.append(s)
            for e in (1, 2, 3, 5, 7, 8):
                chars = list(s)
                for _ in range(e):
                    at = rng.randrange(len(chars))
                    chars[at : at + rng.randrange(2)] = rng.choice(["", "q", "r"])
                lines.append("".join(chars))
    lines = list(dict.fromkeys(lines))
    rng.shuffle(lines)
    group = list(range(len(lines)))
    for k, a in enumerate(lines):
        for j in range(k):
            t = min(8, min(len(a), len(lines[j])) // 20)
            if abs(len(a) - len(lines[j])) <= t and group[j] != group[k] and distance(a, lines[j]) <= t:
                group = [group[j] if g == group[k] else g for g in group]
    want = [k for k in range(len(lines)) if group.index(group[k]) < k]
    assert want and sorted(r.doc_id for r in linededup.dedup_lines(documents(lines), 8).collect() if r.near) == want


def test_pairs_of_a_large_bucket_do_not_grow_with_its_square(documents, monkeypatch):
    formed, confirmed = [], linededup.confirmed
    monkeypatch.setattr(linededup, "confirmed", lambda pairs, *rest: (formed.append(pairs.count()), confirmed(pairs, *rest))[1])
    rng, letters = random.Random(5), list("abcdefghijklmnopqrstuvwxyz")

    def line():
        rng.shuffle(letters)
        return "the very same" + "".join(letters)

    lines = [line() for _ in range(120)]
    linededup.dedup_lines(documents([*lines, lines[0] + "s"]))
    assert 0 < sum(formed) < 4 * len(lines)


def test_pairs_of_copies_are_formed_once(documents, monkeypatch):
    monkeypatch.setattr(linededup, "letter_counts", lambda line: F.array(*[F.lit(0)] * len(linededup.LETTERS)))
    made, across = [], linededup.across

    def counted(*args):
        pairs = across(*args)
        made.append((pairs.count(), pairs.distinct().count()))
        return pairs

    monkeypatch.setattr(linededup, "across", counted)
    rng = random.Random(17)

    def word():
        return "".join(rng.choice("abcdefghijklmnoprstu") for _ in range(5))

    base, lines = [word() for _ in range(30)], []
    for k in range(24):
        # every third line is near an earlier one
        words = lines[rng.randrange(k)].split() if k % 3 == 2 else list(base)
        for at in rng.sample(range(30), 1 if k % 3 == 2 else 3):
            words[at] = word()
        lines.append(" ".join(words))
    group = list(range(len(lines)))
    for k, a in enumerate(lines):
        for j in range(k):
            if group[j] != group[k] and distance(a, lines[j]) <= 8:
                group = [group[j] if g == group[k] else g for g in group]
    want = [k for k in range(len(lines)) if group.index(group[k]) < k]
    assert want and sorted(r.doc_id for r in linededup.dedup_lines(documents(lines), 8).collect() if r.near) == want
    rows, pairs = map(sum, zip(*made, strict=True))
    assert 0 < pairs <= rows <= 2 * pairs


def test_letters_of_near_lines_are_alike(spark):
    rng, rows = random.Random(3), []
    for n in (20, 45, 170, 400, 900):
        for e in (0, 1, 2, 5, 8, 30):
            a = "".join(rng.choice("aab cdé,Zé z") for _ in range(n))
            chars = list(a)
            for _ in range(e):
                at = rng.randrange(len(chars))
                chars[at : at + rng.randrange(2)] = rng.choice(["", "q", "a"])
            rows.append((a, "".join(chars), e))
    frame = spark.createDataFrame(rows, "x string, y string, e int")
    sides = [
        linededup.packed(frame.select("e", "x", "y", F.length(c).alias("n"), linededup.letter_counts(F.col(c)).alias("letters"))).select(
            "e", "x", "y", *[F.col(f).alias(f"{c}_{f}") for f in ("n", *linededup.COUNTS)]
        )
        for c in "xy"
    ]
    both = sides[0].withColumnsRenamed({"x": "left", "y": "right"}).join(sides[1].withColumnsRenamed({"x": "left", "y": "right"}), ["left", "right", "e"])
    got = {(r.left, r.right): (r.alike, r.more) for r in both.select("left", "right", linededup.alike("x", "y", 8, 20).alias("alike"), F.expr(linededup.surplus_sql("x", "y")).alias("more")).collect()}
    for a, b, e in rows:
        alike, more = got[a, b]
        t = min(8, min(len(a), len(b)) // 20)
        assert more == sum(max(0, min(127, a.count(c)) - min(127, b.count(c))) for c in linededup.LETTERS)
        assert alike or e > t
    assert not all(alike for alike, _ in got.values())
