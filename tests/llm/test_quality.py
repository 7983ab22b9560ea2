import math
import re
from collections import Counter

from sluice.llm import quality

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {q for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for q in range(i, i + 8)}
    lines = [s for s in text.split("\n") if WORD.search(s)]
    counts = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
    return (*counts, len(w) < 20 or 100 * len(covered) > 30 * len(w))


def test_base_counts_equal_brute_force(documents, odd_texts):
    again = " ".join(f"r{i}" for i in range(9))
    texts = [*odd_texts, f"{again} x {again} y {again}", " ".join(["a"] * 30), "# a\n# a\n\n|<> b c", " ".join(map(str, range(40)))]
    got = {r.doc_id: r for r in quality.judge(documents(texts)).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(t), t and t[:50]
        assert not (r.base_failed and r.kept)


def test_distance_is_jensen_shannon(spark):
    p, q = [3.0, 1.0, 0.0], [1.0, 1.0, 2.0]
    frame = spark.createDataFrame([(p, q), ([0.0, 0.0, 0.0], q), (p, p)], "p array<double>, q array<double>")
    got = [r.d for r in quality.with_js_distance(frame, "d", "p", "q").collect()]
    a, b = [x / sum(p) for x in p], [x / sum(q) for x in q]
    js = sum((x * math.log2(2 * x / (x + y)) if x else 0) + (y * math.log2(2 * y / (x + y)) if y else 0) for x, y in zip(a, b, strict=True)) / 2
    assert abs(got[0] - math.sqrt(js)) < 1e-12 and got[1] is None and got[2] < 1e-6


def test_junk_goes_and_clean_and_short_texts_stay(documents):
    clean = "The history of the town is that of a river and it was on the way to the sea for a long time in which people came "
    texts = [clean.replace("town", f"town{i}") + " ".join(f"of the word{i}{j} and" for j in range(60)) for i in range(30)]
    junk = " | ".join(f"#x{j}$$" for j in range(150))
    shorter = [" ".join([*t.split()[:8], *t.split()[-n + 8 :]]) for t in texts[:5] for n in (24, 40, 70, 99)]  # clean texts of few words
    junks = [junk, junk[:400], " ".join(junk.split()[:20]), " ".join(junk.split()[:60])]
    rows = {r.doc_id: r for r in quality.judge(documents([*texts, *shorter, *junks])).collect()}
    first = len(texts) + len(shorter)
    assert all(rows[i].kept for i in range(first))
    for i in range(first, first + len(junks)):  # junk goes, however short
        assert rows[i].n_words >= quality.MIN_WORDS and not rows[i].base_failed and not rows[i].kept


def test_null_languages_and_empty_tables(documents):
    assert [r.kept for r in quality.judge(documents([" ".join(map(str, range(30)))], lang=None)).collect()] == [True]
    assert quality.judge(documents([])).collect() == []
