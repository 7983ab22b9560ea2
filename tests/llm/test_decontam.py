import hashlib
import re

from sluice.llm import decontam

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items):
    w, hit, found = words(text), set(), set()
    for item, body in items:
        b = words(body)
        n = min(13, len(b))
        for at in range(len(b) - n + 1 if b else 0):
            for p in range(len(w) - n + 1):
                if w[p : p + n] == b[at : at + n]:
                    hit |= set(range(p, p + n))
                    found.add(item)
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)


def judged(frame):
    return sorted((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in frame.collect())


def test_equals_brute_force_in_one_or_many_blocks(spark, documents, odd_texts):
    passage = " ".join(f"p{i}" for i in range(30))
    twice = " ".join(f"q{i % 4}" for i in range(40))
    items = [("10", passage), ("9", "Short item"), ("x", ""), ("n", None), ("9", passage[:60]), ("q", twice), ("ü", "Ünï çödé Straße")]
    texts = [*odd_texts, passage, f"before {passage} behind", " ".join(f"p{i}" for i in range(14)), "a short ITEM, here", twice + " x " + twice]
    texts += ["p0 p1 p2 p3 p4 p5 p6 p7 p8 p9 p10 p11", " ".join(f"f{i}" for i in range(300)) + " short item"]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    expected = sorted((i, *brute(t, [x for x in items if x[1]])) for i, t in enumerate(texts))
    assert judged(decontam.decontaminate(documents(texts), benchmark)) == expected
    assert judged(decontam.decontaminate(documents(texts), benchmark, segment_texts=3, block_words=40)) == expected


def test_proximity_matches_stay_inside_a_document(spark, documents):
    docs = documents(["far alpha x y beta z", "beta alpha", "alpha", "beta", "alpha a b c d e f g beta"])
    index = decontam.build_index(docs)
    found = decontam.search(index, [("i", [b"alpha", b"beta"])], reach=3)
    assert sorted(r.doc_id for r in found.collect() if r["items"]) == [0, 1]


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id string, text string")
    assert [r.contaminated for r in decontam.decontaminate(documents(["a b", None]), none).collect()] == [False, False]
    assert decontam.decontaminate(documents([]), none).collect() == []


def test_items_without_an_id_hit_but_are_not_named(spark, documents):
    passage = " ".join(f"p{i}" for i in range(20))
    items = [(None, passage), ("a", " ".join(f"p{i}" for i in range(13))), (None, "other words here")]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    got = judged(decontam.decontaminate(documents([passage, "other words here", "clean text"]), benchmark))
    none = hashlib.sha256(b"").hexdigest()
    assert got == [(0, 20, 20, 1, hashlib.sha256(b"a").hexdigest(), True), (1, 3, 3, 0, none, True), (2, 2, 0, 0, none, False)]
    assert judged(decontam.decontaminate(documents([passage, "other words here", "clean text"]), benchmark, block_words=5)) == got
