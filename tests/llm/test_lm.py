import math
import random
import zlib
from collections import Counter

import numpy as np

from sluice.llm import lm


def tokens(text):
    return [*(w.decode() for w in (text or "").encode().lower().split()), ""]


def held_out(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0


def corpus(n=60):
    rng = random.Random(4)
    texts = []
    for k in range(n):
        words = [["red", "blue", "green"], ["uno", "dos", "tres"]][k % 2]
        texts.append(" ".join(rng.choice(words) if rng.random() < 0.9 else f"rare{rng.randrange(4000)}" for _ in range(80)))
    return texts


def test_base_score_equals_brute_force_with_few_sent_words(documents, odd_texts):
    texts = [*odd_texts, *corpus()]
    ids = [*range(len(texts) - 1), None]
    counts = Counter(t for i, x in zip(ids, texts, strict=True) if not held_out(i) for t in tokens(x))
    n, v = sum(counts.values()), len(counts)
    # few words are sent, so most go by the shuffled counts
    got = {r.doc_id: r for r in lm.score_documents(documents(texts, ids), heads=8, tails=4, sent_words=10).collect()}
    for i, x in zip(ids, texts, strict=True):
        r, t = got[i], tokens(x)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held_out(i), len(t), sum(counts[w] > 0 for w in t), n)
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        assert math.isclose(r.base_score, base, rel_tol=1e-9, abs_tol=1e-9)
        assert r.score < 0


def test_tables_are_normalised_in_every_context():
    rng = np.random.default_rng(1)
    p = {"r": rng.normal(0, 2, (30, 4)), "q": rng.normal(0, 2, (30, 4)), "c": rng.normal(0, 1, (2, 4)), "b": rng.normal(0, 3, (30, 1))}
    one, two, z = lm.normalised_tables(p)
    for a in range(30):
        for b in range(30):
            assert abs(np.exp(one[a].astype(float) + two[b] - z[a, b]).sum() - 1) < 1e-4


def test_words_of_a_class_sum_to_one(spark, documents):
    counts = {"a": 5, "bx": 2, "by": 1, "c": 1, "": 4}
    order = sorted(counts.items(), key=lambda x: (-x[1], x[0]))
    tails = {}
    for w, c in order[2:]:
        k = lm.tail_class_of(w, 2)
        tails[k] = (tails.get(k, (0, 0))[0] + c, tails.get(k, (0, 0))[1] + 1)
    vocabulary = lm.Vocabulary(order, tails, sum(counts.values()), len(counts), 2, 2)
    for k, (c, n) in tails.items():
        inside = [10 ** vocabulary.inside[i] for i, (w, _) in enumerate(order) if i >= 2 and lm.tail_class_of(w, 2) == k]
        unknown = 0.1 / vocabulary.tail_total[k]
        assert math.isclose(sum(inside) + unknown, 1.0)


def test_held_out_texts_score_better_than_by_the_base(documents):
    got = [r for r in lm.score_documents(documents(corpus(400)), heads=16, tails=8).collect() if r.held_out]
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_repeats_and_empty_tables(documents):
    got = lm.score_documents(documents(["a b", "a b"], ids=[1, 1])).collect()
    assert len(got) == 2 and got[0].score == got[1].score
    assert lm.score_documents(documents([])).collect() == []
