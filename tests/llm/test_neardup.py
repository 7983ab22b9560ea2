import random

from sluice.llm import neardup


def brute(texts, ids):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        k = min(len(w), 5)
        sets.append({(k, tuple(w[i : i + k])) for i in range(len(w) - k + 1)} if w else set())
    group = list(range(len(texts)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= 85 * (len(sets[i]) + len(sets[j]) - common):
                group[root(i)] = root(j)
    return {i: (len(sets[k]), min(ids[m] for m in range(len(ids)) if root(m) == root(k))) for k, i in enumerate(ids)}


def check(documents, texts):
    ids = list(range(len(texts)))
    got = neardup.group_documents(documents(texts)).collect()
    expected = brute(texts, ids)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_chains_copies_and_loose_copies_equal_brute_force(documents, odd_texts):
    rng = random.Random(3)
    base = [f"word{rng.randrange(900)}" for _ in range(120)]
    texts = list(odd_texts[:7])
    chain = list(base)
    for _ in range(8):  # each is near the one before it, not the first
        chain[rng.randrange(120)] = f"new{rng.random()}"
        texts.append(" ".join(chain))
    for edits in (1, 2, 3, 4, 6, 8):  # a cluster about the threshold
        for _ in range(5):
            loose = list(base)
            for _ in range(edits):
                loose[rng.randrange(120)] = f"new{rng.random()}"
            texts.append(" ".join(loose))
    texts += [" ".join(base).upper(), " ".join(base).title()]
    rng.shuffle(texts)
    check(documents, texts)


def test_nulls_repeats_and_empty_tables(documents):
    rows = neardup.group_documents(documents(["a b", "a b", "a b", "c"], ids=[None, 3, 3, 2])).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in rows) == [(0, 0, True), (2, 2, True), (3, 3, True), (3, 3, True)]
    assert neardup.group_documents(documents([])).collect() == []


def test_few_misses_at_the_threshold():
    miss = (1 - 0.85**neardup.ROWS) ** neardup.BANDS
    assert miss < 1e-6


def pairs_at(rng, low, high, n, words=200):
    """Pairs of texts of which the share of common shingles lies between ``low`` and ``high``; each pair has words of its own."""
    out = []
    while len(out) < n:
        k = len(out)
        base = [f"p{k}w{rng.randrange(10**6)}" for _ in range(words)]
        other = list(base)
        for at in rng.sample(range(words), rng.randint(1, 9)):
            other[at] = f"q{k}x{rng.randrange(10**6)}"
        a, b = ({tuple(x[i : i + 5]) for i in range(words - 4)} for x in (base, other))
        if low <= len(a & b) / len(a | b) < high:
            out.append((" ".join(base), " ".join(other)))
    return out


def test_recall_on_pairs_just_above_the_threshold(documents):
    """Circulant coordinates aren't independent, so the formula alone doesn't tell the recall: it is counted."""
    rng = random.Random(11)
    for low, high, way in ((0.85, 0.90, {}), (0.80, 0.85, {"percent": 80, "bands": 32})):
        pairs = pairs_at(rng, low, high, 1000)
        got = {r.doc_id: r.component_id for r in neardup.group_documents(documents([t for p in pairs for t in p]), **way).collect()}
        found = sum(got[2 * i] == got[2 * i + 1] == 2 * i for i in range(len(pairs)))
        assert found >= 0.999 * len(pairs), (low, found)
        assert len(set(got.values())) == 2 * len(pairs) - found  # nothing else is linked
