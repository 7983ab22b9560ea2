import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from sluice.llm import divergence


def plain(rows, min_docs, ranks):
    """The audit in plain Python, from (text, lang, source) rows."""
    counts, in_docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)
        groups.add((lang, source))
        counts[lang, source].update(terms)
        in_docs[lang].update(set(terms))
    out = []
    for lang, source in groups:
        kept = [t for t, n in in_docs[lang].items() if n >= min_docs]
        v = len(kept)

        def shares(counter):
            total = sum(counter[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (counter[t] + 5) // (total + 5 * v) for t in kept}

        own, everyone = shares(counts[lang, source]), Counter()
        for g in groups:
            if g[0] == lang:
                everyone.update(counts[g])
        q = shares(everyone)
        pairs = []
        for g in groups:
            if g[0] == lang and g[1] != source:
                other = shares(counts[g])
                pairs.append((-sum(abs(own[t] - other[t]) for t in kept), g[1].encode()))
        out += [(lang, source, "pair", i.decode(), -f, k) for k, (f, i) in enumerate(sorted(pairs), 1)]
        terms = sorted((q[t] - own[t], t.encode()) for t in kept if counts[lang, source][t] and own[t] > q[t])
        out += [(lang, source, "term", t.decode(), -f, k) for k, (f, t) in enumerate(terms[:ranks], 1)]
    return sorted(out)


def made(n, seed=1):
    rng = random.Random(seed)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)] + ["été", "Straße", "日本", "Zed"]
    rows = []
    for _ in range(n):
        lang, source = rng.choice(["en", "en", "de", None]), rng.choice(["a", "a", "a", "b", "ç", None, "d"])
        shift = sum(map(ord, (lang or "") + (source or "")))
        text = " ".join(words[min(int(rng.expovariate(0.03)) + shift % 7, len(words) - 1)] for _ in range(rng.randint(0, 60)))
        rows.append((text, lang, source))
    return rows


def frame(spark, rows):
    # clashing names that the operator uses inside
    rows = [(*r, i, "x", 1.5) for i, r in enumerate(rows)]
    return spark.createDataFrame(rows, "text string, lang string, source string, doc_id long, term string, n double").repartition(5)


@pytest.mark.parametrize("ranks", [1, 3, 50])
def test_equals_the_plain_version(spark, ranks):
    rows = made(300) + [(None, "en", "empty"), ("", "xx", "only"), ("rare words", "yy", "p"), ("1 2 3", "yy", "q")]
    got = sorted(map(tuple, divergence.audit_sources(frame(spark, rows), 30, ranks).collect()))
    assert got == plain(rows, 30, ranks)
    assert {r[2] for r in got} == {"pair", "term"}


def test_blocks_buckets_and_shares_change_nothing(spark, monkeypatch):
    rows = made(200, 2) + [(t, la, f"s{i % 9}") for i, (t, la, _) in enumerate(made(100, 3))]
    want = plain(rows, 5, 10)
    for name, small in (("BUCKET_TERMS", 7), ("BLOCK_SOURCES", 2), ("MERGED_ROWS", 5), ("COMPARED_ROWS", 4), ("HELD_ROWS", 50), ("BAND_ROWS", 20)):
        monkeypatch.setattr(divergence, name, small)
    assert sorted(map(tuple, divergence.audit_sources(frame(spark, rows), 5, 10).collect())) == want


def test_skyband_keeps_who_is_dominated_by_fewer():
    rng = random.Random(4)
    for k in (1, 2, 5):
        n = [rng.randint(0, 12) for _ in range(300)]
        lang_n = [rng.randint(0, 12) for _ in range(300)]
        term = rng.sample([f"t{i:04}" for i in range(900)] + ["é", "z"], 300)
        spelt = [t.encode() for t in term]
        want = {i for i in range(300) if sum(n[j] >= n[i] and lang_n[j] <= lang_n[i] and spelt[j] < spelt[i] for j in range(300)) < k}
        assert set(divergence.kept_below(n, lang_n, term, k).tolist()) == want


def test_counts_beyond_a_long_product_stay_exact(spark):
    from pyspark.sql import functions as F

    big = 9_000_000_000_000
    df = spark.createDataFrame([(big, 3 * big + 1, 70)], "n long, total long, v long")
    got = df.select(divergence.share(F.col("n"), F.col("total"), F.col("v")).alias("p")).head().p
    assert got == 1 + 1_000_000_000 * (big + 5) // (3 * big + 1 + 350)


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    res = con.execute(divergence.OP11_SQL)
    names = [d[0] for d in res.description]
    df = divergence.op11_source_divergence(spark, sf)
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(res.fetchall())


def test_empty_table(spark):
    assert divergence.audit_sources(frame(spark, made(5)).limit(0)).collect() == []
