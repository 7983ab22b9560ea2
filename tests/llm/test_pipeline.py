import random

import corpus_pipeline
from sluice.llm.common import Scratch


def prose(rng, n):
    common = "the of and to in a is that for it was on".split()
    return " ".join(rng.choice(common) if rng.random() < 0.4 else f"w{rng.randrange(5000)}" for _ in range(n))


def tables(spark, tmp_path, texts, benchmark):
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(benchmark, "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def stages(spark, sf_dir):
    docs, out, scratch = spark.read.parquet(f"{sf_dir}/documents.parquet"), [], Scratch(spark, "test")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), "stage")
        out.append(docs)
        assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == columns
    return out


def test_each_stage_takes_effect_and_keeps_clean_documents(spark, tmp_path):
    rng = random.Random(8)
    clean = [prose(rng, 150) for _ in range(12)]
    passage = prose(rng, 40)
    line = "This line is in more than one document, as licences are."
    words = clean[0].split()
    near = " ".join([*words[:70], "edited", *words[71:]])
    texts = [
        *clean,
        None,
        "too short",
        " ".join(["again and again"] * 40),
        clean[1],
        near,
        f"{line}\n{prose(rng, 100)}",
        f"{line[:-1]}!\n{prose(rng, 100)}",
        passage,
    ]
    sf_dir = tables(spark, tmp_path, texts, [("1", passage), ("2", None)])
    quality, lines, apart, free, packed = stages(spark, sf_dir)
    ids = [sorted(r.doc_id for r in x.select("doc_id").distinct().collect()) for x in (quality, lines, apart, free, packed)]
    assert ids[0] == [i for i in range(len(texts)) if i not in (12, 13, 14)]
    assert ids[1] == [i for i in ids[0] if i != 15]  # its only line is a copy
    assert ids[2] == [i for i in ids[1] if i != 16]
    assert ids[3] == [i for i in ids[2] if i != 19]
    assert ids[4] == ids[3]
    left = {r.doc_id: r for r in lines.collect()}
    assert left[17].text == texts[17] and left[18].text == texts[18].split("\n")[1]
    assert left[18].n_chars == len(left[18].text)
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).select("doc_id", "piece", "length").collect())) == sorted(map(tuple, packed.select("doc_id", "piece", "length").collect()))


def test_empty_documents(spark, tmp_path):
    assert corpus_pipeline.run(spark, tables(spark, tmp_path, [], [("1", "x")])).collect() == []


def test_repeated_rows_long_texts_and_clashing_names(spark, tmp_path):
    rng = random.Random(9)
    long = "\n".join(prose(rng, 30) for _ in range(1500))
    texts = [prose(rng, 80), long, prose(rng, 90), None]
    names = "doc_id long, text string, lang string, source string, n_chars long, exact string, near long, whole int, root string, gone_id long, gone_hash string, node int, kept boolean"
    rows = [(i, t, "en", "s", t and len(t), "e", 5, 6, "r", 7, "g", 8, False) for i, t in enumerate(texts)]
    rows += [rows[2], (None, prose(rng, 70), None, None, None, *[None] * 8)]
    spark.createDataFrame(rows, names).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([("1", "x y z")], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    *kept, packed = stages(spark, str(tmp_path))
    for docs in kept:
        got = {r.doc_id: r for r in docs.collect()}
        assert {0, 1, 2, None} <= set(got) and 3 not in got
        assert got[1].text == long and (got[0].exact, got[0].near, got[0].whole, got[0].gone_hash) == ("e", 5, 6, "g")
    assert {r.doc_id for r in packed.collect()} == {0, 1, 2, None}
