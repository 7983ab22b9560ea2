from tokenizers import Tokenizer

from sluice.llm import tokencounts
from sluice.llm.common import Scratch
from sluice.llm.packing import tokenizer_path

CHANGES = "op string, doc_id long, source string, lang string, text string"


def totals(rollup):
    return {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens, r.n_chars) for r in rollup.totals().collect()}


def expected(rows):
    tok, out = Tokenizer.from_file(tokenizer_path()), {}
    for source, lang, text in rows:
        text = text or ""
        for version, n in (("words-1", len(text.encode().split())), ("word_bpe_49k", len(tok.encode(text, add_special_tokens=False).ids))):
            old = out.get((source, lang, version), (0, 0, 0))
            out[source, lang, version] = (old[0] + 1, old[1] + n, old[2] + len(text))
    return out


def test_puts_revisions_deletes_and_repeated_batches(spark):
    rollup = tokencounts.TokenRollup(spark, Scratch(spark, "test").path("rollup"))
    first = [("put", 1, "a", "en", "One, two"), ("put", 2, "a", "en", "x"), ("put", 3, None, "de", None), ("put", None, "b", None, "y y"), ("put", 5, "a", "en", "u"), ("put", 5, "b", "en", "v")]
    second = [("put", 1, "b", "en", "moved here now"), ("delete", 2, None, None, None), ("delete", 99, None, None, None), ("put", 5, "a", "en", "u u")]
    third = [("delete", None, None, None, None), ("put", 2, "a", "fr", "back")]
    assert rollup.apply(1, spark.createDataFrame(first, CHANGES))
    assert totals(rollup) == expected([r[2:] for r in first])
    assert rollup.apply(2, spark.createDataFrame(second, CHANGES))
    after = [("b", "en", "moved here now"), (None, "de", None), ("b", None, "y y"), ("a", "en", "u u")]
    assert totals(rollup) == expected(after)
    assert not rollup.apply(2, spark.createDataFrame(second, CHANGES))
    assert not rollup.apply(1, spark.createDataFrame(first, CHANGES))
    assert totals(rollup) == expected(after)
    assert rollup.apply(3, spark.createDataFrame(third, CHANGES))
    assert rollup.apply(4, spark.createDataFrame([], CHANGES))
    assert totals(rollup) == expected([("b", "en", "moved here now"), (None, "de", None), ("a", "en", "u u"), ("a", "fr", "back")])


def test_a_batch_that_failed_before_its_commit_is_applied_anew(spark):
    rollup = tokencounts.TokenRollup(spark, Scratch(spark, "test").path("rollup"))
    rollup.apply(1, spark.createDataFrame([("put", 1, "a", "en", "x")], CHANGES))
    half = spark.createDataFrame([("put", 1, "a", "en", "x y z")], CHANGES)
    tokencounts.counted(half, tokencounts.VERSIONS).write.parquet(rollup._folder("states", 2))  # no delta: not committed
    assert totals(rollup) == expected([("a", "en", "x")])
    assert rollup.apply(2, half)
    assert totals(rollup) == expected([("a", "en", "x y z")])


def test_roll_up_keeps_first_lines_and_first_copies(spark, documents, odd_texts):
    docs = documents(odd_texts)
    kept = list(dict.fromkeys(t for t in odd_texts if t is not None))
    rows = [("s", "en", "\n".join(dict.fromkeys(t.split("\n")))) for t in kept] + [("s", "en", None)]
    assert totals(tokencounts.roll_up(docs, Scratch(spark, "test").path("rollup"))) == expected(rows)
    assert tokencounts.roll_up(documents([]), Scratch(spark, "test").path("rollup")).totals().collect() == []


def test_a_rollup_opened_again_goes_on(spark):
    path = Scratch(spark, "test").path("rollup")
    tokencounts.TokenRollup(spark, path).apply(1, spark.createDataFrame([("put", 1, "a", "en", "x"), ("put", 2, "a", "en", "y z")], CHANGES))
    again = tokencounts.TokenRollup(spark, path)
    assert again.batches == [1] and totals(again) == expected([("a", "en", "x"), ("a", "en", "y z")])
    assert not again.apply(1, spark.createDataFrame([("put", 1, "a", "en", "other")], CHANGES))
    assert again.apply(3, spark.createDataFrame([("put", 1, "a", "en", "x x x"), ("delete", 2, None, None, None)], CHANGES))
    last = tokencounts.TokenRollup(spark, path)
    assert totals(last) == expected([("a", "en", "x x x")])
    try:
        last.apply(2, spark.createDataFrame([], CHANGES))
    except ValueError as e:
        assert "batch 2" in str(e)
    else:
        raise AssertionError("a late batch must not be applied")


def test_many_batches_are_compacted(spark):
    path, kept = Scratch(spark, "test").path("rollup"), {}
    for k in range(1, 12):
        rollup = tokencounts.TokenRollup(spark, path, {"words-1": None}, compact=3)
        rows = [("put", k % 4, "a", "en", "w " * k), ("put", 10 + k, "b", "en", "v")] + ([("delete", 10 + k - 1, None, None, None)] if k % 2 else [])
        if k == 6:  # a compaction that was written by an attempt without a commit is written anew
            spark.range(1).write.parquet(rollup._folder("current", 6))
        rollup.apply(k, spark.createDataFrame(rows, CHANGES))
        kept[k % 4] = ("a", k)
        kept[10 + k] = ("b", 1)
        if k % 2:
            kept.pop(10 + k - 1, None)
        want = {}
        for source, n in kept.values():
            old = want.get(source, (0, 0))
            want[source] = (old[0] + 1, old[1] + n)
        assert {r.source: (r.n_docs, r.n_tokens) for r in rollup.totals().collect()} == want
    assert len(rollup._since("current", rollup.batches)[1]) == 2 and len(rollup._states(rollup.batches).inputFiles()) < 40
