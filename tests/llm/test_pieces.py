import random

import public_tokenizers
import pytest
import sentencepiece

from sluice.llm import pieces


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path(pieces.MODEL)))


@pytest.fixture(scope="module")
def encoder():
    return pieces.encoder_for(pieces.MODEL)


def ids_of(encoder, text):
    import numpy as np

    return np.frombuffer(encoder.encode(text), "<i4").tolist()


ODD = [
    "", " ", "  ", "\n", "a", " a ", "▁", "▁▁ x", "a▅b", "日本語 😀 ﷺ \x00 x", "x\r\n\r\n y", "<s>a</s><unk><0x41>",
    "Ünï çödé, Straße's … 你好 é", "ﬁ ligature", "​﻿ ", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "ababababababababab",
    "ninninninninnin", "thethethethe", "\U0010ffff\U0001f600́", "....,,,,----____====", "tab\tand\x0bothers\x0c",
]


@pytest.mark.parametrize("text", ODD)
def test_ids_equal_the_library_on_odd_texts(library, encoder, text):
    assert ids_of(encoder, text) == library.encode(text)


def test_ids_equal_the_library_on_runs_of_blanks(library, encoder):
    for n in range(80):
        for text in (" " * n, "x" + " " * n, " " * n + "x", " " * n + "x" + " " * (n // 2) + "."):
            assert ids_of(encoder, text) == library.encode(text)


def test_ids_equal_the_library_on_random_texts(library, encoder):
    rng = random.Random(7)
    alphabets = ["ab", "aent ", "ineros", "the anddi", "01 .,", "abcdefghijklmnopqrstuvwxyz ", "äöüß éè", "日本語中文 a", "()[]{}<>=+-*/ \n\t_", "▁ ab"]
    for _ in range(4000):
        alphabet = rng.choice(alphabets)
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60)))
        assert ids_of(encoder, text) == library.encode(text), text
    # joined pieces make many false starts
    names = [p for p in encoder.pieces if 2 < len(p) < 9 and "▁" not in p]
    for _ in range(4000):
        text = "".join(rng.choice(names) for _ in range(rng.randint(2, 8)))
        assert ids_of(encoder, text) == library.encode(text), text


def test_search_steps_back(encoder):
    # the longest matches alone don't give the segmentation that merging gives
    def greedy(text):
        out = []
        while text:
            n = next(n for n in range(len(text), 0, -1) if text[:n] in encoder.pieces)
            out.append(encoder.pieces[text[:n]])
            text = text[n:]
        return out

    rng = random.Random(3)
    words = ["".join(rng.choice("aeinorst") for _ in range(12)) for _ in range(300)]
    assert sum(greedy(w) != encoder.segment(w) for w in words) > 30
    assert all([encoder.names[i] for i in encoder.segment(w)] == encoder.merge(w) for w in words)


def test_long_words_and_blank_runs_are_whole(library, encoder):
    rng = random.Random(11)
    for text in ("".join(rng.choice("aeinorst") for _ in range(30_000)), " " * 20_000, "é" * 9_001, "ﷺ" * 5_000):
        assert ids_of(encoder, text) == library.encode(text)


def test_documents_are_encoded_and_decoded(spark, documents, odd_texts, library):
    got = {r.doc_id: r for r in pieces.encode_documents(documents(odd_texts + [odd_texts[3]])).collect()}
    assert len(got) == len(odd_texts) + 1
    for i, text in enumerate(odd_texts + [odd_texts[3]]):
        assert got[i].ids == library.encode(text or "")
        assert got[i].decoded == library.decode(library.encode(text or ""))
        assert got[i].decoded == (text or "").replace("▁", " ")
    assert got[len(odd_texts)].ids == got[3].ids


def test_query_returns_the_digests_of_every_document(spark):
    import hashlib

    sf = "/root/testdata/sf0.001"
    library = sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path(pieces.MODEL)))
    got = {r.doc_id: r for r in pieces.op12_sentencepiece(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for row in rows:
        ids = library.encode(row.text or "")
        r = got[row.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_empty_table(spark, documents):
    assert pieces.encode_documents(documents([])).collect() == []
