import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from sluice.llm import packing


def bins_of(plan):
    bins = defaultdict(list)
    for length, first, after, sequence, offset, each in plan:
        for k in range(after - first):
            bins[sequence + k // each].append((offset + k % each * length, length))
    return bins


@pytest.mark.parametrize("capacity", [1, 10, 64, 2048])
def test_plan_holds_every_piece_without_gaps(capacity):
    rng = random.Random(capacity)
    for n in (0, 1, 7, 400):
        lengths = Counter(rng.randint(1, capacity) for _ in range(n))
        bins = bins_of(packing.packing_plan(lengths, capacity))
        assert Counter(x for b in bins.values() for _, x in b) == lengths
        for b in bins.values():
            at = 0
            for offset, x in sorted(b):
                assert offset == at
                at += x
            assert at <= capacity


def least_bins(items, capacity):
    """The fewest bins, by search."""
    items = sorted(items, reverse=True)
    best = len(items)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(items):
            best = len(rooms)
            return
        for r in {r for r in rooms if r >= items[i]}:
            rest = list(rooms)
            rest.remove(r)
            place(i + 1, [*rest, r - items[i]])
        place(i + 1, [*rooms, capacity - items[i]])

    place(0, [])
    return best


def test_reduction_keeps_the_optimum():
    rng = random.Random(5)
    for _ in range(60):
        items = [rng.randint(1, 12) for _ in range(rng.randint(1, 9))]
        rest = Counter(items)
        fixed = packing.dominant_bins(rest, 12)
        assert sum(n for _, n in fixed) + least_bins(list(rest.elements()), 12) == least_bins(items, 12)


def test_ids_equal_the_whole_tokenizer(odd_texts):
    path = packing.tokenizer_path()
    tok = Tokenizer.from_file(path)
    texts = [*odd_texts, "don't ... a.b, ?. ?! İstanbul ΟΔΟΣ x<|endoftext|>y", "<|startoftext|>", "ﬁ ǅ ᾳ, Å. 한글", "e\x85d\x1cf 'S's'"]
    expected = [np.array(tok.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert packing.token_buffers(path)(pa.array(texts)) == expected


def test_pack_round_trip(documents, odd_texts):
    path = packing.tokenizer_path()
    tok = Tokenizer.from_file(path)
    got = packing.pack(documents(odd_texts)).collect()
    expected = {}
    for i, t in enumerate(odd_texts):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), 2048)):
            cell = np.array(ids[at : at + 2048], "<u4")
            expected[i, piece] = (at, len(cell), zlib.crc32(cell.tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == expected
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for s in sequences.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= 2048


def test_repeated_rows_null_ids_and_empty_tables(documents):
    docs = documents(["a b", "a b", "c"], ids=[1, 1, None])
    assert sorted((r.doc_id or 0, r.length) for r in packing.pack(docs).collect()) == [(0, 2), (1, 3), (1, 3)]
    assert packing.pack(documents([])).collect() == []
