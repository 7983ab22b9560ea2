"""Best-fit packing of tokenised documents after Martello-Toth dominance reduction.

Tokenising and cutting run in the tasks; only the histogram of piece lengths
(at most ``capacity`` rows, whatever the corpus) reaches the driver. On it the
reduction fixes bins that provably dominate every alternative, best fit packs
the rest, and the plan comes back as ranges of ranks per length. Each piece
looks up its own rank, so the assignment is a join, not a loop.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections import Counter, defaultdict
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, Words, gathered, slices, table

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
CACHED_WORDS = 300_000


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def token_buffers(path: str):
    """A function Arrow texts -> little-endian unsigned 32-bit ids of each, equal to encoding each whole text.

    The tokenizer's rule drops white space and never joins across it, nor
    across the border of a letter and a punctuation mark. So each distinct
    word is encoded once and its bytes are reused; they stay with the Python
    worker, up to CACHED_WORDS. A word of lower-case letters in normal form is
    one unit to the tokenizer's rule and goes to its model directly; anything
    else is encoded by the whole tokenizer, and so are texts with a special
    token's opening ``<|``.
    """
    import os
    import sys
    from types import ModuleType
    from unicodedata import is_normalized

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import numpy as np
    import pyarrow.compute as pc
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    kept = sys.modules.setdefault("sluice_met_words", ModuleType("sluice_met_words")).__dict__
    if path not in kept:
        kept[path] = (Tokenizer.from_file(path), {})
    tok, cache = kept[path]
    model, spell = tok.model, ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str

    def encode(text: str) -> bytes:
        return np.asarray(tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def unit(word: str) -> bytes | None:
        """Ids of a word that is one unit, else None."""
        if word.isascii():
            spelt = word if word.isalpha() else None
        else:
            plain = word.isalpha() and word.lower() == word and is_normalized("NFC", word)
            spelt = spell(word)[0][0] if plain else None
        return spelt and np.asarray([t.id for t in model.tokenize(spelt)], dtype="<u4").tobytes()

    def meet(chunk: bytes, passing: dict[bytes, bytes]) -> None:
        """Learn a chunk; with punctuation behind a word only the word is kept, the chunk is for this call."""
        word = chunk.rstrip(b".,!?;:")
        ids = cache.get(word) or unit(word.decode())
        if ids is None or not word:
            cache[chunk] = encode(chunk.decode())
            return
        cache[word] = ids
        if word != chunk:
            tail = chunk[len(word) :]
            if tail not in cache:
                cache[tail] = encode(tail.decode())
            last = word[-1:]
            joined = last.isalpha() or last[0] > 127
            passing[chunk] = ids + cache[tail] if joined and word.decode().isalpha() else encode(chunk.decode())

    def buffers(texts) -> list[bytes]:
        words = Words(texts)
        if len(cache) > CACHED_WORDS:
            cache.clear()
        passing: dict[bytes, bytes] = {}
        for name in words.names:
            if name not in cache:
                meet(name, passing)
        spelt = [cache.get(w) or passing.get(w, b"") for w in words.names]
        lengths = np.fromiter(map(len, spelt), np.int64, len(spelt)) // 4
        flat = np.frombuffer(b"".join(spelt), dtype="<u4")
        runs = lengths[words.index]
        ids = flat[gathered((np.cumsum(lengths) - lengths)[words.index], runs)]
        ends = np.concatenate([[0], np.cumsum(runs)])[words.ends].tolist()
        out = [ids[a:b].tobytes() for a, b in zip([0, *ends], ends, strict=False)]
        for i in pc.indices_nonzero(pc.fill_null(pc.match_substring(texts, "<|"), False)).to_pylist():
            out[i] = encode(texts[i].as_py())
        return out

    return buffers


def cut_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and the piece's task and rank in it by length."""
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType(
        [T.StructField("doc_id", id_type), T.StructField("piece", T.IntegerType())]
        + [T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "part", "rank_in_part")]
    )

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        buffers, seen = token_buffers(path), [0] * (capacity + 1)
        end = end_id.to_bytes(4, "little")
        for batch in slices(batches):
            cols: list[list] = [[] for _ in range(7)]
            for doc_id, buf in zip(batch.column(0).to_pylist(), buffers(batch.column(1)), strict=True):
                buf += end
                for piece, at in enumerate(range(0, len(buf), 4 * capacity)):
                    cell = buf[at : at + 4 * capacity]
                    n = len(cell) // 4
                    for c, v in zip(cols, (doc_id, piece, at // 4, n, zlib.crc32(cell), part, seen[n]), strict=True):
                        c.append(v)
                    seen[n] += 1
            out = [pa.array(cols[0], batch.schema.field(0).type), pa.array(cols[1], pa.int32())]
            out += [pa.array(c, pa.int64()) for c in cols[2:]]
            yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(cut, schema)


# -- planning on the histogram of lengths -------------------------------------------------


def dominant_bins(count: Counter, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Martello-Toth reduction: bins that some optimal packing surely has; ``count`` loses their items.

    A set with item j dominates another if the other's remaining items can be
    split so that each part fits under one item of the first set. Rules used:
    an exact partner; no partner at all; at most one partner fits (take the
    largest); at most two fit and the largest single one is at least as large
    as every pair that fits.
    """
    fixed: list[tuple[tuple[int, ...], int]] = []

    def fix(bin_: tuple[int, ...], times: int) -> None:
        if times:
            fixed.append((bin_, times))
            for x in bin_:
                count[x] -= times
                if not count[x]:
                    del count[x]

    fix((capacity,), count.get(capacity, 0))
    for a in range(capacity - 1, (capacity - 1) // 2, -1):
        b = capacity - a
        fix((a, b), count[a] // 2 if a == b else min(count[a], count[b]) if b else 0)
    changed = True
    while changed:
        changed = False
        for j in sorted(count, reverse=True):
            if not count.get(j):
                continue
            rest = count.copy()
            rest[j] -= 1
            small = smallest(rest, 3)
            room = capacity - j
            if not small or small[0] > room:
                fix((j,), count[j])
                changed = True
                continue
            fitting = sorted(x for x in rest if rest[x] and x <= room)
            k = fitting[-1]
            at_most_one = len(small) < 2 or small[0] + small[1] > room
            at_most_two = len(small) < 3 or sum(small) > room
            if at_most_one or (at_most_two and best_pair(rest, fitting, room) <= k):
                fix((j, k), 1 if j == k else min(count[j], count[k]))
                changed = True
    return fixed


def smallest(count: Counter, n: int) -> list[int]:
    out: list[int] = []
    for x in sorted(x for x in count if count[x]):
        out += [x] * min(count[x], n - len(out))
        if len(out) == n:
            break
    return out


def best_pair(count: Counter, fitting: list[int], room: int) -> int:
    """The largest sum of two items that fits into ``room``, 0 if no two fit."""
    best, lo, hi = 0, 0, len(fitting) - 1
    while lo <= hi:
        a, b = fitting[lo], fitting[hi]
        if a + b > room or (lo == hi and count[a] < 2):
            hi -= 1
        else:
            best = max(best, a + b)
            lo += 1
    return best


def best_fit(count: Counter, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over equal items at once: bins of equal content are one group with a count."""
    groups: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    rooms: list[int] = []  # sorted free spaces that have groups

    def put(bin_: tuple[int, ...], times: int, room: int) -> None:
        if times:
            if not groups[room]:
                insort(rooms, room)
            groups[room].append((bin_, times))

    for x in sorted(count, reverse=True):
        left = count[x]
        while left:
            at = bisect_right(rooms, x - 1)
            if at < len(rooms):
                room = rooms[at]
                bin_, times = groups[room].pop()
                if not groups[room]:
                    rooms.pop(at)
                use = min(times, left)
                put(bin_, times - use, room)
                put((*bin_, x), use, room - x)
                left -= use
            else:
                each = capacity // x
                full, left = divmod(left, each)
                put((x,) * each, full, capacity - each * x)
                if left:
                    put((x,) * left, 1, capacity - left * x)
                    left = 0
    return [g for gs in groups.values() for g in gs]


def packing_plan(lengths: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first_rank, next_rank, first_sequence, offset, each).

    The pieces of a length with ranks from first_rank up to next_rank go to
    the sequences from first_sequence on, ``each`` to a sequence, the first of
    them at ``offset``. Sequences have no gaps.
    """
    count = Counter({k: v for k, v in lengths.items() if v})
    if any(not 0 < x <= capacity for x in count):
        raise ValueError("lengths must be from 1 to the capacity")
    bins = dominant_bins(count, capacity)
    bins += best_fit(count, capacity)
    plan, ranks, sequence = [], Counter(), 0
    for bin_, times in bins:
        offset = 0
        for x, each in sorted(Counter(bin_).items(), reverse=True):
            plan.append((x, ranks[x], ranks[x] + each * times, sequence, offset, each))
            ranks[x] += each * times
            offset += each * x
        sequence += times
    return plan


PLAN = "length long, first_rank long, next_rank long, first_sequence long, first_offset long, each long"


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Pack every document; one row per piece with its sequence and its place there.

    A null or empty text is one piece that holds the end id alone. Repeated
    rows and null ids are packed like any other row. An empty table gives no
    rows. Columns besides doc_id and text are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    pieces = scratch.write(cut_pieces(docs, path or tokenizer_path(), capacity, end_id), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    lengths = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = F.broadcast(spark.createDataFrame(packing_plan(lengths, capacity), PLAN))
    ranked = pieces.join(firsts, ["part", "length"]).withColumn("rank", F.col("first") + F.col("rank_in_part"))
    step = F.col("rank") - F.col("first_rank")
    return (
        ranked.join(plan, "length")
        .where((F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("next_rank")))
        .select(
            "doc_id",
            "piece",
            "start",
            "length",
            "ids_crc32",
            (F.col("first_sequence") + F.floor(step / F.col("each"))).cast("long").alias("sequence_id"),
            (F.col("first_offset") + step % F.col("each") * F.col("length")).alias("offset"),
        )
    )


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
