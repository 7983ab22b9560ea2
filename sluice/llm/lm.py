"""Language-model scores: a log-bilinear model trained in numpy with noise-contrastive estimation.

The model's symbols are the most frequent words and, for all other words,
classes by their first letters; inside a class words go by their corpus
counts. A symbol's score given the two symbols before it is bilinear:
(r1 * c1 + r2 * c2) . q + b. So exp(score) is a product of one factor for each
context symbol, and one matrix product gives the normaliser of every context.

All training tokens are counted and all are trained on, in the tasks that
read them; the tasks' parameters are averaged by a grouped sum. Parameters,
tables and the words sent to the tasks are bounded by the settings below,
whatever the corpus; counts of all rarer words are joined by a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, Words, gathered, slices, table

HEADS, TAILS = 768, 256
SENT_WORDS = 200_000
DIMENSIONS = 16
NOISE = 32
MINIBATCH = 2048
# Texts whose words a task shuffles together.
TRAINED_TEXTS = 128
RATE = 0.1
ROUNDS = 1
SMOOTH = 0.1
END = ""
CACHED_WORDS = 500_000


def remainder_of_id(n: int) -> Column:
    """crc32 of the doc_id as text, modulo ``n``; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "utf-8")), F.lit(n))


def tail_class(token: Column, tails: int) -> Column:
    return F.pmod(F.crc32(F.encode(F.substring(token, 1, 2), "utf-8")), F.lit(tails)).cast("int")


def tail_class_of(word: str, tails: int) -> int:
    import zlib

    return zlib.crc32(word[:2].encode()) % tails


def count_words(docs: DataFrame) -> DataFrame:
    """(token, c): tokens of the texts with their counts; each text ends with one END."""

    def count(batches: Iterator) -> Iterator:
        from collections import Counter

        import numpy as np
        import pyarrow as pa

        def flush(counts: Counter):
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["token", "c"])

        counts: Counter = Counter()
        for batch in slices(batches):
            words = Words(batch.column(0))
            for word, c in zip(map(bytes.decode, words.names), np.bincount(words.index, minlength=len(words.names)).tolist(), strict=True):
                counts[word] += c
            counts[END] += batch.num_rows
            if len(counts) > CACHED_WORDS:
                yield flush(counts)
                counts = Counter()
        yield flush(counts)

    return docs.select("text").mapInArrow(count, "token string, c long").groupBy("token").agg(F.sum("c").alias("c"))


class Vocabulary:
    """What tasks know about words: the sent words with their counts, symbols, and the tail classes' totals."""

    def __init__(self, sent: list[tuple[str, int]], tail_sums: dict[int, tuple[int, int]], n: int, v: int, heads: int, tails: int):
        import numpy as np

        self.heads, self.tails, self.n, self.v = min(heads, len(sent)), tails, n, v
        self.symbols = self.heads + tails
        words = [w for w, _ in sent]
        self.place = {w: i for i, w in enumerate(words)}
        c = np.array([c for _, c in sent], np.float64)
        self.base = np.log10((c + SMOOTH) / self.base_total)
        self.tail_total = np.full(tails, SMOOTH)
        tail_counts = np.zeros(tails)
        for k, (count, distinct) in tail_sums.items():
            self.tail_total[k] += count + SMOOTH * distinct
            tail_counts[k] = count
        self.symbol = np.array([i if i < self.heads else self.heads + tail_class_of(w, tails) for i, w in enumerate(words)], np.int64)
        self.inside = np.zeros(len(words))
        tail = np.arange(len(words)) >= self.heads
        self.inside[tail] = np.log10((c[tail] + SMOOTH) / self.tail_total[self.symbol[tail] - self.heads])
        share = np.concatenate([c[: self.heads], tail_counts]) + 1.0
        self.share = share / share.sum()

    @classmethod
    def opened(cls, sent) -> Vocabulary:
        """The vocabulary that was broadcast as plain data."""
        out = cls.__new__(cls)
        out.__dict__.update(sent.value)
        return out

    @property
    def base_total(self) -> float:
        return self.n + SMOOTH * (self.v + 1)

    def places_of(self, names: list[str]):
        """For each word its place among the sent words, or -1 - symbol for any other word."""
        import numpy as np

        return np.fromiter((self.place[w] if w in self.place else -1 - self.heads - tail_class_of(w, self.tails) for w in names), np.int64, len(names))


def symbols_of(vocabulary: Vocabulary, places):
    import numpy as np

    return np.where(places >= 0, vocabulary.symbol[np.maximum(places, 0)] if len(vocabulary.symbol) else 0, -1 - places)


def first_parameters(vocabulary: Vocabulary, dimensions: int) -> dict:
    import numpy as np

    rng = np.random.default_rng(20)
    m = vocabulary.symbols
    return {
        "r": rng.normal(0, 0.1, (m, dimensions)).astype(np.float32),
        "q": rng.normal(0, 0.1, (m, dimensions)).astype(np.float32),
        "c": np.ones((2, dimensions), np.float32),
        "b": np.log(vocabulary.share).astype(np.float32)[:, None],
    }


class Trainer:
    """Noise-contrastive steps with per-parameter rates (Adagrad); one noise sample set a minibatch."""

    def __init__(self, parameters: dict, share, noise: int, rate: float, seed: int):
        import numpy as np

        self.p = {k: v.copy() for k, v in parameters.items()}
        self.seen = {k: np.full(v.shape, 1e-2, np.float32) for k, v in self.p.items()}
        self.share, self.noise, self.rate = share, noise, rate
        self.log_noise = np.log(noise * share).astype(np.float32)
        self.rng = np.random.default_rng(seed)
        self.cumulated = np.cumsum(share)

    def step(self, name: str, rows, grads) -> None:
        """Sum the gradients of each row, then move the rows."""
        import numpy as np

        order = np.argsort(rows, kind="stable")
        rows, grads = rows[order], grads[order]
        first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        rows, total = rows[first], np.add.reduceat(grads, first, axis=0)
        self.seen[name][rows] += total * total
        self.p[name][rows] += self.rate * total / np.sqrt(self.seen[name][rows])

    def train(self, word, one, two) -> None:
        """Words with the symbols one and two places before them."""
        import numpy as np

        r, q, c, b = (self.p[k] for k in ("r", "q", "c", "b"))
        noise = np.minimum(np.searchsorted(self.cumulated, self.rng.random(self.noise)), len(self.share) - 1)
        r1, r2 = r[one], r[two]
        h = r1 * c[0] + r2 * c[1]
        qw, qn = q[word], q[noise]
        good = np.einsum("ij,ij->i", h, qw) + b[word, 0] - self.log_noise[word]
        bad = h @ qn.T + (b[noise, 0] - self.log_noise[noise])
        good = 1 / (1 + np.exp(np.clip(good, -30, 30)))
        bad = -1 / (1 + np.exp(np.clip(-bad, -30, 30)))
        dh = good[:, None] * qw + bad @ qn
        dc = np.stack([(dh * r1).sum(0), (dh * r2).sum(0)])
        self.step("q", np.concatenate([word, noise]), np.concatenate([good[:, None] * h, bad.T @ h]))
        self.step("b", np.concatenate([word, noise]), np.concatenate([good, bad.sum(0)])[:, None])
        self.step("r", np.concatenate([one, two]), np.concatenate([dh * c[0], dh * c[1]]))
        self.step("c", np.arange(2), dc / math.sqrt(len(word)))


def contexts(symbols, ends):
    """Symbols one and two places before each; before a text's start stands its own END symbol."""
    import numpy as np

    end = symbols[ends[0] - 1]
    starts = np.concatenate([[0], ends[:-1]])
    one, two = np.empty_like(symbols), np.empty_like(symbols)
    one[1:], two[2:] = symbols[:-1], symbols[:-2]
    one[starts] = end
    two[starts] = end
    second = starts + 1
    two[second[second < ends]] = end
    return one, two


def placed_words(vocabulary: Vocabulary, texts):
    """(places of all words of an Arrow array of texts, END after each text; ends of the texts; the words themselves by number)."""
    import numpy as np

    words = Words(texts)
    names = [*map(bytes.decode, words.names), END]
    ends = np.cumsum(words.sizes + 1)
    index = np.full(int(ends[-1]), len(names) - 1, np.int64)
    index[gathered(ends - words.sizes - 1, words.sizes)] = words.index
    return vocabulary.places_of(names)[index], ends, names, index


def train_round(docs: DataFrame, sent, parameters: dict, noise: int, rate: float) -> dict:
    """One pass over all texts, in every task from the same parameters; returns the average weighted by tokens."""
    import numpy as np

    spark = docs.sparkSession
    start = spark.sparkContext.broadcast(parameters)
    width = parameters["r"].shape[1]
    cells = [f"x{i}" for i in range(width)]
    schema = ", ".join(["name string", "row int", "weight double", *(f"{c} double" for c in cells)])

    def learn(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        vocabulary = Vocabulary.opened(sent)
        trainer = Trainer(start.value, vocabulary.share, noise, rate, TaskContext.get().partitionId())
        tokens = 0
        for batch in slices(batches, TRAINED_TEXTS):
            found, ends, _, _ = placed_words(vocabulary, batch.column(0))
            symbols = symbols_of(vocabulary, found)
            one, two = contexts(symbols, ends)
            order = trainer.rng.permutation(len(symbols))
            for at in range(0, len(order), MINIBATCH):
                part = order[at : at + MINIBATCH]
                trainer.train(symbols[part], one[part], two[part])
            tokens += len(symbols)
        if tokens:
            for name, value in trainer.p.items():
                wide = np.zeros((len(value), width))
                wide[:, : value.shape[1]] = value
                arrays = [pa.array([name] * len(value)), pa.array(range(len(value)), pa.int32()), pa.array([float(tokens)] * len(value))]
                arrays += [pa.array(wide[:, i]) for i in range(width)]
                yield pa.RecordBatch.from_arrays(arrays, names=["name", "row", "weight", *cells])

    learnt = docs.select("text").mapInArrow(learn, schema)
    mean = learnt.groupBy("name", "row").agg(*[(F.sum(F.col(c) * F.col("weight")) / F.sum("weight")).alias(c) for c in cells])
    out = {k: v.copy() for k, v in parameters.items()}
    for row in mean.collect():  # one row for each symbol and kind: bounded by the settings
        out[row["name"]][row["row"]] = row[2 : 2 + out[row["name"]].shape[1]]
    start.unpersist()
    return out


def normalised_tables(p: dict):
    """Score parts by the first and the second context symbol, and log normalisers of every pair of them."""
    import numpy as np

    one = (p["r"] * p["c"][0]).astype(np.float64) @ p["q"].T
    two = (p["r"] * p["c"][1]).astype(np.float64) @ p["q"].T + p["b"][:, 0]
    top_one, top_two = one.max(1, keepdims=True), two.max(1, keepdims=True)
    z = np.exp(one - top_one) @ np.exp(two - top_two).T
    return one.astype(np.float32), two.astype(np.float32), (np.log(z) + top_one + top_two.T).astype(np.float32)


def score_texts(docs: DataFrame, sent, tables) -> DataFrame:
    """Scores of all texts as far as the sent words go, with the other words listed in ``rare``."""
    id_type = docs.schema["doc_id"].dataType
    schema = f"row_key long, doc_id {id_type.simpleString()}, held_out boolean, n_tokens long, n_known long, base double, score double, rare array<string>"

    def score(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        vocabulary, (t1, t2, tz) = Vocabulary.opened(sent), tables.value
        key = TaskContext.get().partitionId() << 36
        # what a place adds; the last cell is for words that are not sent
        base, inside = np.append(vocabulary.base, 0.0), np.append(vocabulary.inside, 0.0)
        for batch in slices(batches):
            found, ends, names, index = placed_words(vocabulary, batch.column(2))
            symbols = symbols_of(vocabulary, found)
            one, two = contexts(symbols, ends)
            logs = (t1[one, symbols].astype(np.float64) + t2[two, symbols] - tz[one, two]) / math.log(10)
            known = found >= 0
            cell = np.where(known, found, len(base) - 1)
            starts = np.concatenate([[0], ends[:-1]])
            sums = [np.add.reduceat(x, starts) for x in (known.astype(np.int64), base[cell], logs + inside[cell])]
            away = index[~known]
            cuts = np.concatenate([[0], np.cumsum(~known)[ends - 1]]).astype(np.int32)
            rare = pa.ListArray.from_arrays(pa.array(cuts), pa.array(names, pa.string()).take(pa.array(away)))
            n = batch.num_rows
            arrays = [pa.array(range(key, key + n), pa.int64()), batch.column(0), batch.column(1)]
            arrays += [pa.array(ends - starts), pa.array(sums[0]), pa.array(sums[1]), pa.array(sums[2]), rare]
            yield pa.RecordBatch.from_arrays(arrays, names=["row_key", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "rare"])
            key += n

    return docs.select("doc_id", "held_out", "text").mapInArrow(score, schema)


def frequent_words(counts: DataFrame, most: int, least: int) -> list:
    """Rows of at most ``most`` of the most frequent words, by count and word; ``least`` at least, if there are so many.

    A bound on the count is found from how many words each class of counts
    has, so no more than these rows come to the driver.
    """
    classed = counts.withColumn("class", F.floor(F.log2("c") * 16).cast("int"))
    sizes = sorted(((r["class"], r.n) for r in classed.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    bound, taken, beyond = None, 0, None
    for k, n in sizes:
        if taken + n > most:
            beyond = k
            break
        bound, taken = k, taken + n
    rows = classed.where(F.col("class") >= bound).collect() if bound is not None else []
    if taken < least and beyond is not None:  # many words of about the same count
        rows += classed.where(F.col("class") == beyond).orderBy(F.desc("c"), "token").limit(least - taken).collect()
    return sorted(rows, key=lambda r: (-r.c, r.token))


def score_documents(docs: DataFrame, heads: int = HEADS, tails: int = TAILS, sent_words: int = SENT_WORDS, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the documents that are not held out. Null and empty texts are
    one END token. Repeated rows are scored one by one. A null doc_id counts
    as an empty text for the fold. Without training documents every score
    comes from the smoothing alone. Empty tables give no rows; other columns
    are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lm")
    docs = docs.select("doc_id", "text", (remainder_of_id(10) == 0).alias("held_out"))
    train = docs.where("not held_out")
    counts = scratch.write(count_words(train).where("c > 0"), "counts")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    sent_list = [(r.token, r.c) for r in frequent_words(counts, max(sent_words, heads), heads)]
    head_rows = [(w,) for w, _ in sent_list[:heads]]
    tail = counts
    if head_rows:
        tail = counts.join(F.broadcast(spark.createDataFrame(head_rows, "token string")), "token", "left_anti")
    sums = tail.groupBy(tail_class(F.col("token"), tails).alias("k")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect()
    vocabulary = Vocabulary(sent_list, {r.k: (r.c, r.n) for r in sums}, n, v, heads, tails)
    sent = spark.sparkContext.broadcast(vars(vocabulary))

    parameters = first_parameters(vocabulary, DIMENSIONS)
    for _ in range(rounds):
        parameters = train_round(train, sent, parameters, NOISE, RATE)
    tables = spark.sparkContext.broadcast(normalised_tables(parameters))
    scored = scratch.write(score_texts(docs, sent, tables), "scored")

    totals = F.broadcast(spark.createDataFrame([(k, float(x)) for k, x in enumerate(vocabulary.tail_total)], "k int, total double"))
    rare = scored.select("row_key", F.explode("rare").alias("token")).groupBy("row_key", "token").agg(F.count(F.lit(1)).alias("times"))
    c = F.coalesce("c", F.lit(0)) + F.lit(SMOOTH)
    joined = rare.join(counts, "token", "left").withColumn("k", tail_class(F.col("token"), tails)).join(totals, "k")
    extra = joined.groupBy("row_key").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.log10(c / F.lit(vocabulary.base_total))).alias("more_base"),
        F.sum(F.col("times") * F.log10(c / F.col("total"))).alias("more_score"),
    )
    both = scored.drop("rare").join(extra, "row_key", "left")

    def added(a: str, b: str) -> Column:
        return F.col(a) + F.coalesce(b, F.lit(0))

    return both.select(
        "doc_id",
        "held_out",
        "n_tokens",
        added("n_known", "more_known").cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        added("base", "more_base").alias("base_score"),
        added("score", "more_score").alias("score"),
    )


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
