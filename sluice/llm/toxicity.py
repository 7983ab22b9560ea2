"""Toxicity by weak supervision: voters, a generative label model, and a linear classifier on its posterior labels.

Voters are lexicons (general insults, and words and word beginnings learnt
from the labelled training rows) and patterns; each says toxic, clean or
nothing. The label model is a tree: every voter depends on the label and on
the one earlier voter that it agrees with beyond what the label explains, so
correlated voters don't count twice. Its accuracies are estimated by
expectation maximisation on the counts of vote patterns of all training rows.
A logistic regression on the learnt words is fitted to the posterior labels
of a bounded sample; it scores every text.

Labels, language, source and identity are never inputs of a score.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, Words, slices, small_or_shuffled, table
from .lm import remainder_of_id

# General English insults: fixed values.
INSULTS = "idiot moron loser clown fool imbecile dimwit jerk scumbag bastard creep freak"
CONTEMPT = "stupid dumb pathetic worthless disgusting trash garbage scum filth vermin ugly useless"
STEM = 5  # characters of a word beginning
LEXICONS = 4  # voters that share the learnt words
MIN_ROWS = 5  # labelled rows that a learnt word must be in
EVIDENCE = 20.0  # least log-likelihood ratio statistic of a learnt word
SAMPLE = 20_000  # training rows that the classifier is fitted on, at most
ROUNDS = 60
# Share of a voter's entropy from which another voter is taken to repeat it.
REPEATED = 0.7
# Votes of a voter.
NONE, CLEAN, TOXIC = 0, 1, 2


def words_and_stems(name: bytes) -> list[str]:
    """Features of a distinct word: its letters, and its beginning marked by a star."""
    word = name.decode().strip(".,!?;:\"'()[]*#$%&|<>-_").lower()
    if not word:
        return []
    return [word, word[:STEM] + "*"] if len(word) >= STEM else [word]


def each_text(words: Words) -> Iterator:
    """The numbers of each text's distinct words."""
    import numpy as np

    end = 0
    for n in words.sizes.tolist():
        yield np.unique(words.index[end : end + n])
        end += n


def feature_counts(labelled: DataFrame) -> DataFrame:
    """(feature, toxic, clean): labelled rows of either kind that have the feature."""

    def count(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in slices(batches):
            words = Words(batch.column(0))
            toxic = np.array(batch.column(1).to_pylist(), bool)
            found: dict[str, list[int]] = {}
            features = [words_and_stems(w) for w in words.names]
            for is_toxic, numbers in zip(toxic.tolist(), each_text(words), strict=True):
                for f in {f for i in numbers.tolist() for f in features[i]}:
                    found.setdefault(f, [0, 0])[is_toxic] += 1
            arrays = [pa.array(list(found), pa.string())] + [pa.array([v[k] for v in found.values()], pa.int64()) for k in (1, 0)]
            yield pa.RecordBatch.from_arrays(arrays, names=["feature", "toxic", "clean"])

    counted = labelled.select("text", "toxic").mapInArrow(count, "feature string, toxic long, clean long")
    return counted.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def learnt_features(labelled: DataFrame) -> list[tuple[str, float]]:
    """All features with evidence for one label, the strongest first, with their log odds."""
    totals = labelled.agg(F.sum(F.col("toxic").cast("long")), F.count(F.lit(1))).first()
    toxic, n = totals[0] or 0, totals[1]
    odds = F.log((F.col("toxic") + 0.5) / F.lit(toxic + 1.0)) - F.log((F.col("clean") + 0.5) / F.lit(n - toxic + 1.0))
    seen = feature_counts(labelled).where(F.col("toxic") + F.col("clean") >= MIN_ROWS)
    rate = (toxic + 0.5) / (n + 1.0)

    def part(c: str, share: float):
        expected = (F.col("toxic") + F.col("clean")) * F.lit(share)
        return F.when(F.col(c) > 0, 2 * F.col(c) * F.log(F.col(c) / expected)).otherwise(0.0)

    scored = seen.withColumns({"odds": odds, "evidence": part("toxic", rate) + part("clean", 1 - rate)})
    found = scored.where(F.col("evidence") >= EVIDENCE).select("feature", "odds", "evidence").collect()
    return [(r.feature, r.odds) for r in sorted(found, key=lambda r: (-r.evidence, r.feature))]


def voters_of(features: list[tuple[str, float]]) -> dict:
    """What the voters look for."""
    strong = [f for f, odds in features if odds > 2.0]
    whole = [f for f in strong if not f.endswith("*")]
    return {
        "lexicons": [set(INSULTS.split()), set(CONTEMPT.split())] + [set(whole[k::LEXICONS]) for k in range(LEXICONS)],
        "stems": {f for f in strong if f.endswith("*")},
        "clean": {f for f, odds in features if odds < -1.0},
        "any": set(strong) | set(INSULTS.split()) | set(CONTEMPT.split()),
    }


def votes_of(found: set[str], n_words: int, shouted: bool, voters: dict) -> list[int]:
    """Votes on a text by its features, its number of distinct words, and whether most of its letters are capitals."""
    votes = [TOXIC if found & lexicon else NONE for lexicon in voters["lexicons"]]
    stems, hits = len(found & voters["stems"]), len(found & voters["any"])
    votes.append(TOXIC if stems >= 2 else CLEAN if not stems and n_words >= 10 else NONE)
    votes.append(TOXIC if hits * 25 >= max(n_words, 25) else CLEAN if not hits else NONE)
    votes.append(TOXIC if shouted and hits else NONE)
    votes.append(CLEAN if len(found & voters["clean"]) >= 3 and not hits else NONE)
    return votes


def is_shouted(text: bytes) -> bool:
    """Whether most of more than 20 ASCII letters are capitals."""
    capitals, small = (len(text) - len(text.translate(None, a)) for a in (string.ascii_uppercase.encode(), string.ascii_lowercase.encode()))
    return capitals + small > 20 and capitals > small


class LabelModel:
    """P(label) and, along a tree, P(vote | label, parent's vote), from counts of vote patterns."""

    def __init__(self, patterns: list[tuple[list[int], int]], rounds: int = ROUNDS):
        import numpy as np

        votes = np.array([p for p, _ in patterns], np.int64).reshape(len(patterns), -1)
        weights = np.array([n for _, n in patterns], float)
        majority = (votes == TOXIC).sum(1) - 0.5 * (votes == CLEAN).sum(1)
        posterior = np.where(majority > 0, 0.9, 0.05)
        # voters that all but repeat another are tied to it from the start, lest they outvote the rest together
        self.parents = self.correlated(votes, weights, np.zeros(len(votes)), REPEATED)
        for at in range(rounds):
            self.fit(votes, weights, posterior)
            posterior = self.posterior(votes)
            if at == rounds // 2:
                self.parents = self.correlated(votes, weights, posterior)

    def fit(self, votes, weights, posterior) -> None:
        import numpy as np

        share = np.stack([weights * (1 - posterior), weights * posterior])
        self.prior = (share.sum(1) + 1) / (share.sum() + 2)
        self.tables = []
        for j, parent in enumerate(self.parents):
            seen = np.full((2, 3, 3), 0.5)
            above = votes[:, parent] if parent >= 0 else np.zeros(len(votes), np.int64)
            for y in (0, 1):
                np.add.at(seen[y], (above, votes[:, j]), share[y])
            self.tables.append(seen / seen.sum(2, keepdims=True))

    def posterior(self, votes):
        import numpy as np

        logs = np.tile(np.log(self.prior), (len(votes), 1))
        for j, parent in enumerate(self.parents):
            above = votes[:, parent] if parent >= 0 else np.zeros(len(votes), np.int64)
            logs += np.log(self.tables[j][:, above, votes[:, j]]).T
        return 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -50, 50)))

    def correlated(self, votes, weights, posterior, least: float = 0.0) -> list[int]:
        """For each voter the earlier voter with the most information about it beyond the label, if it is notable.

        ``least`` asks for that share of the voter's own entropy.
        """
        import numpy as np

        share = np.stack([weights * (1 - posterior), weights * posterior])
        parents = [-1] * votes.shape[1]
        for j in range(votes.shape[1]):
            shares = np.bincount(votes[:, j], weights, 3) / max(weights.sum(), 1.0)
            best = max(0.01, least * -float((shares * np.log(np.maximum(shares, 1e-12))).sum()))
            for i in range(j):
                gain = 0.0
                for y in (0, 1):
                    joint = np.full((3, 3), 1e-9)
                    np.add.at(joint, (votes[:, i], votes[:, j]), share[y])
                    joint /= max(weights.sum(), 1.0)
                    apart = joint.sum(1, keepdims=True) * joint.sum(0) / max(joint.sum(), 1e-12)
                    gain += float((joint * np.log(joint / apart)).sum())
                if gain > best:
                    best, parents[j] = gain, i
        return parents


def voted(docs: DataFrame, features: list[tuple[str, float]]) -> DataFrame:
    """(votes, numbers, size, order): votes on each text, its features' numbers and its number of distinct words."""
    sent = docs.sparkSession.sparkContext.broadcast((voters_of(features), {f: i for i, (f, _) in enumerate(features)}))

    def vote(batches: Iterator) -> Iterator:
        import pyarrow as pa

        voters, numbers_of = sent.value
        wanted = voters["any"] | set(numbers_of)
        for batch in slices(batches):
            words = Words(batch.column(0))
            features = [[f for f in words_and_stems(w) if f in wanted] for w in words.names]
            votes, numbers, sizes = [], [], []
            for text, own in zip(batch.column(0).to_pylist(), each_text(words), strict=True):
                listed = [f for i in own.tolist() for f in features[i]]
                votes.append(votes_of(set(listed), len(own), is_shouted((text or "").encode()), voters))
                numbers.append(sorted(numbers_of[f] for f in set(listed) if f in numbers_of))
                sizes.append(len(own))
            arrays = [pa.array(votes, pa.list_(pa.int32())), pa.array(numbers, pa.list_(pa.int32())), pa.array(sizes, pa.int32()), batch.column(1)]
            yield pa.RecordBatch.from_arrays(arrays, names=["votes", "numbers", "size", "place"])

    return docs.select("text", "place").mapInArrow(vote, "votes array<int>, numbers array<int>, size int, place long")


def fit_classifier(rows: list[tuple[list[int], float]], n: int, rounds: int = 200):
    """Logistic regression on binary features against labels from 0 to 1, by accelerated gradient steps; (weights, bias)."""
    import numpy as np

    if not rows:
        return np.zeros(n), -2.0
    lengths = np.array([len(x) for x, _ in rows])
    columns = np.array([i for x, _ in rows for i in x], np.int64)
    owners = np.repeat(np.arange(len(rows)), lengths)
    goal = np.array([p for _, p in rows])
    w, bias, seen, seen_bias = np.zeros(n), -1.0, np.full(n, 1e-3), 1e-3
    for _ in range(rounds):
        z = bias + np.bincount(owners, w[columns], len(rows))
        error = goal - 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        grad = np.bincount(columns, error[owners], n) - 0.05 * w
        seen += grad * grad
        seen_bias += error.sum() ** 2
        w += 0.3 * grad / np.sqrt(seen)
        bias += 0.3 * error.sum() / seen_bias**0.5
    return w, bias


def score_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Null and empty texts have no features and score the bias. Learns labels
    only from rows that are not held out; a row without a label still votes.
    Repeated rows are scored one by one; a repeated label counts once, its
    highest value. Without labels the fixed lexicons and patterns vote alone.
    A null doc_id counts as an empty text for the fold and has no label.
    Empty tables give no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "toxicity")
    docs = docs.select("doc_id", "text", (remainder_of_id(5) == 0).alias("held_out"))
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    train = docs.where("not held_out")
    labelled = train.join(small_or_shuffled(known), "doc_id").select("text", (F.col("toxic") == 1).alias("toxic"))
    features = learnt_features(labelled)

    votes = scratch.write(voted(train.select("text", F.xxhash64("text").alias("place")), features), "votes")
    patterns = [(r.votes, r.n) for r in votes.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()]
    model = LabelModel(patterns) if patterns else None
    # texts' hashes are spread evenly, so a bound on them takes about ``sample`` of the distinct texts; copies of one are one
    distinct = votes.agg(F.approx_count_distinct("place", 0.01)).first()[0] or 1
    bound = int(min(1.0, sample / distinct) * (1 << 64)) - (1 << 63)
    few = votes.where(F.col("place") < F.lit(bound)) if bound < (1 << 63) else votes
    taken = sorted(few.dropDuplicates(["place"]).select("place", "votes", "numbers").collect())
    import numpy as np

    posterior = model.posterior(np.array([r.votes for r in taken], np.int64)) if taken else []
    weights, bias = fit_classifier([(r.numbers, float(p)) for r, p in zip(taken, posterior, strict=True)], len(features))
    out = scratch.write(linear_scores(docs, {f: float(w) for (f, _), w in zip(features, weights, strict=True)}, float(bias)), "scores")
    scratch.drop(votes)
    return out


def linear_scores(docs: DataFrame, weights: dict[str, float], bias: float) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int"

    def score(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        weight = sent.value
        for batch in slices(batches):
            words = Words(batch.column(2))
            features = [[f for f in words_and_stems(w) if f in weight] for w in words.names]
            scores = []
            for own in each_text(words):
                scores.append(bias + sum(weight[f] for f in {f for i in own.tolist() for f in features[i]}))
            p = 1 / (1 + np.exp(-np.clip(np.array(scores, float), -500, 500)))
            arrays = [batch.column(0), batch.column(1), pa.array(p), pa.array((p >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "held_out", "score", "predicted"])

    return docs.select("doc_id", "held_out", "text").mapInArrow(score, schema)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
