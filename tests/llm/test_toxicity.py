import random
import zlib

import numpy as np

from sluice.llm import toxicity


def rows(n=500):
    rng = random.Random(6)
    texts, marks = [], []
    for k in range(n):
        words = [f"w{rng.randrange(300)}" for _ in range(60)]
        toxic = k % 5 == 0
        if toxic:  # half by general insults, half by words that only the labels tell of
            words[5:8] = ["idiot", "stupid,", "Moron!"] if k % 10 == 0 else ["grobzz", "grobzzen", "grobzzig"]
        texts.append(" ".join(words))
        marks.append(int(toxic))
    return texts, marks


def test_held_out_accuracy(spark, documents):
    texts, marks = rows()
    labels = spark.createDataFrame([(i, 1, m) for i, m in enumerate(marks)] + [(None, 1, 1), (3, 1, None), (0, 0, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.score_toxicity(documents([*texts, None, ""]), labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for i, r in got.items())
    held = [i for i in range(len(texts)) if got[i].held_out]
    assert np.mean([got[i].predicted == marks[i] for i in held]) > 0.97
    assert not got[len(texts)].predicted and got[len(texts)].score == got[len(texts) + 1].score


def test_held_out_labels_are_not_learnt(spark, documents):
    texts, marks = rows(200)
    flipped = [1 - m if zlib.crc32(str(i).encode()) % 5 == 0 else m for i, m in enumerate(marks)]
    scores = []
    for m in (marks, flipped):
        labels = spark.createDataFrame(list(enumerate(m)), "doc_id long, toxic int")
        scores.append(sorted((r.doc_id, r.score) for r in toxicity.score_toxicity(documents(texts), labels).collect()))
    assert scores[0] == scores[1]


def test_label_model_does_not_count_correlated_voters_twice():
    rng = random.Random(1)
    patterns = {}
    for _ in range(20_000):
        y = rng.random() < 0.3
        a, b = (2 if y == (rng.random() < 0.9) else 1 for _ in range(2))
        c = 2 if y == (rng.random() < 0.8) else 1
        key = (a, b, c, c, c)  # the last two repeat the third
        patterns[key] = patterns.get(key, 0) + 1
    model = toxicity.LabelModel([(list(k), n) for k, n in patterns.items()])
    assert model.parents[3:] == [2, 3] or model.parents[3:] == [2, 2]
    both, three = model.posterior(np.array([[2, 2, 1, 1, 1], [1, 1, 2, 2, 2]]))
    assert both > 0.5 > three


def test_without_labels_and_empty_tables(spark, documents):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert len(toxicity.score_toxicity(documents(["you idiot", "a kind word"]), none).collect()) == 2
    assert toxicity.score_toxicity(documents([]), none).collect() == []


def test_every_word_with_evidence_is_learnt(spark):
    # each word of the last toxic texts has less evidence than the 3,500 words of the first
    many, rare = " ".join(f"{i:04x}" for i in range(3500)), "zzyx"
    texts = [(many, True)] * 20 + [(rare, True)] * 10 + [(f"c{i}", False) for i in range(120)]
    features = dict(toxicity.learnt_features(spark.createDataFrame(texts, "text string, toxic boolean")))
    assert len(features) == 3501 and features[rare] > 2.0


def test_posteriors_equal_sums_over_the_labels():
    """The label model's posterior against a product of its own probabilities, taken one by one."""
    import itertools
    import random

    import numpy as np

    rng = random.Random(2)
    patterns = []
    for _ in range(400):
        toxic = rng.random() < 0.3
        votes = [rng.choice([0, 1, 2]) if rng.random() < 0.3 else (toxicity.TOXIC if toxic else toxicity.CLEAN) for _ in range(3)]
        patterns.append(([*votes, votes[0] if rng.random() < 0.9 else toxicity.NONE], rng.randint(1, 5)))  # the last follows the first
    model = toxicity.LabelModel(patterns)
    assert model.parents[3] == 0
    every = np.array(list(itertools.product(range(3), repeat=4)))
    got = model.posterior(every)
    for votes, p in zip(every.tolist(), got.tolist(), strict=True):
        joint = []
        for y in (0, 1):
            of = model.prior[y]
            for j, parent in enumerate(model.parents):
                of *= model.tables[j][y][votes[parent] if parent >= 0 else 0][votes[j]]
            joint.append(of)
        assert abs(p - joint[1] / sum(joint)) < 1e-9
    # what the model takes for probabilities are such
    assert abs(sum(model.prior) - 1) < 1e-9 and all(np.allclose(t.sum(2), 1) for t in model.tables)


def test_classifier_comes_to_the_optimum_of_a_plain_one():
    import random

    import numpy as np

    rng = random.Random(4)
    rows = [(sorted(rng.sample(range(6), rng.randint(0, 4))), rng.random()) for _ in range(300)]
    x = np.zeros((300, 6))
    for i, (columns, _) in enumerate(rows):
        x[i, columns] = 1
    goal = np.array([p for _, p in rows])
    w, bias = np.zeros(6), 0.0
    for _ in range(20_000):  # plain gradient steps on the same objective
        error = goal - 1 / (1 + np.exp(-(x @ w + bias)))
        w += 0.01 * (x.T @ error - 0.05 * w)
        bias += 0.01 * error.sum()
    got, got_bias = toxicity.fit_classifier(rows, 6, 3000)
    assert np.abs(got - w).max() < 0.02 and abs(got_bias - bias) < 0.02


def test_a_hot_text_does_not_fill_the_sample(documents, spark):
    """Copies of one text, more than the sample, leave room for the rest: scores tell the toxic texts apart."""
    words = "river stone winter garden music letter window bread horse market".split()
    clean = [" ".join(words[(i + k) % 10] for k in range(8)) + f" n{i}" for i in range(120)]
    toxic = [f"you worthless idiot {w} moron {i}" for i, w in enumerate(words * 12)]
    texts = [clean[0]] * 2000 + clean + toxic
    labels = spark.createDataFrame([(i, 0, int(i >= 2120)) for i in range(2000, len(texts))], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(documents(texts), labels, sample=150).collect()}
    assert min(got[i] for i in range(2120, len(texts))) > max(got[i] for i in range(2000, 2120))
