"""Secrets in texts: base patterns, and spans that a linear-chain conditional random field adds.

Tokens are tagged as begin, inside or outside of a secret from their own
shape, the kinds of the neighbouring tokens and features of the whole text,
and decoded by Viterbi. The field is trained by exact gradients on a bounded
sample of token windows, whose tags come from the base patterns' matches. In
five of six windows the pattern's own cues are masked: its keyword becomes a
plain word, its marks others or none; and in every second one the secret is in
upper case. So the field has to tell a secret by
its shape and what is left around it, and finds secrets that no pattern does.

Decoding is exact and skips what cannot matter: where no run of tokens could
gain over staying outside by any sum of its best scores, the best path is
outside, so the dynamic programme runs only on the islands between.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table

# Base patterns: fixed values. Letters of the first are matched in either case.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "crf")
LEAST = {"assign": 6, "access": 20, "hex": 24}

TOKEN = r"[\w+/\-]+|[^\w\s+/\-]"
WINDOW = 16  # tokens on either side of a match that a training window holds
WINDOWS = 3000  # training windows with a match, at most; as many without; of distinct texts
SHAPES = 512
FILES = 6
EPOCHS = 150
OUT, BEGIN, INSIDE = 0, 1, 2
KEYWORDS = ("password", "passwd", "pwd", "secret", "token", "key", "apikey", "api_key", "auth", "bearer", "credential", "access")


def base_spans(text: str, patterns=None) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the secret itself) of the base matches, in order of start, then kind."""
    assign, access, hexa = patterns or compiled()
    low, found = text.lower(), []
    if any(word in low for word in ("passw", "secret", "token", "api")):  # without one of them there is no assignment
        found = [(m.start(), 0, m.end(), m.start(2)) for m in assign.finditer(text) if m.end() - m.start(2) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.start()) for m in access.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    # a run of 24 or more is what a greedy run that is long enough matches
    found += [(m.start(), 2, m.end(), m.start()) for m in hexa.finditer(text)]
    return sorted(found)


def compiled():
    return re.compile(ASSIGN, re.I | re.A), re.compile(ACCESS), re.compile(f"[0-9a-f]{{{LEAST['hex']},}}")


def kind_of(token: str) -> int:
    """A coarse kind of a token as a neighbour; 0 is kept for the text's ends."""
    low = token.lower()
    for i, word in enumerate(KEYWORDS):
        if word in low:
            return 1 + i
    base = 1 + len(KEYWORDS)
    if not token[0].isalnum():
        return base + {"=": 0, ":": 1, '"': 2, "'": 3, ".": 4, ",": 5, "|": 6}.get(token[0], 7)
    if token.isdigit():
        return base + 8
    if token.isalpha():
        return base + (9 if token.islower() else 10 if token.istitle() else 11)
    return base + 12


N_KINDS = 1 + len(KEYWORDS) + 13


def shape_of(token: str) -> int:
    """A token's shape: length, character classes, their changes and whether it could be hexadecimal, hashed."""
    if token.isalpha() and token.islower() and token.strip("abcdef"):  # most words; the same key as below
        return hashed(min(len(token), 8) if len(token) <= 8 else 8 + min(len(token) // 4, 12), "l", 0, False, False)
    classes = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.isalpha() else "s" for c in token]
    changes = sum(a != b for a, b in zip(classes, classes[1:], strict=False))
    size = min(len(token), 8) if len(token) <= 8 else 8 + min(len(token) // 4, 12)
    hexadecimal = len(token) >= 6 and all(c in "0123456789abcdefABCDEF" for c in token)
    return hashed(size, "".join(sorted(set(classes))), min(changes, 3) if changes < 4 else 4 + min(changes // 4, 3), hexadecimal, token.startswith("AKIA"))


def hashed(*key) -> int:
    import zlib

    return zlib.crc32(repr(key).encode()) % SHAPES


def file_of(n_tokens: int, n_marks: int, n_keys: int) -> int:
    """A feature of the whole text: how often keywords and assignment marks occur."""
    return (0 if not n_keys else 1 if n_keys < 3 else 2) * 2 + int(n_marks * 20 > n_tokens)


class Features(dict):
    """Shape and kind of tokens, remembered for at most ``most`` of them."""

    def __init__(self, most: int = 400_000):
        self.most = most

    def __missing__(self, token: str) -> int:
        if len(self) > self.most:
            self.clear()
        self[token] = code = shape_of(token) * N_KINDS + kind_of(token)
        return code

    def of(self, tokens: list[str]):
        """(shapes, kinds, feature of the text) of a text's tokens."""
        import numpy as np

        codes = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        kinds = codes % N_KINDS
        marks = ((kinds == 1 + len(KEYWORDS)) | (kinds == 2 + len(KEYWORDS))).sum()
        keys = ((kinds >= 1) & (kinds <= len(KEYWORDS))).sum()
        return codes // N_KINDS, kinds, file_of(len(tokens), int(marks), int(keys))


def weights_of() -> dict:
    import numpy as np

    sizes = {"shape": SHAPES, "before": N_KINDS, "before2": N_KINDS, "after": N_KINDS, "file": FILES}
    weights = {k: np.zeros((n, 3)) for k, n in sizes.items()}
    weights["step"] = np.zeros((3, 3))
    weights["first"] = np.zeros(3)
    return weights


def barred(weights: dict):
    """Transitions and first tags with inside after outside made impossible."""
    import numpy as np

    step, first = weights["step"].copy(), weights["first"].copy()
    step[OUT, INSIDE] = first[INSIDE] = -np.inf
    return step, first


def emissions(weights: dict, shapes, kinds, file: int):
    """Scores of the three tags of every token."""
    import numpy as np

    around = np.concatenate([[0, 0], kinds, [0]])
    n = len(kinds)
    return weights["shape"][shapes] + weights["before"][around[1 : n + 1]] + weights["before2"][around[:n]] + weights["after"][around[3:]] + weights["file"][file]


def viterbi(scores, step, first) -> list[int]:
    """Best tags of one chain."""
    import numpy as np

    best, back = scores[0] + first, []
    for row in scores[1:]:
        paths = best[:, None] + step
        back.append(paths.argmax(0))
        best = paths.max(0) + row
    tags = [int(np.argmax(best))]
    for choice in reversed(back):
        tags.append(int(choice[tags[-1]]))
    return tags[::-1]


def decode(scores, step, first) -> list[tuple[int, int]]:
    """(first, last + 1) of the spans on the best path.

    Every token off the outside path adds at most ``gain`` to a path's score
    over the outside path. Only tokens inside some run with a positive sum of
    gains can be off it; each island of them is decoded between outside tokens.
    """
    import numpy as np

    n = len(scores)
    if not n:
        return []
    stay = step[OUT, OUT]
    enter = max(step[a, b] for a in range(3) for b in (BEGIN, INSIDE) if np.isfinite(step[a, b])) - stay
    enter = max(enter, first[BEGIN] - first[OUT])
    leave = max(0.0, step[BEGIN, OUT] - stay, step[INSIDE, OUT] - stay)
    gain = np.maximum(scores[:, BEGIN], scores[:, INSIDE]) - scores[:, OUT] + enter + leave
    if gain.max() <= 0:
        return []
    sums = np.concatenate([[0.0], np.cumsum(gain)])
    ending = sums[1:] - np.minimum.accumulate(sums[:-1])
    starting = np.maximum.accumulate(sums[1:][::-1])[::-1] - sums[:-1]
    open_ = ending + starting - gain > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], open_.astype(np.int8), [0]])))
    spans = []
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        start = first if a == 0 else step[OUT]
        last = scores[a:b].copy()
        if b < n:
            last[-1] += step[:, OUT]
        at = None
        for i, tag in enumerate([*viterbi(last, step, start), OUT]):
            if tag != INSIDE and at is not None:
                spans.append((a + at, a + i))
                at = None
            if tag == BEGIN:
                at = i
    return spans


def train(windows: list[dict], epochs: int = EPOCHS) -> dict:
    """Weights by gradient ascent on the log-likelihood of the windows' tags, all windows side by side."""
    import numpy as np

    weights = weights_of()
    if not windows:
        weights["first"][BEGIN] = weights["step"][:, BEGIN] = -50.0
        return weights
    length = max(len(w["tags"]) for w in windows)
    m = len(windows)

    def padded(name: str, shift: int = 0):
        out = np.zeros((m, length), np.int64)
        for i, w in enumerate(windows):
            row = w[name]
            out[i, : len(row)] = row if not shift else ([0] * max(shift, 0) + row + [0] * max(-shift, 0))[max(-shift, 0) :][: len(row)]
        return out

    used = {"shape": padded("shapes"), "before": padded("kinds", 1), "before2": padded("kinds", 2), "after": padded("kinds", -1)}
    used["file"] = np.repeat(np.array([w["file"] for w in windows])[:, None], length, 1)
    tags = padded("tags")
    sizes = np.array([len(w["tags"]) for w in windows])
    real = np.arange(length) < sizes[:, None]
    gold = np.eye(3)[tags] * real[..., None]
    moves = np.einsum("mti,mtj->ij", gold[:, :-1], gold[:, 1:])
    seen = {k: np.full(v.shape, 1e-2) for k, v in weights.items()}
    for _ in range(epochs):
        step, first = barred(weights)
        scores = sum(weights[k][v] for k, v in used.items())
        with np.errstate(divide="ignore"):
            alpha, beta = np.zeros((length, m, 3)), np.zeros((length, m, 3))
            alpha[0] = scores[:, 0] + first
            for t in range(1, length):
                moved = np.logaddexp.reduce(alpha[t - 1][:, :, None] + step, axis=1) + scores[:, t]
                alpha[t] = np.where(real[:, t, None], moved, alpha[t - 1])
            total = np.logaddexp.reduce(alpha[-1], axis=1)
            pairs = np.zeros((3, 3))
            for t in range(length - 1, 0, -1):
                ahead = scores[:, t] + beta[t]
                joint = np.exp(alpha[t - 1][:, :, None] + step + ahead[:, None, :] - total[:, None, None])
                pairs += joint[real[:, t]].sum(0)
                beta[t - 1] = np.where(real[:, t, None], np.logaddexp.reduce(step + ahead[:, None, :], axis=2), beta[t])
            shares = np.exp(alpha.transpose(1, 0, 2) + beta.transpose(1, 0, 2) - total[:, None, None]) * real[..., None]
        error = gold - shares
        grads = {}
        for k, places in used.items():
            grads[k] = np.zeros_like(weights[k])
            np.add.at(grads[k], places[real], error[real])
        grads["step"] = moves - pairs
        grads["first"] = error[:, 0].sum(0)
        for k, g in grads.items():
            g = g - 0.02 * weights[k]
            seen[k] += g * g
            weights[k] += 0.4 * g / np.sqrt(seen[k])
    return weights


PLAIN_WORD, OTHER_MARK = 1 + len(KEYWORDS) + 9, 1 + len(KEYWORDS) + 7
# Kinds of =, : and the two quotes.
MARKS = range(1 + len(KEYWORDS), 5 + len(KEYWORDS))


def masked(window: dict) -> dict:
    """The window with the cues of its pattern masked, by its rank.

    The keyword becomes a plain word or stays; the marks between it and the
    secret become another mark, go, or stay: six ways, one of them none.
    """
    if BEGIN not in window["tags"]:
        return window
    columns = [list(window[c]) for c in ("shapes", "kinds", "tags")]
    shapes, kinds, tags = columns
    begin, plain, marks = tags.index(BEGIN), window["rank"] % 2, window["rank"] // 2 % 3
    for i in range(begin - 1, max(-1, begin - 7), -1):
        if plain and 1 <= kinds[i] <= len(KEYWORDS):
            kinds[i] = PLAIN_WORD
        if marks and MARKS.start <= kinds[i] < MARKS.stop:
            if marks == 1:
                kinds[i] = OTHER_MARK
            else:
                for column in columns:
                    del column[i]
    keyed = any(1 <= k <= len(KEYWORDS) for k in kinds)
    return window | {"shapes": shapes, "kinds": kinds, "tags": tags, "file": window["file"] if keyed else window["file"] % 2}


def rank_bounds(docs: DataFrame, most: int) -> dict[bool, int]:
    """For texts with a base match and texts without: the bound below which the hashes of about ``most`` distinct texts lie."""

    def rank(batches: Iterator) -> Iterator:
        import zlib

        import pyarrow as pa

        patterns = compiled()
        for batch in slices(batches):
            texts = [t for t in batch.column(0).to_pylist() if t]
            hits = [bool(base_spans(t, patterns)) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(hits, pa.bool_()), pa.array([zlib.crc32(t.encode()) for t in texts], pa.int64())], names=["hit", "rank"])

    ranks = docs.select("text").mapInArrow(rank, "hit boolean, rank long").distinct()
    # ranks are spread evenly: how many there are up to a bound is counted by 65,536 classes of them
    classes = ranks.groupBy("hit", (F.col("rank") / 65536).cast("int").alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()
    bounds = {}
    for hit in (True, False):
        bounds[hit], taken = 0, 0
        for k, n in sorted((r.k, r.n) for r in classes if r.hit == hit):
            if taken < most:
                bounds[hit], taken = (k + 1) * 65536, taken + n
    return bounds


def training_windows(docs: DataFrame, most: int = WINDOWS) -> list[dict]:
    """Token windows for training: of the ``most`` texts with a base match and the ``most`` without whose hashes are least.

    Copies of a text are one. The bounds are found first, so features are made
    of the chosen texts only, and the choice does not depend on how the rows
    are dealt out.
    """
    schema = "hit boolean, rank long, shapes array<int>, kinds array<int>, tags array<int>, file int"
    bounds = rank_bounds(docs, most)

    def pick(batches: Iterator) -> Iterator:
        import zlib

        import pyarrow as pa

        patterns, token, features = compiled(), re.compile(TOKEN), Features()
        met: dict[bool, set] = {True: set(), False: set()}
        for batch in slices(batches):
            rows = []
            for text in batch.column(0).to_pylist():
                if not text:
                    continue
                rank = zlib.crc32(text.encode())
                if rank >= max(bounds.values()):
                    continue
                spans = base_spans(text, patterns)
                hit = bool(spans)
                if rank >= bounds[hit] or rank in met[hit]:
                    continue
                met[hit].add(rank)
                places = [m.span() for m in token.finditer(text)]
                if not places:
                    continue
                words = [text[a:b] for a, b in places]
                tags = [OUT] * len(places)
                for _, _, end, start in spans:
                    inner = [i for i, (a, b) in enumerate(places) if a >= start and b <= end]
                    for i in inner:
                        tags[i] = INSIDE
                        if rank // 6 % 2:  # secrets in the other case are secrets too
                            words[i] = words[i].upper()
                    if inner:
                        tags[inner[0]] = BEGIN
                shapes, kinds, file = features.of(words)
                middle = tags.index(BEGIN) if BEGIN in tags else rank % len(tags)
                cut = slice(max(0, middle - WINDOW), middle + WINDOW)
                if tags[cut][0] != INSIDE:
                    rows.append((hit, rank, shapes[cut].tolist(), kinds[cut].tolist(), tags[cut], file))
            kinds_ = [pa.bool_(), pa.int64(), *[pa.list_(pa.int32())] * 3, pa.int32()]
            cols = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds_, strict=True)], names=["hit", "rank", "shapes", "kinds", "tags", "file"])

    picked = docs.select("text").mapInArrow(pick, schema).dropDuplicates(["hit", "rank"]).collect()  # about 2 * most
    out = []
    for hit in (True, False):
        rows = sorted((r for r in picked if r.hit == hit), key=lambda r: r.rank)[:most]
        out += [masked(r.asDict()) for r in rows]
    return out


def find_secrets(docs: DataFrame, most: int = WINDOWS, weights: dict | None = None) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Spans are kind:start:end in code points, in order of start, then kind. An
    added span that meets a base span is left out. Null and empty texts have
    none. Repeated rows are searched one by one; a null doc_id stays null. An
    empty table gives no rows, a table without matches trains a field that
    adds nothing. Other columns are ignored. ``weights`` of another training
    may be given; else the field is trained on ``docs``.
    """
    weights = docs.sparkSession.sparkContext.broadcast(train(training_windows(docs, most)) if weights is None else weights)
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"

    def find(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa

        w = weights.value
        step, first = barred(w)
        patterns, token, features = compiled(), re.compile(TOKEN), Features()
        for batch in slices(batches):
            counts: list[list[int]] = [[], [], []]
            digests, listed = [], []
            for text in batch.column(1).to_pylist():
                text = text or ""
                spans = [(a, kind, b) for a, kind, b, _ in base_spans(text, patterns)]
                for kind in range(3):
                    counts[kind].append(sum(s[1] == kind for s in spans))
                digests.append(hashlib.sha256(joined(spans).encode()).hexdigest())
                tokens = token.findall(text)
                added = decode(emissions(w, *features.of(tokens)), step, first) if tokens else []
                if added:
                    places = [m.span() for m in token.finditer(text)]
                    new = [(places[a][0], 3, places[b - 1][1]) for a, b in added]
                    spans = sorted(spans + [x for x in new if not any(x[0] < s[2] and s[0] < x[2] for s in spans)])
                listed.append(joined(spans))
            arrays = [batch.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(digests), pa.array(listed, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.select("doc_id", "text").mapInArrow(find, schema)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in spans)


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))
