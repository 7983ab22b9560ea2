"""SentencePiece encoding and decoding of whole texts.

The encoder finds the segmentation that merging gives without merging the
text. Of all pieces that an Aho-Corasick automaton finds at a place, the longest
is tried first; it may stand behind the piece before it only if re-merging the
two side by side gives the two again. If none may, the place is marked in a
bitfield of failed positions and the search steps back. Merging is local: a
segmentation whose adjacent pieces are all compatible is the one that merging
the whole text ends in, whatever its length.

No merge crosses a border between two characters that stand side by side in no
piece. The text is cut at such borders, as far as the pieces allow: in front of
a blank, between letters and other characters, and around characters that no
longer piece holds. Each distinct chunk is encoded once per Python worker.
Characters of no piece are spelt as bytes.

Defined results: null and empty texts have no ids and decode to ''. Repeated
rows are encoded alike. Texts of any length are encoded whole. An empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, table

MODEL = "piece_bpe_32k.model"
BLANK = "▁"
# Chunks that a Python worker remembers, in two generations; pairs of pieces, beyond which it starts anew.
KEPT_CHUNKS, KEPT_PAIRS = 400_000, 1_000_000
# Longer chunks are encoded each time.
KEPT_LENGTH = 64
TEXTS_AT_ONCE = 256


class PieceEncoder:
    """Chunks of normalised text -> ids, for a merge-type model with byte pieces."""

    def __init__(self, processor):
        import re

        import ahocorasick

        self.processor = processor
        pieces: dict[str, int] = {}
        self.byte_ids: dict[int, int] = {}
        for i in range(processor.get_piece_size()):
            piece = processor.id_to_piece(i)
            if processor.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
            elif processor.is_unused(i):
                raise ValueError("models with unused pieces are not supported")
            elif not (processor.is_control(i) or processor.is_unknown(i)):
                pieces[piece] = i
        if len(self.byte_ids) != 256:
            raise ValueError("the model has no byte pieces")
        # a character that is part of pieces but none itself has a place of its own and is spelt as bytes
        self.spelt = {i: [i] for i in pieces.values()}
        for c in sorted({c for p in pieces for c in p} - pieces.keys()):
            pieces[c] = -1 - len(pieces)
            self.spelt[pieces[c]] = self.as_bytes(c)
        self.pieces = pieces
        self.names = {i: p for p, i in pieces.items()}
        self.known = {c for c in pieces if len(c) == 1}
        self.scores = {p: processor.get_score(i) for p, i in pieces.items() if i >= 0}
        self.lengths = {i: len(p) for p, i in pieces.items()}
        self.shorter = {i: next((pieces[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in pieces), None) for p, i in pieces.items()}
        self.automaton = ahocorasick.Automaton()
        for p, i in pieces.items():
            self.automaton.add_word(p, i)
        self.automaton.make_automaton()
        self.chunk = re.compile(self.chunk_pattern())
        self.fits: dict[int, bool] = {}
        self.met: dict[str, bytes] = {}
        self.met_before: dict[str, bytes] = {}

    def chunk_pattern(self) -> str:
        """A pattern whose matches, end to end, are the chunks that are merged by themselves."""
        import re

        beside = {(p[k], p[k + 1]) for p in self.pieces for k in range(len(p) - 1)}
        if any(a != BLANK and b == BLANK for a, b in beside):
            return r"[\s\S]+"
        joined = {c for pair in beside for c in pair} - {BLANK}
        letters = {c for c in joined if c.isalpha()}
        if any((a in letters) != (b in letters) for a, b in beside if a != BLANK):
            runs = [joined]
        else:
            runs = [letters, joined - letters]
        # any other character stands alone
        return "|".join([f"{BLANK}*[{''.join(map(re.escape, sorted(r)))}]+" for r in runs if r] + [f"{BLANK}+", r"[\s\S]"])

    def as_bytes(self, text: str) -> list[int]:
        return [self.byte_ids[b] for b in text.encode()]

    def merge(self, text: str) -> list[str]:
        """Merges the best-scored adjacent pair, the first of equals, until none is a piece. For single pieces and pairs."""
        parts, scores = list(text), self.scores
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, left: int | None, right: int) -> bool:
        """Whether merging ``left`` and ``right`` side by side leaves both as they are (``right`` alone at a start)."""
        names = [self.names[i] for i in (left, right) if i is not None]
        return self.merge("".join(names)) == names

    def segment(self, text: str) -> list[int]:
        """Pieces of a text whose characters all have a place; by backtracking over places that can still be right."""
        size = len(text)
        longest = [0] * size
        lengths, shorter, fits = self.lengths, self.shorter, self.fits
        # ends come in order, so the last piece set at a start is its longest
        for end, piece in self.automaton.iter(text):
            longest[end - lengths[piece] + 1] = piece
        failed = bytearray(size + 1)
        out: list[int] = []
        at, piece, last, row = 0, longest[0], None, 0
        while True:
            while piece is not None:
                end = at + lengths[piece]
                if not failed[end]:
                    fit = fits.get(row + piece)
                    if fit is None:
                        if len(fits) >= KEPT_PAIRS:
                            fits.clear()
                        fit = fits[row + piece] = self.compatible(last, piece)
                    if fit:
                        break
                piece = shorter[piece]
            if piece is None:
                failed[at] = 1
                if last is None:
                    raise ValueError(f"no segmentation of {text[:40]!r}")
                piece = shorter[out.pop()]
                at -= lengths[last]
                last = out[-1] if out else None
                row = 0 if last is None else (last + 1) << 32
                continue
            if end == size:
                out.append(piece)
                return out
            out.append(piece)
            at, last, row, piece = end, piece, (piece + 1) << 32, longest[end]

    def chunk_ids(self, chunk: str) -> bytes:
        """Little-endian 32-bit ids of a chunk."""
        from array import array

        if self.known.issuperset(chunk):
            ids = self.segment(chunk)
            if min(ids) < 0:
                ids = [i for piece in ids for i in self.spelt[piece]]
        else:  # characters of no piece part it
            ids, run = [], ""
            for c in chunk:
                if c in self.known:
                    run += c
                else:
                    ids += (self.ids_of(run) if run else []) + self.as_bytes(c)
                    run = ""
            ids += self.ids_of(run) if run else []
        out = array("i", ids)
        if sys.byteorder != "little":
            out.byteswap()
        return out.tobytes()

    def ids_of(self, text: str) -> list[int]:
        return [i for piece in self.segment(text) for i in self.spelt[piece]]

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids of a text."""
        if not text:
            return b""
        met = self.met
        chunks = self.chunk.findall(self.processor.normalize(text))
        found = list(map(met.get, chunks))
        if None in found:
            for k in [k for k, ids in enumerate(found) if ids is None]:
                chunk = chunks[k]
                ids = met.get(chunk) or self.met_before.get(chunk) or self.chunk_ids(chunk)
                if len(chunk) <= KEPT_LENGTH:
                    if len(met) >= KEPT_CHUNKS // 2:
                        # what is still in use comes over from the generation before
                        self.met_before, self.met = met, {}
                        met = self.met
                    met[chunk] = ids
                found[k] = ids
        return b"".join(found)


def encoder_for(model: str) -> PieceEncoder:
    """The Python worker's encoder of a model: one of ``public_tokenizers``, or a file that every worker can read."""
    import os
    import sys
    from types import ModuleType

    import sentencepiece

    kept = sys.modules.setdefault("sluice_piece_encoders", ModuleType("sluice_piece_encoders")).__dict__
    if model not in kept:
        path = model
        if not os.path.isabs(model):
            import public_tokenizers

            path = str(public_tokenizers.path(model))
        kept[model] = PieceEncoder(sentencepiece.SentencePieceProcessor(model_file=path))
    return kept[model]


def encode_documents(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, ``ids`` of the whole text without begin or end, and ``decoded``, the text that decoding them gives."""
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])

    def encode(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        encoder = encoder_for(model)
        for batch in slices(batches, TEXTS_AT_ONCE):
            coded = [encoder.encode(t or "") for t in batch.column(1).to_pylist()]
            ends = np.cumsum([0] + [len(b) // 4 for b in coded], dtype=np.int32)
            values = np.frombuffer(b"".join(coded), "<i4")
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))
            decoded = [encoder.processor.decode(values[a:b].tolist()) if b > a else "" for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, pa.array(decoded, pa.string())], names=schema.names)

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(encode, schema)


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_documents(table(spark, sf_dir, "documents"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
