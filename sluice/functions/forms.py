"""Form-encoded parameter parsing (``a=1&b=2``) as one map expression.

Semantics follow a standard form parser: pieces split on ``&``, empty pieces
skipped, ``key=value`` split at the first ``=`` (a bare ``key`` has value
``""``), both halves percent-decoded with ``+`` meaning a space, a piece with a
malformed escape dropped. When several texts are given (body, then query) their
pieces are concatenated in that order and the **first** value of a key wins.

Keys are decoded before repeats are told, so ``a=1&%61=2`` has one key. No
session setting is involved: repeats are gone before the map is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# a '%' not followed by two hex digits: the piece cannot be decoded
_MALFORMED = r"%(?![0-9A-Fa-f]{2})"
_MAP = "map<string,string>"


def _decode(text: Column) -> Column:
    """Percent/plus decoding, skipped for text that has neither (most parameters)."""
    return F.when((F.instr(text, "%") > 0) | (F.instr(text, "+") > 0), F.url_decode(text)).otherwise(text)


def _entries(joined: Column) -> Column:
    """Decoded ``(key, value)`` of every well-formed piece, in order, repeats included."""
    pieces = F.array_remove(F.split(joined, "&"), "")
    good = F.when(joined.rlike(_MALFORMED), F.filter(pieces, lambda p: ~p.rlike(_MALFORMED))).otherwise(pieces)

    # cut first, then decode the halves: nothing is looked for twice in a piece
    halves = F.transform(good, lambda p: F.split(p, "=", 2))

    def entry(half: Column) -> Column:
        return F.struct(_decode(F.get(half, F.lit(0))).alias("key"), _decode(F.coalesce(F.get(half, F.lit(1)), F.lit(""))).alias("value"))

    return F.transform(halves, entry)


def parse_form(*texts: Column) -> Column:
    """``MAP<STRING,STRING>`` of the first value of every parameter in ``texts``.

    A single expression; ``with_form_params`` computes the same map in stages.
    """

    def add(known: Column, e: Column) -> Column:
        return F.when(F.map_contains_key(known, e["key"]), known).otherwise(F.map_concat(known, F.create_map(e["key"], e["value"])))

    return F.aggregate(_entries(F.concat_ws("&", *texts)), F.create_map().cast(_MAP), add)


def with_form_params(df: DataFrame, out: str, *texts: Column) -> DataFrame:
    """Add ``out`` = ``parse_form(*texts)``, each stage computed once per row (see ``materialize``)."""
    en = f"_{out}_entries"
    df = materialize(df, {en: _entries(F.concat_ws("&", *texts))})  # null texts are skipped
    keys = F.col(en)["key"]
    firsts = F.filter(F.col(en), lambda e, i: F.array_position(keys, e["key"]) == i + 1)
    repeated = F.size(F.array_distinct(keys)) < F.size(keys)
    return materialize(df, {out: F.map_from_entries(F.when(repeated, firsts).otherwise(F.col(en)))}).drop(en)


def materialize(df: DataFrame, cols: dict[str, Column], replace: bool = False) -> DataFrame:
    """Add ``cols``, each evaluated exactly once per row.

    Filters on later verdict columns are pushed down through projections by
    substituting every alias; an expensive map read by a dozen checks would
    then be rebuilt a dozen times. So the values are computed in a projection
    and passed through a one-row-per-row ``inline`` (a Generate node), whose
    output cannot be substituted. The Generate only moves attributes, so it
    stays inside whole-stage code generation.
    """
    tmp = {f"__m_{n}": c for n, c in cols.items()}
    df = df.withColumns(tmp)
    packed = F.array(F.struct(*[F.col(t).alias(n) for n, t in zip(cols, tmp)]))
    kept = [c for c in df.columns if not replace or c not in cols]
    return df.select(*[F.col(f"`{c}`") for c in kept], F.inline(packed)).drop(*tmp)


def decode_path(path: Column) -> Column:
    """Percent-decode a URL path; ``+`` stays a plus sign in paths."""
    return F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
