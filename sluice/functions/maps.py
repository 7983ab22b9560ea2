"""Map helpers for the open-ended ``extension`` attributes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.schema import UNKNOWN


def has_key(m: Column, key: str) -> Column:
    """True when ``key`` is present; false (never null) for a null map."""
    return F.coalesce(F.map_contains_key(m, F.lit(key)), F.lit(False))


def map_without(m: Column, keys: Iterable[str]) -> Column:
    """``m`` without the given keys."""
    drop = F.array(*[F.lit(k) for k in keys])
    return F.map_filter(m, lambda k, _v: ~F.array_contains(drop, k))


def nonempty_map(m: Column) -> Column:
    """Null for an empty map (the record leaves ``extension`` unset then)."""
    return F.when(F.size(m) > 0, m)


def fill_unknown(m: Column) -> Column:
    """Every null or empty value becomes ``"unknown"``."""
    return F.transform_values(m, lambda _k, v: F.when(v.isNull() | (v == ""), F.lit(UNKNOWN)).otherwise(v))


def sorted_keys(m: Column, sep: str = ",") -> Column:
    """The map's keys, sorted and joined: a stable text form for comparisons."""
    return F.array_join(F.sort_array(F.map_keys(m)), sep)
