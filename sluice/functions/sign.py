"""Postback signature: lowercase hex MD5 over ``name=value`` pairs and a shared key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the field order of the signed text (pairs are joined without separators).
SIGNED_FIELDS = ("adid", "adname", "appid", "device", "idfa", "point", "ts")


def postback_sign(params: Column, key: Column | str) -> Column:
    """``md5("adid=..adname=..appid=..device=..idfa=..point=..ts=..key=<key>")``."""
    key_col = F.lit(key) if isinstance(key, str) else key
    parts = []
    for name in SIGNED_FIELDS:
        parts += [F.lit(f"{name}="), F.try_element_at(params, F.lit(name))]
    parts += [F.lit("key="), key_col]
    return F.md5(F.concat(*parts))


def first_item(text: Column, sep: str = ",") -> Column:
    """Text before the first ``sep`` (the whole text when there is none)."""
    return F.substring_index(text, sep, 1)
