"""Printed byte lists such as ``[123 34 101]`` to bytes and back.

Parsing stays JVM-side: the numbers are split and cast as one array
(``try_cast`` to ``array<int>``) and validated with code-generated array
aggregates; one trivial lambda turns each number into two hex digits. A
number above 255, a leading zero or a non-number makes the whole list
invalid (null bytes) rather than producing a wrong byte.

Formatting (bytes to text), used when writing legacy logs, reads the bytes as
Latin-1 characters and takes the code of each: the only thing done per byte.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bytes_to_list_text(b: Column) -> Column:
    """Binary to ``[b0 b1 ...]`` with decimal byte values; ``[]`` when empty."""
    codes = F.transform(F.split(F.decode(b, "ISO-8859-1"), ""), F.ascii).cast("array<string>")
    return F.when(F.octet_length(b) == 0, F.lit("[]")).otherwise(F.concat(F.lit("["), F.array_join(codes, " "), F.lit("]")))


def _numbers(inner: Column) -> Column:
    return F.array_remove(F.split(inner, " "), "").try_cast("array<int>")


def list_text_is_valid(inner: Column, nums: Column | None = None) -> Column:
    """Every item is a decimal 0..255 without leading zeros (``nums``: the parsed items, if at hand)."""
    nums = _numbers(inner) if nums is None else nums
    return (
        inner.isNotNull()
        & ~inner.rlike(r"(^| )0[0-9]")
        & (F.size(F.array_compact(nums)) == F.size(nums))
        & (F.coalesce(F.array_max(nums), F.lit(0)) <= F.lit(255))
        & (F.coalesce(F.array_min(nums), F.lit(0)) >= F.lit(0))
    )


def numbers_to_bytes(nums: Column) -> Column:
    """Validated ``array<int>`` of byte values to binary."""
    return F.unhex(F.array_join(F.transform(nums, lambda x: F.lpad(F.hex(x), 2, "0")), ""))


def list_text_to_bytes(inner: Column) -> Column:
    """The space-separated numbers inside the brackets to binary; null if any is invalid."""
    return F.when(list_text_is_valid(inner), numbers_to_bytes(_numbers(inner)))


def list_text_numbers(inner: Column) -> Column:
    return _numbers(inner)
