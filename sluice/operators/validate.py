"""Validation verdicts. Each check is one branch of a first-match CASE, so the
order of the checks is the order of the original handler and every rejected
row carries exactly one reason. Rows are never dropped here."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.maps import has_key
from sluice.functions.sign import first_item, postback_sign
from sluice.functions.timefmt import epoch_ms_in_range
from sluice.schema import (
    BAD_REQUEST,
    MISSING_FIELD_MSG,
    OK,
    POSTBACK_REQUIRED_FIELDS,
    REQUIRED_EVENT_FIELDS,
    SERVER_ERROR,
    SIGN_MISMATCH_MSG,
    TS_PARSE_MSG,
)

INT64_TEXT = r"^[+-]?[0-9]+\z"
TS_RANGE_MSG = TS_PARSE_MSG + "timestamp out of range"


def missing_field_checks(params: Column, fields: Sequence[str]) -> list[tuple[Column, int, Column]]:
    """(condition, status, reason) per required field: presence, not emptiness."""
    return [(~has_key(params, f), BAD_REQUEST, F.lit(MISSING_FIELD_MSG % f)) for f in fields]


def with_verdict(df: DataFrame, checks: Sequence[tuple[Column, int, Column]], status: str = "status", reason: str = "reason") -> DataFrame:
    """Add ``status``/``reason`` of the first failing check; (200, null) when all pass.

    One CASE finds the index of the first failing check; status and reason are
    looked up from it in the next projection. Evaluating the checks once keeps
    the generated code small enough for the JIT.
    """
    idx = F.lit(0)
    for n, (cond, _code, _why) in reversed(list(enumerate(checks, start=1))):
        idx = F.when(cond, F.lit(n)).otherwise(idx)
    tmp = f"_{status}_check"
    df = df.withColumn(tmp, idx)
    codes = F.array(F.lit(OK), *[F.lit(code) for _c, code, _w in checks])
    why = F.lit(None).cast("string")
    for n, (_cond, _code, text) in reversed(list(enumerate(checks, start=1))):
        why = F.when(F.col(tmp) == n, text).otherwise(why)
    return df.withColumns({status: F.element_at(codes, F.col(tmp) + 1), reason: why}).drop(tmp)


def validate_event(df: DataFrame, params: str = "params") -> DataFrame:
    """``did``, then ``timestamp``, then ``event_type`` must be present."""
    return with_verdict(df, missing_field_checks(F.col(params), REQUIRED_EVENT_FIELDS))


def ts_parse_error(ts: Column) -> Column:
    """The reply text for a ``ts`` that is not a signed 64-bit decimal integer."""
    kind = F.when(ts.rlike(INT64_TEXT), F.lit("value out of range")).otherwise(F.lit("invalid syntax"))
    return F.format_string(TS_PARSE_MSG + 'strconv.ParseInt: parsing "%s": %s', ts, kind)


def postback_ts_ms(ts: Column) -> Column:
    """``ts`` as BIGINT: strict decimal (no blanks, no exponent) that fits in 64 bits."""
    return F.when(ts.rlike(INT64_TEXT), ts.try_cast("bigint"))


def postback_checks(params: Column, key: Column | str, bypass_sign: bool = False) -> list[tuple[Column, int, Column]]:
    checks = missing_field_checks(params, POSTBACK_REQUIRED_FIELDS)
    if not bypass_sign:
        sign = F.try_element_at(params, F.lit("sign"))
        checks.append((postback_sign(params, key) != first_item(sign), BAD_REQUEST, F.lit(SIGN_MISMATCH_MSG)))
    ts = F.try_element_at(params, F.lit("ts"))
    ms = postback_ts_ms(ts)
    checks.append((ms.isNull(), SERVER_ERROR, ts_parse_error(ts)))
    checks.append((~epoch_ms_in_range(ms), SERVER_ERROR, F.lit(TS_RANGE_MSG)))
    return checks


def validate_postback(df: DataFrame, key: Column | str, params: str = "params", bypass_sign: bool = False) -> DataFrame:
    """F11 required fields in order, F12 signature (unless bypassed), F13 int64 ``ts``."""
    return with_verdict(df, postback_checks(F.col(params), key, bypass_sign))

