"""Record assembly: parameters or CSV columns to the event record struct."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.maps import map_without, nonempty_map
from sluice.functions.timefmt import epoch_ms_to_rfc3339
from sluice.operators.validate import postback_ts_ms
from sluice.schema import (
    EVENT_CORE_FIELDS,
    POSTBACK_DROPPED_FIELDS,
    POSTBACK_EVENT,
    POSTBACK_OS,
    TRACKER_EVENT,
)

def _or_null(c: Column | None, type_: str = "string") -> Column:
    return c if c is not None else F.lit(None).cast(type_)


def record(
    event: Column,
    id: Column,
    timestamp: Column,
    did: Column | None = None,
    aid: Column | None = None,
    ip: Column | None = None,
    os: Column | None = None,
    exchange: Column | None = None,
    extension: Column | None = None,
) -> Column:
    """The event record struct in schema order (unset fields are null)."""
    return F.struct(
        event.alias("event"),
        id.alias("id"),
        timestamp.alias("timestamp"),
        _or_null(did).alias("did"),
        _or_null(aid).alias("aid"),
        _or_null(ip).alias("ip"),
        _or_null(os).alias("os"),
        _or_null(exchange).alias("exchange"),
        _or_null(extension, "map<string,string>").alias("extension"),
    )


def _param(params: Column, name: str) -> Column:
    return F.try_element_at(params, F.lit(name))


def extension_of(params: Column, drop=EVENT_CORE_FIELDS) -> Column:
    """Every parameter except ``drop``; null when nothing is left."""
    return nonempty_map(map_without(params, drop))


def event_record(params: Column) -> Column:
    """Record of a form event (fields ``event`` and ``id`` are constants)."""
    return record(
        event=F.lit(TRACKER_EVENT),
        id=F.lit(""),
        timestamp=_param(params, "timestamp"),
        did=_param(params, "did"),
        aid=_param(params, "aid"),
        ip=_param(params, "ip"),
        extension=extension_of(params, EVENT_CORE_FIELDS),
    )


def assemble_event(df: DataFrame, params: str = "params", out: str = "record") -> DataFrame:
    return df.withColumn(out, event_record(F.col(params)))


def csv_record(fields: Mapping[str, Column], extension: Column | None) -> Column:
    """Record of a CSV row; ``fields`` holds whichever of did/aid/ip/timestamp the header has."""
    return record(
        event=F.lit(TRACKER_EVENT),
        id=F.lit(""),
        timestamp=_or_null(fields.get("timestamp")),
        did=fields.get("did"),
        aid=fields.get("aid"),
        ip=fields.get("ip"),
        extension=extension,
    )


def postback_record(params: Column) -> Column:
    """Record of a partner postback."""
    return record(
        event=F.lit(POSTBACK_EVENT),
        id=_param(params, "keyword"),
        timestamp=epoch_ms_to_rfc3339(postback_ts_ms(_param(params, "ts"))),
        did=_param(params, "idfa"),
        ip=_param(params, "ip"),
        os=F.lit(POSTBACK_OS),
        extension=extension_of(params, POSTBACK_DROPPED_FIELDS),
    )


def assemble_postback(df: DataFrame, params: str = "params", out: str = "record") -> DataFrame:
    return df.withColumn(out, postback_record(F.col(params)))


def client_addr(x_forwarded_for: Column, remote_addr: Column) -> Column:
    """``X-Forwarded-For`` when non-empty, else the socket address."""
    return F.coalesce(F.nullif(x_forwarded_for, F.lit("")), remote_addr)
