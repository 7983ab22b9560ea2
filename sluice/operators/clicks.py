"""Click forwarding: which click records go to the partner, and their callback URL.

The checks run in the original consumer's order as one first-match CASE and
every record gets a verdict; only ``ok`` rows produce a URL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.maps import fill_unknown, has_key
from sluice.functions.timefmt import parse_rfc3339, rfc3339_to_epoch_ms
from sluice.schema import CLICK_EVENT, UNKNOWN

# Verdict names in check order.
CLICK_VERDICTS = (
    "undecodable",
    "no_event",
    "not_click",
    "no_extension",
    "no_adv_id",
    "bad_adv_id",
    "no_id",
    "no_did",
    "no_ip",
    "bad_timestamp",
    "no_device_model",
    "ok",
)


def click_verdict(rec: Column, decoded_ok: Column | None = None) -> Column:
    """F5-F10 on a decoded record struct (``decoded_ok`` false means the bytes did not decode)."""
    ext = rec["extension"]
    adv = F.try_element_at(ext, F.lit("adv_id"))
    checks = [
        (rec.isNull() if decoded_ok is None else ~decoded_ok, "undecodable"),
        (rec["event"].isNull(), "no_event"),
        (rec["event"] != F.lit(CLICK_EVENT), "not_click"),
        (ext.isNull(), "no_extension"),
        (~has_key(ext, "adv_id"), "no_adv_id"),
        (adv.isNull() | (adv == ""), "bad_adv_id"),
        (rec["id"].isNull(), "no_id"),
        (rec["did"].isNull(), "no_did"),
        (rec["ip"].isNull(), "no_ip"),
        (parse_rfc3339(rec["timestamp"]).isNull(), "bad_timestamp"),
        (~has_key(ext, "device_model"), "no_device_model"),
    ]
    expr = None
    for cond, name in checks:
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit("ok"))


def click_verdicts(df: DataFrame, record: str = "record", decoded_ok: str | None = None, out: str = "verdict") -> DataFrame:
    ok = F.col(decoded_ok) if decoded_ok else None
    return df.withColumn(out, click_verdict(F.col(record), ok))


def click_url(rec: Column, base: str, pid: str) -> Column:
    """``{base}?pid=&advid=&ip=&cts=&osv=&idfa=&keywords=``; values are not escaped.

    ``cts`` is the click time in epoch milliseconds, ``osv`` the OS version
    (``unknown`` when absent or empty), ``idfa`` the upper-cased device id and
    ``keywords`` the record id.
    """
    ext = fill_unknown(rec["extension"])
    osv = F.coalesce(F.try_element_at(ext, F.lit("os_version")), F.lit(UNKNOWN))
    return F.concat(
        F.lit(f"{base}?pid={pid}&advid="),
        F.try_element_at(ext, F.lit("adv_id")),
        F.lit("&ip="),
        rec["ip"],
        F.lit("&cts="),
        rfc3339_to_epoch_ms(rec["timestamp"]),
        F.lit("&osv="),
        osv,
        F.lit("&idfa="),
        F.upper(rec["did"]),
        F.lit("&keywords="),
        rec["id"],
    )


def click_urls(df: DataFrame, base: str, pid: str, record: str = "record", verdict: str = "verdict", out: str = "url") -> DataFrame:
    """Keep ``ok`` clicks and add their callback URL."""
    return df.filter(F.col(verdict) == "ok").withColumn(out, click_url(F.col(record), base, pid))
