"""Partner postbacks: validation, the stored record and the ad-server notification URL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.operators.assemble import assemble_postback
from sluice.operators.validate import validate_postback


def postback_url(keyword: Column, base: str) -> Column:
    """``{base}?params={keyword}``, not escaped."""
    return F.concat(F.lit(f"{base}?params="), keyword)


def postbacks(df: DataFrame, key: str, params: str = "params", bypass_sign: bool = False) -> DataFrame:
    """F11-F13 verdicts, then the record (null for rejected rows)."""
    v = validate_postback(df, key, params=params, bypass_sign=bypass_sign)
    v = assemble_postback(v, params=params)
    return v.withColumn("record", F.when(F.col("status") == 200, F.col("record")))
