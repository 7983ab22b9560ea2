"""Form-encoded requests (a request log) to a parameter map."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.forms import with_form_params

REQUEST_LOG = T.StructType(
    [
        T.StructField("request_id", T.LongType(), True),
        T.StructField("path", T.StringType(), True),
        T.StructField("query", T.StringType(), True),
        T.StructField("body", T.StringType(), True),
        T.StructField("x_forwarded_for", T.StringType(), True),
        T.StructField("remote_addr", T.StringType(), True),
    ]
)


def parse_requests(df: DataFrame, body: str = "body", query: str = "query", out: str = "params") -> DataFrame:
    """Add ``params``: body parameters take precedence over query ones, first value wins."""
    return with_form_params(df, out, F.col(body), F.col(query))


def url_query(url: str = "url") -> F.Column:
    """The query part of a URL (between ``?`` and ``#``), null when there is none."""
    return F.nullif(F.regexp_extract(F.col(url), r"\?([^#]*)", 1), F.lit(""))
