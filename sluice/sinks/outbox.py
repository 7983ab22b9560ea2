"""K7: outbound requests as a table, and what came of them.

The original service fired one GET per click or postback from the consumer and
logged errors and replies other than 200. Here each request is a row
``(source_id, method, url, headers)``; delivery is a caller-supplied function
run per micro-batch (``foreachBatch``), so the engine itself holds no HTTP
client. It may return a result for each request (``schema.DELIVERY_RESULT``),
and ``delivery_results`` joins them to the requests: a reply other than 200,
an error, or no result at all stays visible.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.schema import DELIVERY_RESULT, KEEP_ALIVE_HEADER, OK

DELIVERED, BAD_REPLY, NO_REPLY, NO_RESULT = "delivered", "bad_reply", "no_reply", "no_result"


def to_outbox(df: DataFrame, url: Column | str, source_id: Column | str) -> DataFrame:
    u = F.col(url) if isinstance(url, str) else url
    s = F.col(source_id) if isinstance(source_id, str) else source_id
    return df.select(
        s.alias("source_id"),
        F.lit("GET").alias("method"),
        u.alias("url"),
        F.lit(KEEP_ALIVE_HEADER).alias("headers"),
    )


def write_outbox(outbox: DataFrame, path: str, batch_id: int) -> None:
    """Write one micro-batch's requests to ``path/batch_id=N``; a re-run batch replaces its own folder."""
    (
        outbox.withColumn("batch_id", F.lit(int(batch_id)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def with_request_key(outbox: DataFrame) -> DataFrame:
    """Requests with the digest that their result is told by."""
    parts = [F.coalesce(F.concat(F.lit("="), F.hex(F.col(c).cast("string"))), F.lit("-")) for c in ("source_id", "method", "url")]
    return outbox.withColumn("request_key", F.sha2(F.concat_ws("\n", *parts), 256))


def delivery_results(outbox: DataFrame, results: DataFrame | None) -> DataFrame:
    """Every request with its ``status``, ``error`` and ``outcome``.

    Results for one key are one result: the reply that is not 200 if there is
    one, the error if there is no reply.
    """
    keyed = with_request_key(outbox)
    if results is None:
        told = keyed.select("request_key", F.lit(None).cast("int").alias("status"), F.lit(None).cast("string").alias("error"), F.lit(False).alias("told")).limit(0)
    else:
        worst = F.max_by("status", F.coalesce((F.col("status") != OK).cast("int"), F.lit(-1)))
        told = results.groupBy("request_key").agg(worst.alias("status"), F.max("error").alias("error"), F.lit(True).alias("told"))
    outcome = (
        F.when(F.col("told").isNull(), F.lit(NO_RESULT))
        .when(F.col("status").isNull(), F.lit(NO_REPLY))
        .when(F.col("status") != OK, F.lit(BAD_REPLY))
        .otherwise(F.lit(DELIVERED))
    )
    return keyed.join(told, "request_key", "left").select(*outbox.columns, "status", "error", outcome.alias("outcome"))


def deliver_rows(send: Callable[[dict], int]) -> Callable[[DataFrame, int], DataFrame]:
    """A delivery function from one that sends a request, given as a dict, and returns the reply's status or raises.

    It runs in the tasks, a partition's requests one after the other.
    """

    def deliver(outbox: DataFrame, batch_id: int) -> DataFrame:
        def each(frames: Iterator) -> Iterator:
            import pandas as pd

            for frame in frames:
                rows = []
                for request in frame.to_dict("records"):
                    try:
                        rows.append((request["request_key"], int(send(request)), None))
                    except Exception as exc:  # no reply: the error is the result
                        rows.append((request["request_key"], None, str(exc) or type(exc).__name__))
                out = pd.DataFrame(rows, columns=DELIVERY_RESULT.fieldNames())
                yield out.astype({"status": "Int32"})

        return outbox.mapInPandas(each, DELIVERY_RESULT)

    return deliver
