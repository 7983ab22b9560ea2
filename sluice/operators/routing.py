"""Topic routing by event type with a ``default`` fallback.

Routes given as a mapping are folded into the plan as one ``CASE`` with a
branch per topic, testing ``event_type IN (<types of that topic>)``: no join.
A route table given as a DataFrame is left-joined, at any size: repeats of an
event type are one route (the least topic), so no event is multiplied, and
Spark broadcasts the table if it is small or splits a hot type when it is not.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.schema import DEFAULT_ROUTE


def topic_for(event_type: Column, routes: Mapping[str, str]) -> Column:
    """Exact lookup; unknown (or null) types take the ``default`` topic."""
    if DEFAULT_ROUTE not in routes:
        raise ValueError("route table must hold a 'default' entry")
    by_topic: dict[str, list[str]] = {}
    for etype, topic in routes.items():
        if etype != DEFAULT_ROUTE and etype is not None:
            by_topic.setdefault(topic, []).append(etype)
    expr = None
    for topic, types in by_topic.items():
        cond = event_type.isin(*types)
        expr = F.when(cond, F.lit(topic)) if expr is None else expr.when(cond, F.lit(topic))
    default = F.lit(routes[DEFAULT_ROUTE])
    return default if expr is None else expr.otherwise(default)


def route(df: DataFrame, routes: Mapping[str, str] | DataFrame, event_type: Column | str = "event_type", out: str = "topic") -> DataFrame:
    """Add the destination ``topic`` column."""
    et = F.col(event_type) if isinstance(event_type, str) else event_type
    if isinstance(routes, DataFrame):
        return _route_join(df, routes, et, out)
    return df.withColumn(out, topic_for(et, routes))


def _route_join(df: DataFrame, routes: DataFrame, et: Column, out: str) -> DataFrame:
    default = routes.filter(F.col("event_type") == DEFAULT_ROUTE).agg(F.min("topic")).first()[0]
    if default is None:
        raise ValueError("route table must hold a 'default' entry")
    known = F.col("event_type").isNotNull() & (F.col("event_type") != DEFAULT_ROUTE)
    table = routes.filter(known).groupBy(F.col("event_type").alias("_rt_key")).agg(F.min("topic").alias("_rt_topic"))
    joined = df.withColumn("_rt_type", et).join(table, F.col("_rt_type") == F.col("_rt_key"), "left")
    return joined.withColumn(out, F.coalesce(F.col("_rt_topic"), F.lit(default))).drop("_rt_type", "_rt_key", "_rt_topic")
