"""Calls by caller location."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callinsight.functions import scalars as X

PLACE = ["Caller City", "latitude", "longitude"]


def _with_size(places: DataFrame) -> DataFrame:
    """Bubble size between the smallest and the largest call count.

    The bounds are one scalar subquery over the same aggregate. It compares whole rows, led by
    the call count, so that it reads exactly the columns of the outer query: the two then share
    one exchange and the calls are scanned once.
    """
    row = F.struct("calls", "agent_ids", "callers")
    bounds = places.select(F.struct(F.min(row).alias("low"), F.max(row).alias("high"))).scalar()
    sized = places.withColumn("_bounds", bounds)
    size = X.bubble_size(F.col("calls"), F.col("_bounds.low.calls"), F.col("_bounds.high.calls"))
    return sized.withColumn("size", size).drop("_bounds")


def call_locations(frame: DataFrame) -> DataFrame:
    """Calls, agent entries and distinct callers per city and coordinates.

    Counted per caller first: the callers of a city are then rows to count, so neither a busy
    caller nor a busy city gathers its calls in one task.
    """
    rows = frame
    for column in PLACE:
        rows = rows.filter(F.col(column).isNotNull())
    per_caller = rows.groupBy(*PLACE, "Caller ID").agg(
        F.count("Caller ID").alias("calls"), F.count("Agent ID").alias("agent_ids")
    )
    return _with_size(_fold(per_caller))


def _fold(per_caller: DataFrame) -> DataFrame:
    return per_caller.groupBy(*PLACE).agg(
        F.sum("calls").alias("calls"),
        F.sum("agent_ids").alias("agent_ids"),
        F.count("Caller ID").alias("callers"),
    )


def call_locations_from_tables(calls: DataFrame, clients: DataFrame) -> DataFrame:
    """Same result straight from the tables, with the calls folded per caller below the join.

    The join then moves one row per caller instead of one per call.
    """
    per_client = calls.groupBy("client_id").agg(
        F.count("client_id").alias("calls"), F.count("agent_id").alias("agent_ids")
    )
    places = clients.select(
        "client_id", F.col("client_city").alias("Caller City"), "latitude", "longitude"
    ).dropna(subset=PLACE)
    joined = per_client.join(places, "client_id").withColumnRenamed("client_id", "Caller ID")
    return _with_size(_fold(joined))
