"""Monthly series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callinsight.functions import scalars as X


def calls_over_time(frame: DataFrame) -> DataFrame:
    """Calls per observed calendar month, in order."""
    month = F.col("month")
    return (
        frame.filter(F.col("Call Date").isNotNull())
        .groupBy(X.month_start(F.col("Call Date")).alias("month"))
        .agg(F.count("*").alias("calls"))
        .select("month", X.month_key(month).alias("month_key"), X.month_label(month).alias("label"), "calls")
        .orderBy("month")
    )


def _monthly(frame: DataFrame) -> DataFrame:
    """Both monthly series in one conditional aggregate: means in percent, NULL without a value."""
    attempted = F.coalesce(F.col("Upsale Attempted"), F.lit(False))
    success = F.when(attempted, F.col("Upsale Success").cast("int"))
    return (
        frame.filter(F.col("Call Date").isNotNull())
        .groupBy(X.month_start(F.col("Call Date")).alias("month"))
        .agg(
            F.count_if(attempted).alias("_attempts"),
            (F.avg(success) * 100).alias("upsales_success"),
            (F.lit(0.0) - F.avg(F.col("Concern Addressed").cast("int")) * 100).alias("concerns_addressed"),
        )
    )


def monthly_metrics(frame: DataFrame) -> DataFrame:
    """(month, metric, value) in that order; months without attempted upsales have no such row."""
    rows = F.array(
        F.struct(F.lit("Concerns Addressed").alias("metric"), F.col("concerns_addressed").alias("value"), F.lit(True).alias("seen")),
        F.struct(F.lit("Upsales Success").alias("metric"), F.col("upsales_success").alias("value"), (F.col("_attempts") > 0).alias("seen")),
    )
    return (
        _monthly(frame)
        .select("month", X.month_label(F.col("month")).alias("label"), F.inline(rows))
        .filter("seen")
        .drop("seen")
        .orderBy("month", "metric")
    )


def upsales_vs_concerns(frame: DataFrame) -> DataFrame:
    """Monthly upsale success (of attempted upsales) against concerns addressed, in percent.

    Concerns are negative, for a mirrored bar, and a month without a value shows zero.
    """
    zero = F.lit(0.0)
    return (
        _monthly(frame)
        .select(
            "month",
            X.month_label(F.col("month")).alias("label"),
            F.coalesce("upsales_success", zero).alias("upsales_success"),
            F.coalesce("concerns_addressed", zero).alias("concerns_addressed"),
        )
        .orderBy("month")
    )
