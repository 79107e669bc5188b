"""Daily totals per agent, from which the dashboard's figures are read without the calls.

A rollup row holds sums and counts that add up, and a sketch of the callers that can be merged, so any span of days
and any choice of agents is answered from as many rows as there are (day, agent) pairs. Counts and means are
exact; distinct callers are estimates (see ``ERROR``). New days are appended, and a day that changed is replaced by writing
its partition again.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callinsight import schemas as S
from callinsight.operators import indicators

#: 2**LG_K registers a sketch; its relative standard error is about 0.8 / sqrt(2**LG_K).
LG_K = 14
ERROR = 0.8 / 2 ** (LG_K / 2)


def rollup(frame: DataFrame) -> DataFrame:
    """(Call Date, Agent ID, totals, callers): one row per day and agent of the dashboard frame.

    One hash aggregate; a busy agent or day is folded inside each task. Calls without an agent keep a row of their own.
    """
    both = F.col("Upsale Attempted").isNotNull() & F.col("Upsale Success").isNotNull()
    attempted, success = F.col("Upsale Attempted"), F.col("Upsale Success")
    kinds = {"upsales_none": ~attempted, "upsales_won": attempted & success, "upsales_lost": attempted & ~success}
    return frame.groupBy("Call Date", "Agent ID").agg(
        F.count("*").alias("rows"),
        F.count("Caller ID").alias("calls"),
        *[F.sum(F.col(c).cast("int")).alias(name) for name, c in indicators.FLAGS.items()],
        *[F.count(c).alias(f"known_{name}") for name, c in indicators.FLAGS.items()],
        *[F.count_if(both & condition).alias(name) for name, condition in kinds.items()],
        *[F.sum(m).alias(f"sum {m}") for m in S.QUALITY_METRICS],
        *[F.count(m).alias(f"known {m}") for m in S.QUALITY_METRICS],
        F.hll_sketch_agg("Caller ID", F.lit(LG_K)).alias("callers"),
    )


def build(frame: DataFrame, path: str) -> DataFrame:
    """Write the rollup of all days of ``frame``, a folder per day; days that it does not hold are kept."""
    rows = rollup(frame).withColumn("day", F.col("Call Date")).hint("rebalance", "day")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
    return load(frame.sparkSession, path)


def load(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("day")


def between(totals: DataFrame, first: object = None, last: object = None, agents: list[str] | None = None) -> DataFrame:
    """The rollup of some days and agents."""
    if first is not None:
        totals = totals.filter(F.col("Call Date") >= F.lit(first))
    if last is not None:
        totals = totals.filter(F.col("Call Date") <= F.lit(last))
    return totals if agents is None else totals.filter(F.col("Agent ID").isin(agents))


def _callers(totals: DataFrame) -> Column:
    merged = F.hll_sketch_estimate(F.hll_union_agg("callers", F.lit(True)))
    return F.coalesce(totals.filter("calls > 0").select(merged).scalar(), F.lit(0))


def kpis(totals: DataFrame) -> DataFrame:
    """The five indicators; the number of callers is an estimate, the others are exact."""
    sums = ["calls", *indicators.FLAGS, *[f"known_{name}" for name in indicators.FLAGS]]
    per_agent = totals.groupBy("Agent ID").agg(*[F.sum(c).alias(c) for c in sums])
    return indicators.as_indicators(per_agent, _callers(totals))


def calls_over_time(totals: DataFrame) -> DataFrame:
    """(month, calls) of the months that have calls."""
    month = F.trunc("Call Date", "month").alias("month")
    return totals.filter("`Call Date` is not null").groupBy(month).agg(F.sum("rows").alias("calls")).orderBy("month")


def upsales(totals: DataFrame) -> DataFrame:
    """(Agent ID, category, count) of every agent and outcome, zeros included."""
    names = dict(zip(S.UPSALE_LABELS, ("upsales_lost", "upsales_none", "upsales_won"), strict=True))
    sums = totals.filter("`Agent ID` is not null").groupBy("Agent ID").agg(*[F.sum(c).alias(label) for label, c in names.items()])
    return sums.unpivot(["Agent ID"], list(names), "category", "count").orderBy("Agent ID", "category")


def quality(totals: DataFrame) -> DataFrame:
    """(Agent ID, metric, value): the mean score of every agent and metric."""
    means = totals.filter("`Agent ID` is not null").groupBy("Agent ID").agg(
        *[F.try_divide(F.sum(f"sum {m}"), F.sum(f"known {m}")).alias(m) for m in S.QUALITY_METRICS]
    )
    return means.unpivot(["Agent ID"], S.QUALITY_METRICS, "metric", "value").orderBy("Agent ID", "metric")


def page(totals: DataFrame) -> Mapping[str, DataFrame]:
    """The figures that a page reads from the rollup."""
    return {"kpis": kpis(totals), "calls_over_time": calls_over_time(totals), "upsales": upsales(totals), "quality": quality(totals)}
