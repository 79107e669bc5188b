"""Key indicators of the summary page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callinsight import schemas as S


FLAGS = {"upsale": "Upsale Success", "concern": "Concern Addressed"}


def kpis(frame: DataFrame, approximate: bool = False) -> DataFrame:
    """Five indicators as rows (kpi, value, target, delta_relative).

    The two means are over all known values and compared to their target. Sums and counts are folded per agent,
    whose number is that of the agents; the callers are folded apart, in a scan of their column alone. Nothing is
    expanded, and no row is made for a pair of agent and caller. ``approximate`` counts callers by a sketch, whose
    partial results do not grow with them.
    """
    per_agent = frame.groupBy("Agent ID").agg(
        F.count("Caller ID").alias("calls"),
        *[F.sum(F.col(flag).cast("int")).alias(name) for name, flag in FLAGS.items()],
        *[F.count(flag).alias(f"known_{name}") for name, flag in FLAGS.items()],
    )
    if approximate:
        callers = frame.select(F.approx_count_distinct("Caller ID")).scalar()
    else:
        callers = frame.groupBy("Caller ID").agg(F.lit(1)).select(F.count("Caller ID")).scalar()
    return as_indicators(per_agent, callers)


def as_indicators(per_agent: DataFrame, callers: Column) -> DataFrame:
    """The indicators from (Agent ID, calls, upsale, concern, known_upsale, known_concern), a row per agent."""
    one = per_agent.agg(
        *[(F.sum(name) / F.sum(f"known_{name}")).alias(name) for name in FLAGS],
        F.coalesce(F.sum("calls"), F.lit(0)).alias("calls"),
        F.count("Agent ID").alias("agents"),
    ).withColumn("callers", callers)

    def row(name: str, column: str, target: float | None = None):
        value = F.col(column).cast("double")
        goal = F.lit(target).cast("double")
        return F.struct(
            F.lit(name).alias("kpi"),
            value.alias("value"),
            goal.alias("target"),
            ((value - goal) / goal).alias("delta_relative"),
        )

    rows = F.array(
        row("Upsale Success", "upsale", S.UPSALE_TARGET),
        row("Concerns Addressed", "concern", S.CONCERN_TARGET),
        row("Number of Calls", "calls"),
        row("Number of Agents", "agents"),
        row("Number of Callers", "callers"),
    )
    return one.select(F.inline(rows))
