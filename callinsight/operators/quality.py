"""Agent quality scores and the distribution of one score."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from callinsight import schemas as S
from callinsight.operators.outcomes import group_keys


def _to_long(wide: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """One row per metric; metrics without any score keep a NULL row."""
    return wide.unpivot(keys, metrics, "metric", "value")


def quality(
    frame: DataFrame,
    mode: str = "average",
    group_column: str = "Agent ID",
    metrics: list[str] = S.QUALITY_METRICS,
) -> DataFrame:
    """Mean score per agent and metric, or (average) the unweighted mean of the agents' means.

    The means are taken on the wide table and only the small result is turned long, so the calls
    are never multiplied by the number of metrics.
    """
    keys = group_keys(mode, group_column)
    per_agent = (
        frame.filter(F.col(group_column).isNotNull())
        .groupBy(group_column)
        .agg(*[F.avg(m).alias(m) for m in metrics])
    )
    if keys:
        return _to_long(per_agent, keys, metrics).orderBy(*keys, "metric")
    return _to_long(per_agent.agg(*[F.avg(m).alias(m) for m in metrics]), [], metrics).orderBy("metric")


def score_distribution(
    frame: DataFrame,
    mode: str = "average",
    group_column: str = "Agent ID",
    value_column: str = "Effective Communication",
) -> DataFrame:
    """Exact box-plot figures of a discrete score.

    Quartiles interpolate at position p*n - 0.5 of the sorted scores; the fences are the last
    scores within 1.5 interquartile ranges. The scores are first folded to a histogram (one row
    per agent and score), so what is shuffled, sorted and windowed no longer grows with the
    number of calls.
    """
    keys = group_keys(mode, group_column) or ["_all"]
    value = F.col("_value")
    scores = frame.select(
        F.lit(0).alias("_all") if keys == ["_all"] else F.col(group_column),
        F.col(value_column).alias("_value"),
    )
    histogram = (
        scores.filter(F.col(keys[0]).isNotNull() & value.isNotNull())
        .groupBy(*keys, "_value")
        .agg(F.count("*").alias("_n"))
    )
    group = W.partitionBy(*keys)
    below = group.orderBy("_value").rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = histogram.withColumns(
        {"_upto": F.sum("_n").over(below), "_total": F.sum("_n").over(group)}
    )

    def position(p: float) -> Column:
        last = F.col("_total") - 1
        return F.least(F.greatest(F.col("_total") * F.lit(p) - 0.5, F.lit(0.0)), last.cast("double"))

    def at(index: Column) -> Column:
        """Value at a zero-based position: the lowest one whose running count exceeds it."""
        return F.min(F.when(F.col("_upto") > index, value)).over(group)

    def quantile(p: float) -> Column:
        pos = position(p)
        low, high = at(F.floor(pos)), at(F.ceil(pos))
        return low + (pos - F.floor(pos)) * (high - low)

    quartiles = ranked.withColumns(
        {"_q1": quantile(0.25), "_q2": quantile(0.5), "_q3": quantile(0.75)}
    )
    reach = (F.col("_q3") - F.col("_q1")) * 1.5
    inside_low = F.when(value >= F.col("_q1") - reach, value)
    inside_high = F.when(value <= F.col("_q3") + reach, value)
    box = quartiles.groupBy(*keys).agg(
        F.sum("_n").alias("n"),
        F.min("_value").cast("double").alias("minimum"),
        F.least(F.first("_q1"), F.min(inside_low)).alias("lower_fence"),
        F.first("_q1").alias("q1"),
        F.first("_q2").alias("median"),
        F.first("_q3").alias("q3"),
        F.greatest(F.first("_q3"), F.max(inside_high)).alias("upper_fence"),
        F.max("_value").cast("double").alias("maximum"),
    )
    return box.drop("_all") if keys == ["_all"] else box.orderBy(*keys)


#: Parts that a group's values are dealt to when ranks are picked.
PARTS = 256
_QUARTILES = (0.25, 0.5, 0.75)


def value_distribution(
    frame: DataFrame,
    mode: str = "average",
    group_column: str = "Agent ID",
    value_column: str = "Effective Communication",
    parts: int = PARTS,
) -> DataFrame:
    """Exact box-plot figures of any number, continuous ones too; the same columns as ``score_distribution``.

    A sketch gives each group bounds that cut its values into about equal parts; the parts are counted, which
    folds in each task, and their running counts tell which part holds each wanted rank. Only the values of those
    parts, at most six a group, are dealt out (folded, so a frequent value is one row) and ranked; the sketch decides
    how the work is dealt, never a result. Fences follow from one more conditional aggregate. No group's values
    ever meet in one task, that of all rows neither.
    """
    keys = group_keys(mode, group_column)
    key = keys[0] if keys else "_all"
    values = frame.select(F.col(group_column), F.col(value_column).cast("double").alias("_value")).filter("_value is not null and not isnan(_value)")
    values = values.filter(F.col(group_column).isNotNull()) if keys else values
    if not keys:
        # One group for all rows, by a column that the optimizer does not know to be constant.
        values = values.select(F.pmod(F.xxhash64("_value"), F.lit(1)).cast("int").alias("_all"), "_value")

    fractions = [i / parts for i in range(1, parts)]
    groups = values.groupBy(key).agg(F.count("*").alias("n"), F.percentile_approx("_value", fractions, 10 * parts).alias("_bounds"))
    # A value's part is the number of bounds below it, found in two steps: among every step-th bound, then between two.
    step = max(2, math.isqrt(parts))
    groups = groups.withColumn("_coarse", F.array(*[F.get("_bounds", F.lit(i)) for i in range(step - 1, parts - 1, step)]).cast("array<double>"))
    below = lambda bounds: F.size(F.filter(bounds, lambda b: b < F.col("_value")))
    dealt = values.join(groups, key).withColumn("_k", below(F.col("_coarse")) * step)
    dealt = dealt.select(key, "_value", "n", (F.col("_k") + below(F.slice("_bounds", F.col("_k") + 1, F.lit(step - 1)))).alias("_part"))

    counted = dealt.groupBy(key, "_part", "n").agg(F.count("*").alias("_rows"))
    upto = F.sum("_rows").over(W.partitionBy(key).orderBy("_part").rowsBetween(W.unboundedPreceding, W.currentRow))
    counted = counted.withColumn("_before", upto - F.col("_rows"))

    def position(p: float) -> Column:
        return F.least(F.greatest(F.col("n") * F.lit(p) - 0.5, F.lit(0.0)), (F.col("n") - 1).cast("double"))

    wanted = F.array(*[f(position(p)).cast("bigint") for p in _QUARTILES for f in (F.floor, F.ceil)])
    inside = F.filter(wanted, lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_rows")))
    chosen = counted.withColumn("_ranks", F.array_distinct(inside)).filter(F.size("_ranks") > 0).select(key, "_part", "_before", "_ranks")

    few = dealt.join(chosen, [key, "_part"], "left_semi").groupBy(key, "_part", "_value").agg(F.count("*").alias("_times"))
    ranked = few.withColumn("_upto", F.sum("_times").over(W.partitionBy(key, "_part").orderBy("_value").rowsBetween(W.unboundedPreceding, W.currentRow)))
    placed = ranked.join(chosen, [key, "_part"])
    last = F.col("_before") + F.col("_upto")
    hits = F.filter("_ranks", lambda r: (r >= last - F.col("_times")) & (r < last))
    picked = placed.select(key, F.explode(hits).alias("_rank"), "_value").groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_value"))).alias("_at"))

    def quartile(p: float) -> Column:
        low, high = (F.get(F.array(F.element_at("_at", f(position(p)).cast("bigint"))), F.lit(0)) for f in (F.floor, F.ceil))
        return low + (position(p) - F.floor(position(p))) * (high - low)

    quartiles = groups.select(key, "n").join(picked, key).select(key, "n", *[quartile(p).alias(c) for p, c in zip(_QUARTILES, ("q1", "median", "q3"), strict=True)])
    reach = (F.col("q3") - F.col("q1")) * 1.5
    value = F.col("_value")
    box = (
        values.join(quartiles, key)
        .groupBy(key, "n", "q1", "median", "q3")
        .agg(
            F.min(value).alias("minimum"),
            F.least("q1", F.min(F.when(value >= F.col("q1") - reach, value))).alias("lower_fence"),
            F.greatest("q3", F.max(F.when(value <= F.col("q3") + reach, value))).alias("upper_fence"),
            F.max(value).alias("maximum"),
        )
    )
    return box.select(*keys, "n", "minimum", "lower_fence", "q1", "median", "q3", "upper_fence", "maximum")
