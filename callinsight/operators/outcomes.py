"""Counts and shares of call outcomes, per agent ("comparison") or overall ("average").

Each chart is one hash aggregate with a conditional count per label. A hot agent costs nothing
extra: every task first folds its rows into one partial row per agent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callinsight import schemas as S
from callinsight.functions import scalars as X

MODES = ("average", "comparison")


def group_keys(mode: str, group_column: str) -> list[str]:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    return [group_column] if mode == "comparison" else []


def label_counts(
    frame: DataFrame,
    label: Column,
    labels: list[str],
    keys: list[str],
    zero_fill: bool = True,
) -> DataFrame:
    """Long table (keys, category, counts, share) with one row per label.

    Rows without a label count nowhere. ``share`` is the label's part of the group's labelled
    rows and NULL where the group has none.
    """
    rows = frame.select(*keys, label.alias("_label"))
    for key in keys:
        rows = rows.filter(F.col(key).isNotNull())
    counts = [F.count_if(F.col("_label") == F.lit(x)).alias(f"_n{i}") for i, x in enumerate(labels)]
    wide = rows.groupBy(*keys).agg(*counts, F.count("_label").alias("_total"))
    share = lambda n: F.when(F.col("_total") > 0, F.col(n) / F.col("_total"))
    cells = F.array(
        *[
            F.struct(
                F.lit(x).alias("category"),
                F.col(f"_n{i}").alias("counts"),
                share(f"_n{i}").alias("share"),
            )
            for i, x in enumerate(labels)
        ]
    )
    long = wide.select(*keys, F.explode(cells).alias("_cell")).select(
        *keys, "_cell.category", "_cell.counts", "_cell.share"
    )
    return long if zero_fill else long.filter(F.col("counts") > 0)


def _sorted(df: DataFrame, keys: list[str], chart: str, order: list[str]) -> DataFrame:
    """Rings list labels alphabetically, bars follow an explicit category order."""
    by = F.col("category") if chart == "donut" else X.in_order(F.col("category"), order)
    return df.orderBy(*keys, by)


def upsales(
    frame: DataFrame,
    mode: str = "average",
    group_column: str = "Agent ID",
    chart: str = "donut",
) -> DataFrame:
    """Upsale outcomes; calls whose attempt or success is unknown are left out of every count.

    ``chart="donut"`` zero-fills all three labels, ``chart="bar"`` lists only the labels seen.
    """
    keys = group_keys(mode, group_column)
    label = X.upsale_outcome(F.col("Upsale Attempted"), F.col("Upsale Success"))
    counts = label_counts(frame, label, S.UPSALE_LABELS, keys, zero_fill=chart == "donut")
    return _sorted(counts, keys, chart, S.UPSALE_ORDER)


def concerns(
    frame: DataFrame,
    mode: str = "average",
    group_column: str = "Agent ID",
    count_column: str = "Concern Addressed",
    label_names: list[str] = S.CONCERN_LABELS,
    chart: str = "donut",
) -> DataFrame:
    """Calls with and without the concern addressed; ``label_names`` is [false, true]."""
    keys = group_keys(mode, group_column)
    label = X.concern_label(F.col(count_column), label_names)
    counts = label_counts(frame, label, label_names, keys, zero_fill=chart == "donut")
    return _sorted(counts, keys, chart, label_names)


def group_list(frame: DataFrame, group_column: str = "Agent ID") -> DataFrame:
    """The distinct groups a comparison chart shows."""
    return frame.select(group_column).filter(F.col(group_column).isNotNull()).distinct()


def group_count(frame: DataFrame, group_column: str = "Agent ID") -> DataFrame:
    return frame.agg(F.countDistinct(group_column).alias("groups"))
