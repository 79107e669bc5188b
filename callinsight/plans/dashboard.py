"""The dashboard's queries, composed from the chart operators."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from callinsight import schemas as S
from callinsight.operators import filters, frame, indicators, locations, outcomes, quality, relations, timeline


def build(calls: DataFrame, clients: DataFrame, path: str) -> DataFrame:
    """Write the dashboard frame once as parquet and read it back.

    Every chart then prunes to its own two or three columns, pushes the page's controls into the
    scan, and needs no join.
    """
    frame.dashboard_frame(calls, clients).write.mode("overwrite").parquet(path)
    return load(calls.sparkSession, path)


def load(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.DASHBOARD).parquet(path)


def summary_page(df: DataFrame, controls: Mapping[str, object] | None = None) -> dict[str, DataFrame]:
    """All figures of the summary page under one set of controls, as lazy queries."""
    rows = filters.apply_controls(df, controls or {}, "summary")
    figures = {
        "kpis": indicators.kpis(rows),
        "calls_over_time": timeline.calls_over_time(rows),
        "upsales_vs_concerns": timeline.upsales_vs_concerns(rows),
        "call_locations": locations.call_locations(rows),
    }
    for mode in outcomes.MODES:
        for chart in ("donut", "bar"):
            figures[f"upsales_{chart}_{mode}"] = outcomes.upsales(rows, mode, chart=chart)
            figures[f"concerns_{chart}_{mode}"] = outcomes.concerns(rows, mode, chart=chart)
        figures[f"quality_{mode}"] = quality.quality(rows, mode)
        figures[f"communication_{mode}"] = quality.score_distribution(rows, mode)
    return figures


def transcripts_page(df: DataFrame, controls: Mapping[str, object] | None = None) -> DataFrame:
    """Rows of the transcript browser."""
    return frame.transcript_grid(filters.apply_controls(df, controls or {}, "transcripts"))


def transcript(grid: DataFrame, transcripts: DataFrame, recordings: DataFrame) -> DataFrame:
    """Text and recording of the selected rows; ``transcripts`` must be the anonymized ones."""
    return relations.transcript_view(grid, transcripts, recordings)
