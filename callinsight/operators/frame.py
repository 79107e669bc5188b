"""The dashboard frame: calls with their caller's place, under display names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callinsight import schemas as S


def dashboard_frame(calls: DataFrame, clients: DataFrame) -> DataFrame:
    """Calls joined to their client's city and coordinates; calls without a client drop out.

    The join side is picked by Spark: broadcast below ``spark.sql.autoBroadcastJoinThreshold``,
    otherwise a sort-merge join that AQE splits where one caller dominates.
    """
    places = clients.select("client_id", "client_city", "latitude", "longitude")
    joined = calls.join(places, "client_id", "inner")
    columns = [f.name for f in S.CALL.fields if f.name in calls.columns]
    return joined.select(*columns, "client_city", "latitude", "longitude").withColumnsRenamed(
        S.DISPLAY_NAMES
    )


def with_targets(frame: DataFrame) -> DataFrame:
    """Constant target columns for the reference indicators."""
    return frame.withColumns(
        {
            "Upsale Success Reference": F.lit(S.UPSALE_TARGET),
            "Concern Reference": F.lit(S.CONCERN_TARGET),
        }
    )


def transcript_grid(frame: DataFrame) -> DataFrame:
    """Columns of the transcript browser; the two file names identify the selected call."""
    return frame.select("Agent ID", "Caller ID", "Topic", "Summary", "audio_file", "text_file")
