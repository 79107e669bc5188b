"""Replacement of personal data in transcripts, and reports on it, from one detection of spans.

See :mod:`callinsight.operators.spans` for the recognizers and for how overlaps are settled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callinsight.operators import spans
from callinsight.operators.spans import ENTITIES, OPERATORS, PATTERNS, SCORES, THRESHOLD, active, detect, detect_with_names

__all__ = [
    "ENTITIES", "OPERATORS", "PATTERNS", "SCORES", "THRESHOLD", "active", "anonymize", "anonymized", "detect", "detect_with_names", "highlighted", "pii_report",
]


def anonymized(detected: DataFrame, operator_map: Mapping = OPERATORS, entities: Sequence[str] = tuple(ENTITIES)) -> DataFrame:
    """(original_file, anonymized_file, text, error) of detected rows (text_file, text, spans).

    A row without text is reported in ``error``.
    """
    done = spans.with_replaced(detected.select("text_file", "text", "spans"), operator_map, entities, "masked")
    return done.select(
        F.col("text_file").alias("original_file"),
        F.concat(F.regexp_replace("text_file", r"\.txt$", ""), F.lit(".anon.txt")).alias("anonymized_file"),
        F.col("masked").alias("text"),
        F.when(F.col("text").isNull(), "no text").alias("error"),
    )


def anonymize(
    transcripts: DataFrame,
    entities: Sequence[str] = tuple(ENTITIES),
    operator_map: Mapping = OPERATORS,
    threshold: float = THRESHOLD,
    names_column: str | None = None,
) -> DataFrame:
    """Detection and replacement for ``(text_file, text)`` rows, in one pass without a shuffle."""
    looked_for = active(entities, threshold)
    return anonymized(detect(transcripts, looked_for, threshold, names_column=names_column), operator_map, looked_for)


def highlighted(detected: DataFrame) -> DataFrame:
    """(text_file, html): the original text as HTML, each span in a ``mark`` element naming its entity."""
    return spans.with_html(detected.select("text_file", "text", "spans")).select("text_file", "html")


def pii_report(
    transcripts: DataFrame,
    entities: Sequence[str] = tuple(ENTITIES),
    threshold: float = THRESHOLD,
    names_column: str | None = None,
    full: bool = False,
) -> DataFrame:
    """Findings per file and entity: counts, or with ``full`` one row per finding."""
    found = detect(transcripts, entities, threshold, names_column=names_column)
    return spans.findings(found) if full else spans.report(found)
