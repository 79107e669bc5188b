"""Page controls: dropdowns, range sliders, and their conjunction."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAGE_CONTROLS = {
    "summary": {
        "Agent ID": "dropdown",
        "Caller ID": "dropdown",
        "Client Tone": "dropdown",
        "Effective Communication": "range",
        "Caller City": "dropdown",
    },
    "transcripts": {"Agent ID": "dropdown", "Caller ID": "dropdown"},
}


def any_of(column: str, values: Sequence) -> Column:
    return F.col(column).isin(list(values))


def in_range(column: str, low, high) -> Column:
    """Inclusive range; rows without a value drop out."""
    return F.col(column).between(low, high)


def apply_controls(frame: DataFrame, controls: Mapping[str, object], page: str = "summary") -> DataFrame:
    """Keep the rows that satisfy every control of a page.

    Dropdowns take a list of values and sliders a ``(low, high)`` pair. The conjunction is one
    ``filter`` so that Catalyst can push each part below the join and into the scan.
    """
    kinds = PAGE_CONTROLS[page]
    unknown = set(controls) - set(kinds)
    if unknown:
        raise ValueError(f"no such control on page {page!r}: {sorted(unknown)}")
    predicates = [
        in_range(name, *value) if kinds[name] == "range" else any_of(name, value)
        for name, value in controls.items()
    ]
    return frame.filter(reduce(Column.__and__, predicates)) if predicates else frame
