"""Deterministic pseudo-random columns.

Every draw is a hash of a tag and the row's own key, so a lost task is recomputed to the same
values, whatever the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw(tag: str | Column, key: Column) -> Column:
    """A uniform 32-bit value: the first eight hex digits of md5(tag:key) as a bigint. The tag may be a column."""
    label = [F.lit(f"{tag}:")] if isinstance(tag, str) else [tag, F.lit(":")]
    digest = F.md5(F.concat(*label, key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def below(tag: str | Column, key: Column, n: Column | int) -> Column:
    """A uniform integer in [0, n)."""
    return F.pmod(draw(tag, key), F.lit(n).cast("bigint") if isinstance(n, int) else n.cast("bigint"))


def pick(tag: str, key: Column, choices: list) -> Column:
    """One of a short list of literal choices (``None`` is allowed)."""
    index = below(tag, key, len(choices)).cast("int")
    return F.get(F.array(*[F.lit(c) for c in choices]), index)


def score(tag: str, key: Column) -> Column:
    """An integer score from 1 to 5."""
    return (below(tag, key, 5) + 1).cast("int")


def random_day(tag: str, key: Column, first: Column, last: Column) -> Column:
    """A date in [first, last], both inclusive."""
    return F.date_add(first, below(tag, key, F.datediff(last, first) + 1).cast("int"))


def random_second(tag: str, key: Column, start: int, end: int) -> Column:
    """A second of the day in [start, end], both inclusive.

    When the end hour is not after the start hour the window runs into the next day.
    """
    if end // 3600 <= start // 3600:
        end += 86400
    return below(tag, key, end - start + 1) + F.lit(start)


def hashed_id(tag: str, key: Column) -> Column:
    """A 32-character identifier."""
    return F.md5(F.concat(F.lit(f"{tag}:"), key.cast("string")))
