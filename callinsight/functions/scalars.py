"""Column expressions: answer cleaning, labels, dates, text shaping.

All are built-in Catalyst expressions and run in the JVM; those on arrays with a function argument
(``transform``, ``filter``, ``zip_with``) are evaluated outside whole-stage code generation.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

from callinsight import schemas as S


# --- Answers ----------------------------------------------------------------------------------


def is_yes(answer: Column) -> Column:
    """True when the answer mentions "yes" in any case; NULL stays NULL."""
    return F.lower(answer).contains("yes")


def normalize_tone(answer: Column) -> Column:
    """Reduce a free-text tone to its keyword.

    Case-sensitive; the first keyword wins in the order Positive, Negative, Neutral and text
    without a keyword is kept.
    """
    return (
        F.when(answer.contains("Positive"), "Positive")
        .when(answer.contains("Negative"), "Negative")
        .when(answer.contains("Neutral"), "Neutral")
        .otherwise(answer)
    )


def most_common(answers: list[Column]) -> Column:
    """Most frequent of a few columns; the earliest one wins a tie, NULLs do not vote."""
    ranked = [
        F.when(
            a.isNotNull(),
            F.struct(
                sum((F.when(a == b, 1).otherwise(0) for b in answers), F.lit(0)).alias("n"),
                F.lit(-i).alias("first"),
                a.alias("answer"),
            ),
        )
        for i, a in enumerate(answers)
    ]
    return F.array_max(F.array(*ranked))["answer"]


def score_from_text(answer: Column) -> Column:
    """The first number in an answer, when it is a whole number from 1 to 5; NULL otherwise.

    "4 out of 5" is 4; "10", "-3", "4.5" and "level 45" are no scores.
    """
    # One search, so that ``answer`` is worked out once: no number before the digit, none that goes on after it.
    digit = F.regexp_extract(answer, r"(?s)\A(?:[^\d-]++|-(?!\d))*+([1-5])(?!\d|[.,]\d)", 1)
    return digit.try_cast("int")


# --- Labels -----------------------------------------------------------------------------------


def upsale_outcome(attempted: Column, success: Column) -> Column:
    """Outcome label of a call; NULL unless both inputs are known."""
    known = attempted.isNotNull() & success.isNotNull()
    return F.when(
        known,
        F.when(~attempted, "No Upsale Attempted")
        .when(success, "Successful Upsales")
        .otherwise("Failed Upsales"),
    )


def concern_label(addressed: Column, labels: list[str] = S.CONCERN_LABELS) -> Column:
    """Label of a boolean as ``labels[0]`` (false) or ``labels[1]`` (true); NULL stays NULL."""
    return F.when(addressed, labels[1]).when(~addressed, labels[0])


def in_order(label: Column, order: list[str]) -> Column:
    """Sort key placing ``label`` at its position in an explicit category order."""
    return F.array_position(F.array(*[F.lit(x) for x in order]), label)


# --- Dates and times --------------------------------------------------------------------------


def month_start(date: Column) -> Column:
    return F.trunc(date, "month")


def month_label(month: Column) -> Column:
    return F.date_format(month, "MMM yy")


def month_key(month: Column) -> Column:
    return F.date_format(month, "yyyy-MM")


def parse_day(text: Column) -> Column:
    """Date from the ``MM.dd.yyyy`` parameter format."""
    return F.to_date(text, "MM.dd.yyyy")


def clock(seconds: Column) -> Column:
    """``HH:mm:ss`` of a number of seconds, wrapping at midnight."""
    s = F.pmod(seconds, F.lit(86400)).cast("int")
    pad = lambda x: F.lpad(x.cast("string"), 2, "0")
    return F.concat_ws(
        ":", pad(F.floor(s / 3600)), pad(F.floor(F.pmod(s, F.lit(3600)) / 60)), pad(F.pmod(s, F.lit(60)))
    )


# --- Text -------------------------------------------------------------------------------------


def drop_blank_lines(text: Column) -> Column:
    """Trim the text and remove lines that hold only white space."""
    trimmed = F.btrim(text, F.lit(" \t\n\r\x0b\x0c"))
    lines = F.split(trimmed, r"\R")
    return F.array_join(F.filter(lines, lambda line: line.rlike(r"\S")), "\n")


def as_markdown(text: Column) -> Column:
    """Markdown of a transcript: hard line breaks, and the first word of each line in bold."""
    bold = F.regexp_replace(text, r"(?mdU)^(\w+)", "**$1**")
    return F.replace(bold, F.lit("\n"), F.lit("  \n"))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"\S+"))


def text_file_name(call_id: Column) -> Column:
    return F.concat(call_id, F.lit(".txt"))


def full_name(first: Column, last: Column) -> Column:
    return F.concat_ws(" ", first, last)


def render(template: str, **values: Column) -> Column:
    """A template with ``{name}`` fields as one string column."""
    parts = []
    for literal, field, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if field:
            parts.append(values[field].cast("string"))
    return F.concat(*parts)


# --- Scaling ----------------------------------------------------------------------------------


def bubble_size(value: Column, low: Column, high: Column) -> Column:
    """Linear rescale of a count to the bubble range; the top size when all counts are equal."""
    span = S.MAX_BUBBLE - S.MIN_BUBBLE
    return F.when(high == low, F.lit(S.MAX_BUBBLE)).otherwise(
        F.lit(S.MIN_BUBBLE) + (value - low) * F.lit(span) / (high - low)
    )
