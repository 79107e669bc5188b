"""Personal data: patterns propose spans, validators confirm them, words nearby adjust the score.

Each kind has one pattern, a validator where the kind has a checksum or a range (Luhn for cards, mod 97 for
account numbers, 255 for address parts, digit counts for phones), a prior, and cue words. A span's score
is the prior, raised by a passed checksum and by a cue word within ``NEAR`` code points, lowered by a
contrary cue. The four base kinds are always reported; the added kinds need ``threshold``.

Each text is scanned in its own task row, whole; nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callinsight.llm.common import external_id, internal_id, text_of

NEAR = 40
CONTRARY = ("order", "invoice", "isbn", "version", "sku", "serial", "part no")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


# --- Validators -------------------------------------------------------------------------------


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for n, c in enumerate(reversed(digits)):
        d = int(c) * (1 + n % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def is_card(text: str) -> bool:
    digits = digits_of(text)
    return 14 <= len(digits) <= 19 and luhn(digits)


def is_address(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in text.split("."))


def is_phone(text: str) -> bool:
    return 10 <= len(digits_of(text)) <= 15


def is_account(text: str) -> bool:
    """An international bank account number: the rotated number is 1 modulo 97."""
    plain = text.replace(" ", "").upper()
    if not 15 <= len(plain) <= 34:
        return False
    rotated = plain[4:] + plain[:4]
    return int("".join(str(int(c, 36)) for c in rotated)) % 97 == 1


def is_social(text: str) -> bool:
    area, group, serial = text.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    needs: str  # characters without any of which a text holds no such span
    valid: Callable[[str], bool] | None
    prior: float
    checked: float  # added when the validator has a checksum
    cues: tuple[str, ...]
    base: bool


KINDS = (
    Kind("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "@", None, 0.9, 0.0, ("mail", "contact", "write"), True),
    Kind("ip", r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", ".", is_address, 0.6, 0.0, ("ip", "address", "host", "server"), True),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])+", "", is_card, 0.3, 0.5, ("card", "visa", "credit", "payment", "paid"), True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", is_phone, 0.7, 0.0, ("phone", "call", "tel", "mobile", "fax"), True),
    Kind(
        "iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", "", is_account, 0.3, 0.6,
        ("iban", "account", "bank", "transfer"), False,
    ),
    Kind(
        "ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-", is_social, 0.4, 0.0,
        ("ssn", "social", "security", "taxpayer"), False,
    ),
)
ORDER = {kind.name: n for n, kind in enumerate(KINDS)}
_PATTERNS = {kind.name: re.compile(kind.pattern) for kind in KINDS}
_DIGIT = re.compile(r"[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The matches of the e-mail pattern, each found from its "@", so long runs of letters cost nothing."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def _proposals(kind: Kind, text: str) -> Iterator[tuple[int, int]]:
    if kind.name == "email":
        return _emails(text)
    return (match.span() for match in _PATTERNS[kind.name].finditer(text))


def score(kind: Kind, text: str, start: int, end: int) -> float:
    near = text[max(0, start - NEAR) : start].lower() + " " + text[end : end + NEAR].lower()
    value = kind.prior + (kind.checked if kind.checked and kind.valid else 0.0)
    value += 0.2 * any(cue in near for cue in kind.cues)
    value -= 0.2 * any(cue in near for cue in CONTRARY)
    return round(min(1.0, max(0.0, value)), 3)


def find(text: str, threshold: float = 0.5) -> list[Span]:
    """All spans by start, then kind. Within a kind they are leftmost and do not overlap; a proposal that
    its validator refuses is dropped without another try inside it."""
    found = []
    has_digit = _DIGIT.search(text) is not None
    for kind in KINDS:
        if kind.needs and kind.needs not in text or kind.name != "email" and not has_digit:
            continue
        for start, end in _proposals(kind, text):
            if kind.valid and not kind.valid(text[start:end]):
                continue
            value = score(kind, text, start, end)
            if kind.base or value >= threshold:
                found.append(Span(kind.name, start, end, value))
    found.sort(key=lambda s: (s.start, ORDER[s.kind]))
    return found


SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def detect(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(doc_id, spans), one row per row of ``docs`` (doc_id, text); NULL and empty texts have no spans.
    Offsets are code points, the end is exclusive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[s._asdict() for s in find(t.as_py(), threshold)] for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(spans, _ARROW)], ["id", "spans"])

    narrow = docs.select(internal_id().alias("id"), text_of().alias("text"))
    return narrow.mapInArrow(run, f"id long, spans {SPANS}").select(external_id("id").alias("doc_id"), "spans")


def mask(text: str, spans: list[Span]) -> str:
    """``text`` with each span replaced by its kind in brackets; of overlapping spans the first holds,
    widened to the last end."""
    out, at, n = [], 0, 0
    while n < len(spans):
        kind, start, end, _ = spans[n]
        n += 1
        while n < len(spans) and spans[n].start < end:
            end = max(end, spans[n].end)
            n += 1
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def masked(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced and ``n_chars``, where there is one, counted anew.
    All rows and columns stay; a NULL text stays NULL."""

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: None if t is None else mask(t, find(t, threshold)))

    out = docs.withColumn("text", clean("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)
