"""Personal data in transcripts as spans: one detection, from which text, report and HTML are made.

Every recognizer sees the original text. E-mail addresses and phone numbers are found by pattern; people by an
Aho-Corasick automaton over the names that belong to the row, so the cost of a text grows with its length and
with the names' total length, not with their product. Spans below the threshold go; of overlapping spans the one with the
better score stays, then the longer, then the earlier one. What stays is replaced, marked or counted from
the same spans. Places are counted in characters, the end is exclusive.

A text may have any number of names: ``detect_with_names`` deals them to chunks of bounded size, searches each
chunk beside the text, and settles overlaps once all of a text's spans are together.
"""

from __future__ import annotations

import re
import sys
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Worker functions travel with their code: nothing of this package has to be installed on the workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# --- Fixed values: entities, patterns, replacement values, score threshold --------------------

ENTITIES = ["PERSON", "EMAIL", "PHONE"]

PATTERNS = {
    "EMAIL": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "PHONE": (
        r"(?:\+\d{1,2} )?\(\d{3}\) ?\d{3}-\d{4}|\b(?:1-)?\d{3}-\d{3}-\d{4}\b"
        r"|\b\d{3}\.\d{3}\.\d{4}\b|\+\d{1,3}(?: \d{2,4}){2,4}\b"
    ),
}

SCORES = {"EMAIL": 1.0, "PHONE": 0.95, "PERSON": 0.9}

OPERATORS = {
    "PERSON": ("replace", {"new_value": "John Doe"}),
    "EMAIL": ("replace", {"new_value": "john_doe@email.com"}),
    "PHONE": ("replace", {"new_value": "123456789"}),
}

THRESHOLD = 0.8

# What every phone number begins with or holds; a text without it is spared the pattern.
_PHONE_NEEDLE = r"\(\d{3}\)|\d{3}-\d{3}-\d|\d{3}\.\d{3}\.\d|\+\d{1,3} \d\d"

Span = tuple[str, int, int, float]  # entity, start, end, score


def active(entities: Sequence[str], threshold: float) -> list[str]:
    """The entities to look for, best score first."""
    if unknown := set(entities) - set(SCORES):
        raise ValueError(f"no recognizer for {sorted(unknown)}")
    return sorted((e for e in entities if SCORES[e] >= threshold), key=lambda e: -SCORES[e])


# --- Recognizers ------------------------------------------------------------------------------

_PATTERN = {e: re.compile(p, re.ASCII) for e, p in PATTERNS.items()}
_NEEDLE = re.compile(_PHONE_NEEDLE, re.ASCII)
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the address pattern, found from each "@" on; nothing else of the text is looked at."""
    done = 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        match = _PATTERN["EMAIL"].match(text, begin) if begin < at else None
        if match:
            yield match.span()
        done = match.end() if match else at + 1
        at = text.find("@", done)


def phones(text: str) -> Iterator[tuple[int, int]]:
    if _NEEDLE.search(text):
        for match in _PATTERN["PHONE"].finditer(text):
            yield match.span()


def folded(text: str) -> str:
    """Lower case, each character by a single one, so that places stay."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def _in_word(text: str, at: int) -> bool:
    return 0 <= at < len(text) and (text[at].isalnum() or text[at] == "_")


class Names:
    """Finds names as whole words in any case, each taken literally."""

    def __init__(self, names: Iterable[str | None]):
        import ahocorasick

        self.found = ahocorasick.Automaton()
        for name in {folded(n) for n in names if n}:
            self.found.add_word(name, len(name))
        if len(self.found):
            self.found.make_automaton()

    def __call__(self, text: str) -> Iterator[tuple[int, int]]:
        if not len(self.found):
            return
        low = folded(text)
        for last, size in self.found.iter(low):
            start = last + 1 - size
            if not _in_word(text, start - 1) and not _in_word(text, last + 1):
                yield start, last + 1


def spans_of(text: str, entities: Sequence[str], names: Iterable[str | None] = ()) -> list[Span]:
    """All spans of the active ``entities``, overlapping ones too."""
    recognizers: dict[str, Callable[[str], Iterable[tuple[int, int]]]] = {"EMAIL": emails, "PHONE": phones}
    if names is not None and "PERSON" in entities:
        recognizers["PERSON"] = Names(names)
    return [(e, start, end, SCORES[e]) for e in entities if e in recognizers for start, end in recognizers[e](text)]


def resolved(spans: Iterable[Span]) -> list[Span]:
    """Spans that do not overlap, by place: the better score wins, then the longer span, then the earlier one."""
    starts: list[int] = []
    kept: list[Span] = []
    for span in sorted(set(spans), key=lambda s: (-s[3], s[1] - s[2], s[1], s[0])):
        at = bisect_left(starts, span[1])
        if (at == 0 or kept[at - 1][2] <= span[1]) and (at == len(kept) or span[2] <= starts[at]):
            starts.insert(at, span[1])
            kept.insert(at, span)
    return kept


# --- Rows -------------------------------------------------------------------------------------

_SPANS = "array<struct<entity: string, start: int, end: int, score: double>>"
_TYPE = pa.list_(pa.struct([("entity", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def _as_structs(spans: Iterable[Span]) -> list[dict]:
    return [dict(zip(("entity", "start", "end", "score"), s, strict=True)) for s in spans]


def _as_spans(structs: Iterable[dict] | None) -> list[Span]:
    return [(s["entity"], s["start"], s["end"], s["score"]) for s in structs or ()]


#: Bytes of input that a worker turns into Python objects at once, or one row.
SLICE = 1_000_000


def slices(batch: pa.RecordBatch, inputs: Sequence[str], limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` whose columns ``inputs`` hold ``limit`` bytes at most, or one row each."""
    if batch.num_rows < 2 or sum(batch.column(c).nbytes for c in inputs) <= limit:
        yield batch
        return
    half = batch.num_rows // 2
    for part in (batch.slice(0, half), batch.slice(half)):
        yield from slices(part, inputs, limit)


def _mapped(df: DataFrame, work: Callable[..., object], inputs: list[str], output: str, kind: str, arrow: pa.DataType) -> DataFrame:
    """Add the column ``output``: ``work`` of the input columns, row by row within Arrow batches.

    A worker holds one slice of a batch as Python objects, so its memory does not grow with the rows of a batch."""
    columns = [c for c in df.columns if c != output]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*[F.col(f"`{c}`") for c in columns]).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, inputs)):
            values = [work(*row) for row in zip(*(batch.column(c).to_pylist() for c in inputs), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(values, arrow)], [*columns, output])

    return df.select(*[F.col(f"`{c}`") for c in columns]).mapInArrow(run, f"{schema}, `{output}` {kind}")


def detect(
    texts: DataFrame,
    entities: Sequence[str] = tuple(ENTITIES),
    threshold: float = THRESHOLD,
    text_column: str = "text",
    names_column: str | None = None,
) -> DataFrame:
    """Add ``spans``: what was found in the row's text, resolved, by place. A NULL text has none.

    ``names_column``: an array of the names to look for in this row. Nothing is shuffled.
    """
    looked_for = active(entities, threshold)

    def work(text: str | None, names: list[str | None] | None = None) -> list[dict]:
        return _as_structs(resolved(spans_of(text, looked_for, names or ()))) if text else []

    return _mapped(texts, work, [text_column, *([names_column] if names_column else [])], "spans", _SPANS, _TYPE)


#: Names of one automaton.
CHUNK = 2_000


def chunked_names(names: DataFrame, key: str, chunk: int = CHUNK) -> DataFrame:
    """(key, part, parts, names): the distinct names of each key in lists of about ``chunk``.

    ``names``: (key, name). Distinct names are dealt to as many parts as their number asks for, by their hash."""
    each = names.filter("name is not null and name <> ''").groupBy(key, "name").agg(F.lit(1).alias("_one"))
    sizes = each.groupBy(key).agg(F.ceil(F.count("*") / F.lit(chunk)).cast("int").alias("parts"))
    dealt = each.join(sizes, key).withColumn("part", F.pmod(F.xxhash64("name"), F.col("parts")).cast("int"))
    return dealt.groupBy(key, "part").agg(F.first("parts").alias("parts"), F.collect_list("name").alias("names"))


def detect_with_names(
    texts: DataFrame,
    names: DataFrame,
    key: str,
    entities: Sequence[str] = tuple(ENTITIES),
    threshold: float = THRESHOLD,
    chunk: int = CHUNK,
) -> DataFrame:
    """``detect`` for names that come as rows (key, name), however many a key has; ``key`` is unique in ``texts``.

    A text with one chunk of names, or none, is done where the two meet. One with more is searched once a chunk, by as
    many tasks as Spark deals the join to; only its spans are then grouped, and meet the text again.
    """
    looked_for = active(entities, threshold)
    chunks = chunked_names(names, key, chunk)
    one = texts.join(chunks.filter("parts = 1").select(key, F.col("names").alias("_names")), key, "left")
    many = chunks.filter("parts > 1")
    several = many.select(key).distinct()
    whole = detect(one.join(several, key, "left_anti"), entities, threshold, names_column="_names").drop("_names")

    def found(text: str | None, of: list[str]) -> list[dict]:
        return _as_structs(spans_of(text, [e for e in looked_for if e == "PERSON"], of)) if text else []

    searched = _mapped(texts.select(key, "text").join(many, key).select(key, "text", "names"), found, ["text", "names"], "spans", _SPANS, _TYPE)
    people = searched.select(key, F.explode("spans").alias("s")).groupBy(key).agg(F.collect_set("s").alias("_people"))

    def settled(text: str | None, of: list[dict] | None) -> list[dict]:
        patterns = spans_of(text, [e for e in looked_for if e != "PERSON"]) if text else []
        return _as_structs(resolved([*patterns, *_as_spans(of)]))

    rest = texts.join(several, key, "left_semi").join(people, key, "left")
    return whole.unionByName(_mapped(rest, settled, ["text", "_people"], "spans", _SPANS, _TYPE).drop("_people"))


# --- Outputs ----------------------------------------------------------------------------------


def rewritten(text: str, spans: Sequence[Span], value: Callable[[str, str], str], between: Callable[[str], str] = str) -> str:
    """``text`` in one pass: ``value(entity, found)`` for each span, ``between`` for the rest."""
    out, done = [], 0
    for entity, start, end, _ in spans:
        out += [between(text[done:start]), value(entity, text[start:end])]
        done = end
    return "".join([*out, between(text[done:])])


def with_replaced(detected: DataFrame, operator_map: Mapping = OPERATORS, entities: Sequence[str] = tuple(ENTITIES), output: str = "masked") -> DataFrame:
    """Add the text with each span replaced by its entity's value."""
    values = {}
    for entity in entities:
        operator, params = operator_map.get(entity, (None, {}))
        if operator != "replace":
            raise ValueError(f"operator for {entity} must be 'replace', not {operator!r}")
        values[entity] = params["new_value"]

    def work(text: str | None, spans: list[dict] | None) -> str | None:
        return None if text is None else rewritten(text, _as_spans(spans), lambda entity, _: values[entity])

    return _mapped(detected, work, ["text", "spans"], output, "string", pa.string())


def _as_html(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def with_html(detected: DataFrame, output: str = "html") -> DataFrame:
    """Add the text as HTML, each span in a ``mark`` element that names its entity."""

    def work(text: str | None, spans: list[dict] | None) -> str | None:
        return None if text is None else rewritten(text, _as_spans(spans), lambda e, found: f'<mark class="{e}">{_as_html(found)}</mark>', _as_html)

    return _mapped(detected, work, ["text", "spans"], output, "string", pa.string())


def as_rows(detected: DataFrame, key: str = "text_file") -> DataFrame:
    """(key, entity, start, end, score): one row per span; texts are not read."""
    return detected.select(key, F.inline("spans"))


def findings(detected: DataFrame, key: str = "text_file") -> DataFrame:
    """(key, entity, position, finding): the found strings, numbered per text and entity."""

    def work(text: str | None, spans: list[dict] | None) -> list[dict]:
        seen: dict[str, int] = {}
        out = []
        for entity, start, end, _ in _as_spans(spans):
            out.append({"entity": entity, "position": seen.get(entity, 0), "finding": text[start:end]})
            seen[entity] = seen.get(entity, 0) + 1
        return out

    kind = pa.list_(pa.struct([("entity", pa.string()), ("position", pa.int32()), ("finding", pa.string())]))
    listed = _mapped(detected.select(key, "text", "spans"), work, ["text", "spans"], "found", "array<struct<entity: string, position: int, finding: string>>", kind)
    return listed.select(key, F.inline("found"))


def report(detected: DataFrame, key: str = "text_file") -> DataFrame:
    """(key, entity, findings): how many spans a text has of each entity, where it has any; texts are not read."""
    kinds = F.array_sort(F.array_distinct(F.transform("spans", lambda s: s["entity"])))
    each = detected.select(key, "spans", F.explode(kinds).alias("entity"))
    return each.select(key, "entity", F.size(F.filter("spans", lambda s: s["entity"] == F.col("entity"))).alias("findings"))
