"""Spans of personal data: recognizers, overlaps, many names, and the outputs made from one detection."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from callinsight.operators import pii, spans

PIECES = st.sampled_from(["a", "B", "7", "555", "123-456-7890", "-", ".", "@", "+1 ", "(743) ", "555-3824", " ", "x.y@ab.co", "é", "_", "Ann", "ann lee", "\n", "4567", "+44 20 7946 0958", "İ"])
TEXTS = st.lists(PIECES, max_size=25).map("".join)


@settings(max_examples=500, deadline=None)
@given(TEXTS)
def test_patterns_find_what_a_plain_search_finds(text):
    assert list(spans.emails(text)) == [m.span() for m in re.finditer(spans.PATTERNS["EMAIL"], text, re.ASCII)]
    assert list(spans.phones(text)) == [m.span() for m in re.finditer(spans.PATTERNS["PHONE"], text, re.ASCII)]


NAMES = ["Ann", "Ann Lee", "Lee", "a", "J.R.", "7", "é"]


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.lists(st.sampled_from([*NAMES, "", None]), max_size=4))
def test_names_are_found_as_whole_words(text, names):
    low = spans.folded(text)
    want = {m.span(1) for n in names if n for m in re.finditer(rf"(?<!\w)(?=({re.escape(spans.folded(n))})(?!\w))", low)}
    assert set(spans.Names(names)(text)) == want


def by_trial(found):
    """Spans one by one in order of preference, each against all kept before."""
    kept = []
    for s in sorted(set(found), key=lambda s: (-s[3], -(s[2] - s[1]), s[1], s[0])):
        if all(s[2] <= k[1] or k[2] <= s[1] for k in kept):
            kept.append(s)
    return sorted(kept, key=lambda s: s[1])


SPAN = st.tuples(st.sampled_from(["EMAIL", "PHONE", "PERSON"]), st.integers(0, 30), st.integers(1, 9)).map(lambda t: (t[0], t[1], t[1] + t[2], spans.SCORES[t[0]]))


@settings(max_examples=500, deadline=None)
@given(st.lists(SPAN, max_size=20))
def test_overlaps(found):
    assert spans.resolved(found) == by_trial(found)


def test_an_entity_inside_another(spark):
    df = spark.createDataFrame([("1.txt", "mail ann.lee@x.com or 123-456-7890@y.org, Ann Lee Ray", ["Ann", "Lee", "Ann Lee", "Lee Ray Jr"])], "text_file string, text string, names array<string>")
    got = spans.detect(df, names_column="names").first().spans
    assert [(s.entity, s.start, s.end) for s in got] == [("EMAIL", 5, 18), ("EMAIL", 22, 40), ("PERSON", 42, 49)]
    low = spans.detect(df, threshold=0.95, names_column="names").first().spans
    assert {s.entity for s in low} == {"EMAIL"}


def test_all_outputs_come_from_one_detection(spark, tmp_path):
    text = "<Ann> wrote a@b.co & 111-222-3333"
    df = spark.createDataFrame([("1.txt", text, ["Ann"]), ("2.txt", None, None), ("3.txt", "", [])], "text_file string, text string, names array<string>")
    pii.detect(df, names_column="names").write.parquet(f"{tmp_path}/d")
    found = spark.read.parquet(f"{tmp_path}/d")
    rows = [tuple(r) for r in spans.as_rows(found).orderBy("start").collect()]
    assert rows == [("1.txt", "PERSON", 1, 4, 0.9), ("1.txt", "EMAIL", 12, 18, 1.0), ("1.txt", "PHONE", 21, 33, 0.95)]
    masked = {r.original_file: r for r in pii.anonymized(found).collect()}
    assert masked["1.txt"].text == "<John Doe> wrote john_doe@email.com & 123456789"
    assert masked["2.txt"].text is None and masked["2.txt"].error == "no text" and masked["3.txt"].text == ""
    html = {r.text_file: r.html for r in pii.highlighted(found).collect()}
    assert html["1.txt"] == '&lt;<mark class="PERSON">Ann</mark>&gt; wrote <mark class="EMAIL">a@b.co</mark> &amp; <mark class="PHONE">111-222-3333</mark>'
    assert {(r.entity, r.findings) for r in spans.report(found).collect()} == {("PERSON", 1), ("EMAIL", 1), ("PHONE", 1)}
    assert {(r.entity, r.position, text[s:e]) for r, (_, _, s, e, _) in zip(spans.findings(found).collect(), rows, strict=True)} == {
        (e, 0, text[s:t]) for _, e, s, t, _ in rows
    }
    assert "text" not in re.search(r"ReadSchema: struct<(.*?)>", spans.report(found)._jdf.queryExecution().executedPlan().toString())[1].replace("text_file", "")


def test_names_as_rows_equal_names_in_the_row(spark):
    texts = [(f"{n}.txt", f"Ann Lee {n} met Bob Ray and Zoë Ann, ann@x.co", [f"Name{k}" for k in range(n)] + ["Ann", "Ann Lee", "Bob Ray", None, ""][: n + 1]) for n in range(12)]
    df = spark.createDataFrame([*texts, ("none.txt", "Ann", []), ("null.txt", None, ["Ann"])], "text_file string, text string, names array<string>")
    names = df.select("text_file", F.explode("names").alias("name"))
    want = {r.text_file: r.spans for r in spans.detect(df, names_column="names").collect()}
    for chunk in (1, 3, 2_000):
        got = spans.detect_with_names(df.drop("names"), names, "text_file", chunk=chunk).collect()
        assert len(got) == len(want) and {r.text_file: r.spans for r in got} == want, chunk


def test_a_recording_of_very_many_names(spark):
    """A hundred thousand names of one text: no list of them is ever made, chunks stay bounded."""
    texts = spark.createDataFrame([("hot.txt", "I am Name 77777 speaking to name 5, not Name 100001 or xName 3"), ("other.txt", "Name 5")], "text_file string, text string")
    names = spark.range(100_000).selectExpr("'hot.txt' text_file", "concat('Name ', id) name")
    sizes = spans.chunked_names(names, "text_file").select(F.size("names").alias("n"), "parts").collect()
    assert max(r.n for r in sizes) < 1.2 * spans.CHUNK and sum(r.n for r in sizes) == 100_000 and {r.parts for r in sizes} == {50}
    got = {r.text_file: [(s.start, s.end) for s in r.spans] for r in spans.detect_with_names(texts, names, "text_file").collect()}
    assert got == {"hot.txt": [(5, 15), (28, 34)], "other.txt": []}


def test_long_texts_take_linear_time(spark):
    many = "ann@example.com, 123-456-7890 Ann " * 20_000
    row = spans.resolved(spans.spans_of(many, spans.active(spans.ENTITIES, 0.8), ["Ann"]))
    assert len(row) == 60_000
    assert list(spans.emails("@" * 100_000)) == [] and list(spans.emails("a" * 100_000)) == []


def test_unknown_entities_and_operators():
    with pytest.raises(ValueError):
        spans.active(["CARD"], 0.5)


def test_workers_hold_one_slice_of_a_batch(spark):
    import pyarrow as pa

    texts = ["x" * 300_000, None, "y", "é" * 900_000, "", *["z" * 10_000] * 500]
    names = [["Ann"] * 3] * len(texts)
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(names)], ["text", "names"])
    parts = list(spans.slices(batch, ["text", "names"]))
    assert pa.Table.from_batches(parts).to_pylist() == batch.to_pylist()
    assert all(p.num_rows == 1 or p.column("text").nbytes + p.column("names").nbytes <= spans.SLICE for p in parts)
    rows = spark.createDataFrame([(i, f"{t[:200_000] if t else t} a@b.co") for i, t in enumerate(texts[:40])], "n int, text string")
    found = spans.detect(rows.coalesce(1), ["EMAIL"]).selectExpr("n", "size(spans) as s").collect()
    assert sorted(found) == [(n, 1) for n in range(40)]
