"""Runs of repeated words against a scan of every period."""

import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from callinsight.llm import queries, runs

SF = "/root/testdata/sf0.01"


def brute(w, least=24, times=3):
    """{(start, length): smallest period}, from the stretches in which words q apart agree."""
    found = {}
    for q in range(1, len(w) // times + 1):
        same = np.concatenate(([False], w[:-q] == w[q:], [False]))
        edges = np.flatnonzero(np.diff(same.astype(np.int8)))
        for a, b in zip(edges[::2], edges[1::2], strict=True):
            if b - a + q >= max(least, times * q):
                found.setdefault((int(a), int(b - a + q)), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def found_in(documents, **rule):
    words = np.concatenate([*documents, np.zeros(0, np.int64)]).astype(np.int64)
    document = np.repeat(np.arange(len(documents)), [len(d) for d in documents])
    start, length, period = runs.runs_of(words, document, **rule)
    first = np.cumsum([0, *map(len, documents)])
    out = [[] for _ in documents]
    for s, n, q in zip(start, length, period, strict=True):
        out[document[s]].append((int(s - first[document[s]]), int(n), int(q)))
    return out


WORDS = st.lists(st.integers(0, 3), max_size=40)
PERIODIC = st.tuples(WORDS, st.lists(st.integers(0, 2), min_size=1, max_size=12), st.integers(1, 12), WORDS, st.integers(0, 90)).map(
    lambda p: np.array([*p[0], *(p[1] * p[2]), *p[1][: p[4] % len(p[1])], *p[3]], np.int64)
)


@settings(max_examples=400, deadline=None)
@given(st.lists(PERIODIC, min_size=1, max_size=4), st.sampled_from([(24, 3), (24, 4), (12, 3), (6, 3), (3, 3)]))
def test_any_words(documents, rule):
    least, times = rule
    assert found_in(documents, least=least, times=times) == [brute(d, least, times) for d in documents]


@pytest.mark.parametrize("period", [1, 7, 33_333])
def test_long_repetition(period):
    assert found_in([np.arange(200_000) % period]) == [[(0, 200_000, period)]]


def test_fibonacci_words():
    a, b = [0], [0, 1]
    while len(b) < 1500:
        a, b = b, b + a
    assert found_in([np.array(b)]) == [brute(np.array(b))]


def test_rule_is_checked():
    with pytest.raises(ValueError):
        runs.runs_of(np.zeros(3, np.int64), np.zeros(3, np.int64), least=24, times=2)


def plain(doc, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc).encode())
    n, g = len(words), h // 10
    if doc is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [*words[:a], *(words[a + (i - a) % p] for i in range(a, n))]
    number = {w: k for k, w in enumerate(dict.fromkeys(words))}
    found = brute(np.array([number[w] for w in words], np.int64))
    drop = {i for s, n, q in found for i in range(s + q, s + n)}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    top = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found).encode()
    return (doc, len(found), *top, sha(listed), sha(b" ".join(w for i, w in enumerate(words) if i not in drop)))


def key(row):
    return [(v is None, str(v)) for v in row]


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = queries.queries()["op12_periodic_runs"](spark, SF).select(COLUMNS).collect()
    want = [plain(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert sum(r[1] > 0 for r in want) > 50


def test_awkward_rows(spark):
    rows = [(None, "a b " * 30, "x"), (1, None, "x"), (1, "", "x"), (2, " \n ", "x"), (3, "word.\x0b" * 30_000, "x"), (3, "word.\x0b" * 30_000, "x")]
    rows += [(4, "x y z " * 20 + "x y " * 20, "x"), (None, None, "x"), (5, "é" * 50 + "\x1c a", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string").withColumn("id", F.lit("i")).withColumn("collapsed", F.lit(2))
    found = runs.RepeatedRuns(plant=True).find(docs)
    got = runs.summary(found).select(COLUMNS).collect()
    assert sorted(map(tuple, got), key=key) == sorted((plain(d, t) for d, t, _ in rows), key=key)
    (as_is,) = runs.RepeatedRuns().find(docs).where("doc_id = 4").collect()
    assert [tuple(r) for r in as_is.runs] == [(0, 62, 3), (60, 40, 2)]
    assert runs.summary(runs.RepeatedRuns().find(docs.where("false"))).count() == 0


def test_collapsed_text(spark):
    text = "start " + "one two three " * 9 + "one end"
    row = runs.RepeatedRuns().find(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(r) for r in row.runs] == [(1, 28, 3)]
    assert row.collapsed == "start one two three end"
