"""Whitening against exact arithmetic on the whole fit list."""

import math
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from callinsight.llm import queries, whitening

SF = "/root/testdata/sf0.01"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(-(2**61), 2**61), min_size=2, max_size=2), min_size=1, max_size=20))
def test_exact_sums_of_squares(rows):
    parts = whitening.square_parts(np.array(rows, np.int64))
    assert [whitening.joined(parts[:, c]) for c in range(2)] == [sum(r[c] ** 2 for r in rows) for c in range(2)]


def plain(vectors):
    """(x of each remaining row, fit list, exact covariance)"""
    xs = [tuple(math.floor(256 * float(c)) for c in v) for v in vectors if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted(set(xs))
    n, d = len(fit), len(fit[0])
    mean = [Fraction(sum(x[k] for x in fit), n) for k in range(d)]
    centred = [[x[k] - mean[k] for k in range(d)] for x in fit]
    return xs, fit, np.array([[float(sum(c[i] * c[j] for c in centred) / n) for j in range(d)] for i in range(d)])


def check(got, ids, vectors):
    """All result rows ``got`` against plain arithmetic."""
    xs, fit, covariance = plain(vectors)
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    kept = [i for i, v in zip(ids, vectors, strict=True) if v and all(c is not None and math.isfinite(c) for c in v)]
    k = min(4, len(values), int((values > len(values) * np.finfo(float).eps * values[0]).sum()))
    rows = sorted(got, key=lambda r: (r.vec_id, r.component))
    assert len(rows) == k * len(kept)
    order = sorted(range(len(kept)), key=lambda i: kept[i])
    assert [r.vec_id for r in rows[::k]] == [kept[i] for i in order]
    x = np.array([xs[i] for i in order], float)
    want = (x - np.array(sums) / n) @ axes[:, :k] / np.sqrt(values[:k])
    have = np.array([r.whitened for r in rows]).reshape(-1, k)
    sign = np.sign((want * have).sum(axis=0))
    assert np.allclose(have, want * sign, rtol=1e-7, atol=1e-9)
    assert [r.deviation for r in rows[::k]] == [sum((n * c - s) ** 2 for c, s in zip(xs[i], sums, strict=True)) for i in order]
    assert np.allclose([r.explained for r in rows[:k]], values[:k] / np.trace(covariance), rtol=1e-9)
    assert {r.n for r in rows} == {n} and len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9


def test_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    check(queries.queries()["op13_whitening"](spark, SF).collect(), [r.vec_id for r in rows], [r.embedding for r in rows])


def test_awkward_rows(spark):
    rng = np.random.default_rng(5)
    vectors = [[float(c) for c in rng.normal(0, 3, 5) * [9, 4, 2, 1, 0.01]] for _ in range(60)]
    vectors += [vectors[0]] * 40 + [None, [], [1.0, None, 1.0, 1.0, 1.0], [math.nan] * 5, [1.0, math.inf, 0.0, 0.0, 0.0], [-0.0, 0.0, -1e-9, 300.0, -9000.5]]
    rows = list(enumerate(vectors))
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit("x")).withColumn("x", F.lit(1)).withColumn("n", F.lit(2))
    got = whitening.Whitening().fit_transform(table.repartition(3)).collect()
    check(got, [i for i, _ in rows], vectors)
    assert whitening.Whitening().fit_transform(table.where("false")).count() == 0
    assert whitening.Whitening().fit_transform(table.where("vec_id = 3")).count() == 0  # one vector: no variance
    unnamed = table.withColumn("vec_id", F.lit(None).cast("long"))
    assert whitening.Whitening().fit_transform(unnamed).where("vec_id is null").count() == len(got)


def test_rank_below_the_dimensions(spark):
    table = spark.createDataFrame([(k, [float(k), 2.0 * k, 7.0]) for k in range(9)], "vec_id long, embedding array<double>")
    got = whitening.Whitening().fit_transform(table).collect()
    assert {r.component for r in got} == {1} and math.isclose(got[0].explained, 1.0)
    assert math.isclose(sum(r.whitened**2 for r in got), 9.0)


def test_wrong_vectors_raise(spark):
    mixed = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError):
        whitening.Whitening().fit_transform(mixed)
    with pytest.raises(Exception, match="too large"):
        whitening.Whitening().fit_transform(spark.createDataFrame([(1, [1e300])], "vec_id long, embedding array<double>"))


def test_deviation_beyond_64_bits_raises():
    model = whitening.Whitener(2**40, np.zeros(2, np.int64), np.eye(2), np.ones(2), np.eye(2))
    with pytest.raises(OverflowError):
        model.deviation(np.array([[2**20, 2**20]]))
