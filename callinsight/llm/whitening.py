"""Whitening of embeddings with a covariance recovered from sums of squares alone (polarisation).

``Var(a + b) = Var(a) + Var(b) + 2 Cov(a, b)``: one aggregate of the squared centred value of every dimension and
of every sum of two dimensions gives all covariances as differences of variances. Entries are scaled to
whole numbers ``x = floor(scale * c)``, and what is squared is ``n * x - S`` (``n`` vectors, sums ``S``), so all
of it is exact: squares are added up in parts of 31 bits, first within each task, then in one row a pair of
dimensions. The driver gets that matrix, whose size is the dimensions', and its eigenvectors are the components.

The fit list is each distinct ``x`` once: equal vectors are folded within each task before they are dealt by value,
so one vector with a third of all rows costs one row a task. It is written, and read for the sums, the
squares and the check of the result. Rows themselves are never shuffled.

Rows: vectors that are NULL, or hold a NULL or an entry that is not finite, are dropped, and so is an empty vector,
which has no component; a NULL id comes back as NULL, repeated rows each give their rows, an empty table gives
an empty result; other columns are not read. Vectors of different lengths, or entries of which
``x`` would pass 2^53, raise. Components without variance (rank below the dimensions) are not returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callinsight.llm.common import written

_BITS = 31
_LOW = (1 << _BITS) - 1
#: Rows worked on at once in a worker.
BLOCK = 1024


# --- Exact sums -------------------------------------------------------------------------------


def square_parts(z: np.ndarray) -> np.ndarray:
    """(6, columns): the sum over rows of ``z * z`` (entries below 2^62), in parts that 64 bits hold."""
    high, low = z >> _BITS, z & _LOW
    products = (high * high, high * low, low * low)
    return np.array([s for p in products for s in ((p >> _BITS).sum(axis=0), (p & _LOW).sum(axis=0))])


def joined(parts: list[int]) -> int:
    """The whole number of :func:`square_parts`."""
    hh, hl, ll = ((int(parts[k]) << _BITS) + int(parts[k + 1]) for k in (0, 2, 4))
    return (hh << 2 * _BITS) + (hl << _BITS + 1) + ll


def unpacked(batch: pa.RecordBatch, size: int) -> np.ndarray:
    """(rows, size) whole numbers of the column ``x``."""
    out = np.empty((batch.num_rows, size), np.int64)
    for r, x in enumerate(batch.column("x")):
        raw = x.as_py()
        out[r] = np.frombuffer(raw, f"<i{len(raw) // size}")
    return out


def blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            yield part, unpacked(part, size)


# --- The model --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Whitener:
    """``sums``: of each dimension over ``n`` vectors. ``axes``: unit eigenvectors as columns, by falling ``values``."""

    n: int
    sums: np.ndarray
    covariance: np.ndarray
    values: np.ndarray
    axes: np.ndarray
    identity_error: float = 0.0

    @property
    def explained(self) -> np.ndarray:
        return self.values / np.trace(self.covariance)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return ((self.n * x - self.sums) / self.n) @ self.axes / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> np.ndarray:
        """Sum over dimensions of ``(n * x - S)**2``; raises where 64 bits cannot hold it."""
        y = self.n * x - self.sums
        if float(np.abs(y).max(initial=0)) ** 2 * y.shape[1] < 2**62:
            return (y * y).sum(axis=1)
        exact = [sum(v * v for v in row) for row in y.tolist()]
        if max(exact) >= 2**63:
            raise OverflowError("deviation does not fit a long; leave it out or scale by less")
        return np.array(exact, np.int64)


@dataclass
class Whitening:
    """``components``: so many are returned. ``scale``: entries become ``floor(scale * c)``."""

    components: int = 4
    scale: float = 256.0
    vector: str = "embedding"
    key: str = "vec_id"

    def scaled(self, rows: DataFrame) -> DataFrame:
        """(id, size, x): the remaining rows; ``x`` in the fewest of 2, 4 or 8 bytes an entry that hold the vector."""
        scale = self.scale

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, vectors, sizes, found = batch.column("id").to_pylist(), batch.column("v"), [], []
                kept = []
                for key, v in zip(ids, vectors, strict=True):
                    if not v.is_valid or not len(v.values) or v.values.null_count:
                        continue
                    c = v.values.to_numpy()
                    if not np.isfinite(c).all():
                        continue
                    x = np.floor(scale * c)
                    top = float(np.abs(x).max())
                    if top >= 2**53:
                        raise OverflowError(f"an entry of vector {key} is too large: {top / scale}")
                    width = "<i2" if top < 2**15 else "<i4" if top < 2**31 else "<i8"
                    kept.append(key)
                    sizes.append(len(x))
                    found.append(x.astype(width).tobytes())
                columns = [pa.array(kept, pa.int64()), pa.array(sizes, pa.int32()), pa.array(found, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "size", "x"])

        narrow = rows.select(F.col(self.key).cast("long").alias("id"), F.col(self.vector).cast("array<double>").alias("v"))
        return narrow.mapInArrow(run, "id long, size int, x binary")

    def fit(self, rows: DataFrame) -> Whitener | None:
        """The model of ``rows`` (vec_id, embedding); None where no vector remains."""
        fit_list = written(self.scaled(rows).select("size", "x").distinct(), "fit-list")
        sizes = [r["size"] for r in fit_list.select("size").distinct().limit(2).collect()]
        if not sizes:
            return None
        if len(sizes) > 1:
            raise ValueError(f"vectors of different lengths, for instance {sorted(sizes)}")
        size, vectors = sizes[0], fit_list.select("x")
        n, sums = self._sums(vectors, size)
        covariance = self._covariance(vectors, n, sums)
        values, axes = np.linalg.eigh(covariance)
        values, axes = values[::-1][: self.components], axes[:, ::-1][:, : self.components]
        real = values > size * np.finfo(float).eps * max(values[0], 0.0)
        model = Whitener(n, sums, covariance, values[real], axes[:, real])
        return Whitener(n, sums, covariance, values[real], axes[:, real], self._identity_error(vectors, model, size))

    def _sums(self, vectors: DataFrame, size: int) -> tuple[int, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, total = 0, np.zeros(size, np.int64)
            for _, x in blocks(batches, size):
                n, total = n + len(x), total + x.sum(axis=0)
            if n:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), pa.array([n] * size, pa.int64()), pa.array(total, pa.int64())], ["i", "n", "s"])

        made = vectors.mapInArrow(run, "i int, n long, s long").groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
        sums = np.zeros(size, np.int64)
        for r in made:
            sums[r["i"]] = r["s"]
        return made[0]["n"], sums

    def _covariance(self, vectors: DataFrame, n: int, sums: np.ndarray) -> np.ndarray:
        """One row a pair of dimensions comes back: the exact sum of squares of ``y_i + y_j``, or of ``y_i``."""
        size = len(sums)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = [np.zeros((6, size - i), np.int64) for i in range(size)]
            seen = False
            for _, x in blocks(batches, size):
                seen, y = True, n * x - sums
                for i in range(size):
                    z = y[:, i:] + y[:, i : i + 1]
                    z[:, 0] = y[:, i]
                    total[i] += square_parts(z)
            if seen:
                i, j = np.triu_indices(size)
                parts = np.concatenate(total, axis=1)
                columns = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), *[pa.array(p, pa.int64()) for p in parts]]
                yield pa.RecordBatch.from_arrays(columns, ["i", "j", *names])

        names = [f"p{k}" for k in range(6)]
        made = vectors.mapInArrow(run, "i int, j int, " + ", ".join(f"{c} long" for c in names))
        wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in names]
        squares = {(r["i"], r["j"]): joined([r[c] for c in names]) for r in made.groupBy("i", "j").agg(*wide).collect()}
        out = np.empty((size, size))
        for (i, j), s in squares.items():
            # Whole numbers until the one division, which Python rounds correctly.
            cross = s if i == j else s - squares[i, i] - squares[j, j]
            out[i, j] = out[j, i] = cross / (n**3 if i == j else 2 * n**3)
        return out

    def _identity_error(self, vectors: DataFrame, model: Whitener, size: int) -> float:
        """Largest entry of the covariance of the whitened fit list minus the identity, measured on the list."""
        k = len(model.values)
        if not k:
            return 0.0

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((k, k))
            for _, x in blocks(batches, size):
                w = model.whiten(x)
                total += w.T @ w
            i, j = np.indices((k, k))
            yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], ["i", "j", "s"])

        made = vectors.mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
        return max(abs(r["s"] / model.n - (r["i"] == r["j"])) for r in made)

    def transform(self, rows: DataFrame, model: Whitener) -> DataFrame:
        """(vec_id, component, n, deviation, whitened, explained, identity_error): a row per vector and component."""
        k, size = len(model.values), len(model.sums)
        share, error, n = model.explained, model.identity_error, model.n

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, x in blocks(batches, size):
                w, count = model.whiten(x), len(x)
                columns = [
                    part.column("id").take(pa.array(np.repeat(np.arange(count), k))),
                    pa.array(np.tile(np.arange(1, k + 1), count), pa.int32()),
                    pa.array(np.full(count * k, n), pa.int64()),
                    pa.array(np.repeat(model.deviation(x), k), pa.int64()),
                    pa.array(w.ravel()),
                    pa.array(np.tile(share, count)),
                    pa.array(np.full(count * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

        names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        return self.scaled(rows).select("id", "x").mapInArrow(run, _RESULT)

    def fit_transform(self, rows: DataFrame) -> DataFrame:
        model = self.fit(rows)
        return rows.sparkSession.createDataFrame([], _RESULT) if model is None else self.transform(rows, model)


_RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
