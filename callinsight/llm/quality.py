"""A quality classifier learnt from weak labels.

Overlapping heuristic labellers vote on every document: good, bad or no opinion. Expectation maximisation over
the counts of vote patterns, taken over all documents, estimates how often each labeller is right and what
share of documents is good; no labels are needed. The posterior of a document's pattern is its soft label.
A linear scorer over hashed features (byte 4-grams and the measures behind the votes) is fitted to soft
labels of a bounded sample, and decides for every document together with what the labellers know.

Counting patterns is one aggregate with at most 3 ** labellers rows. Features come from a text's bytes in
whole-array operations, in slices, so a very long text needs no more memory than a short one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat
from operator import and_, contains, eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callinsight.llm.common import external_id, internal_id, text_of, written

SLICE = 1 << 20
#: Measures of a text, in the order of ``measures``.
MEASURES = ("marks", "unclean", "upper", "repeats", "runs", "squeezed", "digits", "length")
LABELLERS = ("marks", "unclean", "upper", "repeats", "runs", "squeezed")
GOOD, BAD, NONE = 1, 0, 2
FALSE_ALARMS, HITS = 0.02, 0.2


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_MARKS = b"#$%&*<>^~\\_{}[]|!"
_MARK, _UPPER = _table(_MARKS), _table(bytes(range(65, 91)))
_AS_HASH = bytes.maketrans(_MARKS, b"#" * len(_MARKS))
_LETTER = _table(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))


def measures(text: bytes) -> np.ndarray:
    """Shares in 0..1 (length: log10), all 0 for a text without words."""
    words = text.split()
    if not words:
        return np.zeros(len(MEASURES))
    counts = np.zeros(256, np.int64)
    for at in range(0, len(text), SLICE):
        counts += np.bincount(np.frombuffer(text, np.uint8, min(SLICE, len(text) - at), at), minlength=256)
    letters = max(1, counts[_LETTER].sum())
    n = len(words)
    repeats = sum(map(eq, words, words[1:]))
    runs = sum(map(and_, map(eq, words, words[1:]), map(eq, words, words[2:])))
    unclean = sum(map(contains, text.translate(_AS_HASH).split(), repeat(b"#"))) / n
    packer = zlib.compressobj(1)
    squeezed = sum(len(packer.compress(text[at : at + SLICE])) for at in range(0, len(text), SLICE)) + len(packer.flush())
    return np.array([
        min(1.0, counts[_MARK].sum() / n), unclean, counts[_UPPER].sum() / letters, repeats / n, runs / n,
        min(1.0, squeezed / (len(text) + 60)), counts[48:58].sum() / len(text), min(1.0, np.log10(len(text)) / 6),
    ])


def votes(m: np.ndarray, words: bool = True) -> np.ndarray:
    """What each labeller says of the measures; a text without words is bad to all."""
    if not words:
        return np.full(len(LABELLERS), BAD, np.int8)
    bad = (m[0] > 0.15, m[1] > 0.1, m[2] > 0.55, m[3] > 0.15, m[4] > 0.08, m[5] < 0.02)
    good = (m[0] < 0.12, m[1] < 0.08, m[2] < 0.4, m[3] < 0.12, m[4] < 0.06, m[5] >= 0.02)
    return np.where(bad, BAD, np.where(good, GOOD, NONE)).astype(np.int8)


def hashed(text: bytes, bits: int) -> np.ndarray:
    """Counts of hashed byte 4-grams, whole text."""
    size = 1 << bits
    out = np.zeros(size, np.int64)
    for at in range(0, max(0, len(text) - 3), SLICE):
        b = np.frombuffer(text, np.uint8, min(SLICE + 3, len(text) - at), at).astype(np.uint32)
        gram = b[:-3] | b[1:-2] << 8 | b[2:-1] << 16 | b[3:] << 24
        out += np.bincount((gram * np.uint32(2654435761)) >> np.uint32(32 - bits), minlength=size)
    return out


# --- The label model --------------------------------------------------------------------------


@dataclass
class LabelModel:
    """``right[j, y, v]``: probability that labeller j votes v where the truth is y. ``good``: share of good."""

    good: float = 0.8
    right: np.ndarray = field(default_factory=lambda: np.zeros((len(LABELLERS), 2, 3)))

    def log_odds(self, patterns: np.ndarray) -> np.ndarray:
        out = np.full(len(patterns), np.log(self.good / (1 - self.good)))
        for j in range(patterns.shape[1]):
            out += np.log(self.right[j, 1, patterns[:, j]] / self.right[j, 0, patterns[:, j]])
        return out

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(patterns), -30, 30)))


def expectation_maximisation(
    patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, false_alarms: float = FALSE_ALARMS, hits: float = HITS
) -> LabelModel:
    """Starts from "any bad vote: probably bad" and smooths every share by one imagined document each.

    Labellers are taken to be better than chance: of good documents a labeller calls ``false_alarms`` bad at most, of
    bad documents it knows ``hits`` at least. Bad documents are of several kinds, and a labeller knows some.
    """
    model = LabelModel()
    if not len(patterns):
        model.right[:] = 1 / 3
        return model
    p = np.where((patterns == BAD).any(axis=1), 0.1, 0.9)
    before = None
    for _ in range(rounds):
        weight = np.stack(((1 - p) * counts, p * counts))
        model.good = float((weight[1].sum() + 1) / (weight.sum() + 2))
        for j in range(patterns.shape[1]):
            for v in range(3):
                model.right[j, :, v] = (weight[:, patterns[:, j] == v].sum(axis=1) + 1) / (weight.sum(axis=1) + 3)
        model.right[:, 1, BAD] = np.minimum(model.right[:, 1, BAD], false_alarms)
        model.right[:, 0, BAD] = np.maximum(model.right[:, 0, BAD], hits)
        model.right /= model.right.sum(axis=2, keepdims=True)
        p = model.posterior(patterns)
        if before is not None and np.abs(p - before).max() < 1e-9:
            break
        before = p
    return model


# --- The linear scorer ------------------------------------------------------------------------


@dataclass
class Scorer:
    weights: np.ndarray
    measure_weights: np.ndarray
    bias: float
    bits: int

    def logit(self, text: bytes, m: np.ndarray) -> float:
        grams = hashed(text, self.bits)
        norm = np.sqrt(float((grams.astype(float) ** 2).sum())) or 1.0
        return float(grams @ self.weights / norm + m @ self.measure_weights + self.bias)


def fit(grams: np.ndarray, measured: np.ndarray, soft: np.ndarray, bits: int, rounds: int = 300) -> Scorer:
    """Logistic regression on soft labels by full-batch gradient descent with momentum and weight decay."""
    x = np.concatenate((grams, measured.astype(np.float32)), axis=1)
    w, b, v = np.zeros(x.shape[1], np.float32), 0.0, np.zeros(x.shape[1], np.float32)
    vb = 0.0
    for _ in range(rounds if len(x) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))
        g = (p - soft).astype(np.float32)
        v = 0.9 * v - 0.5 * (x.T @ g / len(x) + 1e-4 * w)
        vb = 0.9 * vb - 0.5 * float(g.mean())
        w, b = w + v, b + vb
    size = 1 << bits
    return Scorer(w[:size].astype(float), w[size:].astype(float), float(b), bits)


@dataclass
class QualityClassifier:
    """``sample``: so many rows at most fit the scorer, drawn by a hash; a documented bound of the fit alone.
    ``bits``: size of the hashed features. ``threshold``: documents below it are rejected."""

    sample: int = 2000
    bits: int = 12
    threshold: float = 0.5

    def measured(self, docs: DataFrame) -> DataFrame:
        """(id, pattern): the votes on each document as one string of digits."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                patterns = []
                for t in batch.column("text"):
                    m = measures(text := t.as_py())
                    patterns.append("".join(map(str, votes(m, bool(text.strip())))))
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(patterns, pa.string())], ["id", "pattern"])

        return self._narrow(docs).mapInArrow(run, "id long, pattern string")

    @staticmethod
    def _narrow(docs: DataFrame) -> DataFrame:
        return docs.select(internal_id().alias("id"), text_of().cast("binary").alias("text"))

    def fit(self, docs: DataFrame) -> tuple[LabelModel, Scorer]:
        found = written(self.measured(docs).groupBy("pattern").agg(F.count("*").alias("n")), "patterns").collect()
        found = sorted(found, key=lambda r: r["pattern"])
        patterns = np.array([[int(c) for c in r["pattern"]] for r in found], np.int8).reshape(len(found), len(LABELLERS))
        counts = np.array([r["n"] for r in found], float)
        label_model = expectation_maximisation(patterns, counts)
        total, bits = int(counts.sum()), self.bits
        kept = min(1.0, 2.0 * self.sample / max(1, total))
        draw = F.pmod(F.xxhash64("id", "text", F.lit("quality")), F.lit(1 << 30)) < int(kept * (1 << 30))

        def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows, grams, soft = [], [], []
                for t in batch.column("text"):
                    text = t.as_py()
                    m = measures(text)
                    g = hashed(text, bits).astype(np.float32)
                    g /= np.sqrt(float(g @ g)) or 1.0
                    rows.append(m.tolist())
                    grams.append(g.astype(np.float16).tobytes())
                    soft.append(float(label_model.posterior(votes(m, bool(text.strip()))[None, :])[0]))
                columns = [pa.array(rows, pa.list_(pa.float64())), pa.array(grams, pa.binary()), pa.array(soft, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, ["measures", "grams", "soft"])

        rows = self._narrow(docs).where(draw).orderBy(F.xxhash64("id", "text"), "id").limit(self.sample)
        got = rows.mapInArrow(features, "measures array<double>, grams binary, soft double").collect()
        x = np.stack([np.frombuffer(r["grams"], np.float16) for r in got]).astype(np.float32) if got else np.zeros((0, 1 << bits), np.float32)
        m = np.array([r["measures"] for r in got], float).reshape(len(got), len(MEASURES))
        return label_model, fit(x, m, np.array([r["soft"] for r in got], float), bits)

    def score(self, docs: DataFrame) -> DataFrame:
        """(doc_id, weak_label, score, keep), one row per row of ``docs`` (doc_id, text).

        ``weak_label``: the posterior of the labellers' votes. ``score``: the scorer's probability of good.
        ``keep``: whether the mean of both is at least ``threshold``. NULL, empty and blank texts are rejected.
        """
        label_model, scorer = self.fit(docs)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                weak, scores = [], []
                for t in batch.column("text"):
                    text = t.as_py()
                    m = measures(text)
                    words = bool(text.strip())
                    weak.append(float(label_model.posterior(votes(m, words)[None, :])[0]) if words else 0.0)
                    logit = scorer.logit(text, m) if words else -30.0
                    scores.append(float(1 / (1 + np.exp(-np.clip(logit, -30, 30)))))
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(weak), pa.array(scores)], ["id", "weak_label", "score"])

        scored = self._narrow(docs).mapInArrow(run, "id long, weak_label double, score double")
        keep = (F.col("weak_label") + F.col("score")) / 2 >= self.threshold
        return scored.select(external_id("id").alias("doc_id"), "weak_label", "score", keep.alias("keep"))


def good_documents(docs: DataFrame, classifier: QualityClassifier | None = None) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with all their columns. Where rows repeat an id, each
    is kept or rejected by its own text."""
    classifier = classifier or QualityClassifier()
    label_model, scorer = classifier.fit(docs)
    threshold = classifier.threshold

    def keeps(raw: bytes) -> bool:
        if not raw.strip():
            return False
        m = measures(raw)
        weak = float(label_model.posterior(votes(m)[None, :])[0])
        return (weak + 1 / (1 + np.exp(-np.clip(scorer.logit(raw, m), -30, 30)))) / 2 >= threshold

    @F.pandas_udf("boolean")
    def keep(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(keeps)

    return docs.where(keep(text_of().cast("binary")))
