"""Packing with a controlled mixture: deficit round robin over the queues of sources.

Each source is a queue of its documents' tokens. Windows of ``window`` tokens are filled from all queues
in target proportions: in each window a queue earns its quantum, gets whole tokens for it, and carries
the fraction (its deficit) to the next. Over ``PERIOD`` windows the deficits return to zero, so the
state at any window, and with it the place of any token, follows from the window's number: tasks
need no state from each other. When a queue runs dry its share goes to the others; the driver only
works out where that happens, from one total per queue. Windows lie end to end and are cut into
sequences, so all sequences but the last are full.

Token ids are made once and written (two bytes each where the vocabulary allows), each row with its place
within its task's share of the queue; the shares are then summed by a window function over (queue,
task) totals, so neither texts nor ids are shuffled, and a source with most of the rows is no hot key.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callinsight.llm import bpe
from callinsight.llm.common import external_id, internal_id, per_worker, shared_folder, text_of, written

PERIOD = 256
END = 0  # the id that closes a document


# --- The schedule -----------------------------------------------------------------------------


def quanta(weights: np.ndarray, total: int) -> np.ndarray:
    """Integers in proportion to ``weights``, each 1 at least, that add up to ``total``."""
    exact = weights / weights.sum() * total
    out = np.maximum(1, np.floor(exact)).astype(np.int64)
    spare = total - int(out.sum())
    if spare > 0:
        order = np.argsort(-(exact - np.floor(exact)), kind="stable")
        np.add.at(out, order[np.arange(spare) % len(out)], 1)
    while spare < 0:
        k = int(np.argmax(out))
        cut = min(-spare, int(out[k]) - 1)
        out[k] -= cut
        spare += cut
    return out


def one_period(quantum: np.ndarray, window: int) -> np.ndarray:
    """(PERIOD, queues) tokens for each window; column sums are ``quantum``, row sums ``window``."""
    given, deficit = np.zeros_like(quantum), np.zeros_like(quantum)  # deficits in 1/PERIOD tokens
    rows = []
    for k in range(PERIOD):
        deficit += quantum
        left = quantum - given
        if k == PERIOD - 1:
            give = left
        else:
            give = np.clip(deficit // PERIOD, 0, left)
            order = np.argsort(-(deficit - give * PERIOD), kind="stable")
            spare = window - int(give.sum())
            while spare:
                step = 1 if spare > 0 else -1
                for s in order if spare > 0 else order[::-1]:
                    if spare and 0 <= give[s] + step <= left[s]:
                        give[s] += step
                        spare -= step
        deficit -= give * PERIOD
        given = given + give
        rows.append(give)
    return np.array(rows)


@dataclass
class Stretch:
    """Windows of one kind: ``repeats`` times the rows of ``give`` (windows, queues)."""

    first_window: int
    repeats: int
    start: np.ndarray  # of each queue, in its own tokens
    give: np.ndarray

    def __post_init__(self) -> None:
        zero = np.zeros((1, self.give.shape[1]), np.int64)
        self.taken = np.concatenate((zero, np.cumsum(self.give, axis=0)))  # of a queue before window k
        self.offset = np.cumsum(self.give, axis=1) - self.give  # of a queue within window k


def schedule(totals: list[int], window: int, weights: list[float] | None = None) -> list[Stretch]:
    """How all tokens of the queues (``totals`` each) fill windows; ``weights``: target proportions."""
    left = np.array(totals, np.int64)
    aim = np.array(weights if weights is not None else totals, float)
    place, at, out = np.zeros_like(left), 0, []

    def add(repeats: int, give: np.ndarray) -> None:
        nonlocal place, left, at
        out.append(Stretch(at, repeats, place, give))
        place, left, at = place + repeats * give.sum(axis=0), left - repeats * give.sum(axis=0), at + repeats * len(give)

    while left.sum():
        live = np.flatnonzero(left > 0)
        if left.sum() <= window:
            add(1, left[None, :].copy())
            break
        share = np.maximum(aim[live], 1e-12)
        quantum = quanta(share, PERIOD * window)
        period = np.zeros((PERIOD, len(left)), np.int64)
        period[:, live] = one_period(quantum, window)
        whole = int((left[live] // quantum).min())
        if whole:
            add(whole, period)
        fits = int((np.cumsum(period, axis=0) <= left).all(axis=1).sum())
        if fits:
            add(1, period[:fits])
        if left.sum() > window:  # a window in which some queue runs dry
            give = np.minimum(period[fits % PERIOD], left)
            while (spare := window - int(give.sum())) > 0:
                rest = left - give
                more = np.minimum(rest, np.maximum(1, rest * spare // max(1, int(rest.sum()))))
                over = np.cumsum(more)
                give = give + np.clip(np.minimum(more, spare - (over - more)), 0, None)
            add(1, give[None, :])
    return out


def places(stretches: list[Stretch], starts: list[list[int]], queue: int, begin: int, end: int, window: int) -> Iterator[tuple[int, int, int]]:
    """(token of the queue, length, global place) of the runs of tokens begin..end of ``queue``."""
    k = bisect_right(starts[queue], begin) - 1
    while begin < end:
        s = stretches[k]
        per = int(s.taken[-1, queue])
        done = begin - int(s.start[queue])
        if not per or done >= per * s.repeats:
            k += 1
            continue
        again, inner = divmod(done, per)
        row = int(np.searchsorted(s.taken[:, queue], inner, side="right")) - 1
        into = inner - int(s.taken[row, queue])
        length = min(end - begin, int(s.give[row, queue]) - into)
        number = s.first_window + again * len(s.give) + row
        yield begin, length, number * window + int(s.offset[row, queue]) + into
        begin += length


# --- Tokens -----------------------------------------------------------------------------------


class Tokenizer:
    """The ids of the vocabulary file; special tokens that a text spells out keep their own ids."""

    def __init__(self, path: str):
        self.vocabulary = bpe.Vocabulary(path)
        ranks = self.vocabulary.id_of
        self.special = self.vocabulary.added
        self.model = tiktoken.Encoding("packing", pat_str=bpe.WORDS, mergeable_ranks=ranks, special_tokens=self.special)

    def ids(self, text: str) -> np.ndarray:
        allowed = {s for s in self.special if s in text}
        return self.model.encode_to_numpy(text, allowed_special=allowed, disallowed_special=())


def tokens(docs: DataFrame, path: str, queue: str = "source") -> DataFrame:
    """(id, queue, task, before, n, ids): the document's ids and its place in its task's part of the queue."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = per_worker(f"packing:{path}", lambda: Tokenizer(path))
        wide = max(model.vocabulary.token) > 0xFFFF
        task, so_far = TaskContext.get().partitionId(), {}
        for batch in batches:
            for part, texts in bpe.chunks(batch):
                names, before, sizes, ids = part.column("queue").to_pylist(), [], [], []
                for name, text in zip(names, texts, strict=True):
                    found = np.append(model.ids(text), END).astype("<u4" if wide else "<u2")
                    before.append(so_far.get(name, 0))
                    sizes.append(len(found))
                    so_far[name] = before[-1] + len(found)
                    ids.append(found.tobytes())
                columns = [part.column("id"), part.column("queue"), pa.array([task] * len(ids), pa.int32())]
                columns += [pa.array(before, pa.int64()), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "queue", "task", "before", "n", "ids"])

    name = F.coalesce(F.col(queue).cast("string"), F.lit("")) if queue in docs.columns else F.lit("")
    narrow = docs.select(internal_id().alias("id"), name.alias("queue"), text_of().alias("text"))
    return narrow.mapInArrow(run, "id long, queue string, task int, before long, n long, ids binary")


@dataclass
class Packing:
    """``length``: tokens of a sequence. ``window_sequences``: sequences of a mixing window. ``weights``: target
    proportions by source; without it the proportions of the tokens, so that all queues end together. Sources
    that ``weights`` leaves out follow when the others are done.

    ``queues``: so many sources, those of ``weights`` and then the largest, have a queue of their own, as long as the
    schedule's tables stay small. All others lie in one queue, in which each source's tokens are spread evenly from end
    to end: any stretch of it holds them in proportion, and so does every window that takes from it."""

    path: str = bpe.DEFAULT_PATH
    length: int = 1024
    window_sequences: int = 64
    queues: int = 255
    weights: dict[str, float] | None = None
    queue: str = "source"

    def pack(self, docs: DataFrame) -> DataFrame:
        """(doc_id, start, length, doc_tokens, sequence_id, offset, queue, ids), a row per piece.

        Each id of each row of ``docs`` (doc_id, text, source), and the end id of each row, lies in one
        piece. ``ids``: little-endian 32-bit ids. A NULL source counts as an empty name.
        """
        window, length, path = self.length * self.window_sequences, self.length, self.path
        made = docs.sparkSession.read.schema(_TOKENS).parquet(_written_tokens(tokens(docs, path, self.queue)))
        shares = made.groupBy("queue", "task").agg(F.sum("n").alias("tokens"))
        shares = written(shares, "shares")
        sums = shares.groupBy("queue").agg(F.sum("tokens").alias("tokens"))
        # A bounded report: the queues with a weight, then the largest, and one row for all others.
        asked = F.col("queue").isin(list(self.weights)) if self.weights else F.lit(False)
        largest = sums.orderBy(F.desc(asked), F.desc("tokens"), "queue").limit(max(self.queues, len(self.weights or ()))).collect()
        rest = sums.agg(F.sum("tokens")).first()[0] or 0
        names = [r["queue"] for r in largest]
        totals = [int(r["tokens"]) for r in largest]
        if rest > sum(totals):
            names, totals = [*names, None], [*totals, int(rest) - sum(totals)]
        if not totals:
            return docs.sparkSession.createDataFrame([], _PIECES)
        weights = [self.weights.get(n, 0.0) for n in names] if self.weights else None
        plan = schedule(totals, window, weights)
        starts = [[int(s.start[q]) for s in plan] for q in range(len(totals))]

        own = [n for n in names if n is not None]
        number = F.coalesce(*[F.when(F.col("queue") == n, q) for q, n in enumerate(own)])
        numbered = shares.withColumn("number", number).where("number is not null")
        order = Window.partitionBy("number").orderBy("task", "queue").rowsBetween(Window.unboundedPreceding, -1)
        base = numbered.withColumn("base", F.coalesce(F.sum("tokens").over(order), F.lit(0)))
        base = written(base.select("queue", "task", "number", "base"), "bases")

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                step = max(1, int(4e6 // max(1, batch.nbytes // max(1, batch.num_rows))))
                for at in range(0, batch.num_rows, step):
                    yield pieces(batch.slice(at, step))

        def pieces(batch: pa.RecordBatch) -> pa.RecordBatch:
            out: dict[str, list] = {c: [] for c in _NAMES}
            columns = (batch.column(c).to_pylist() for c in ("id", "number", "first", "n", "ids", "queue"))
            for doc, queue, first, n, ids, name in zip(*columns, strict=True):
                ids = np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4").astype("<u4")
                for token, run, place in places(plan, starts, queue, first, first + n, window):
                    start = token - first
                    while run:
                        size = min(run, length - place % length)
                        row = (doc, start, size, n, place // length, place % length, name, ids[start : start + size].tobytes())
                        for column, value in zip(out.values(), row, strict=True):
                            column.append(value)
                        start, place, run = start + size, place + size, run - size
            types = [pa.int64()] * 6 + [pa.string(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], list(out))

        placed = made.join(base, ["queue", "task"]).withColumn("first", F.col("base") + F.col("before"))
        placed = placed.select("id", "number", "first", "n", "ids", "queue")
        if len(own) < len(names):
            rest = evenly(made.where(~F.col("queue").isin(own))).withColumn("number", F.lit(len(own)))
            placed = placed.unionByName(rest.select("id", "number", "first", "n", "ids", "queue"))
        done = placed.mapInArrow(cut, ", ".join(f"{c} {t}" for c, t in zip(_NAMES, ["long"] * 6 + ["string", "binary"], strict=True)))
        return done.select(external_id("id").alias("doc_id"), *_NAMES[1:])


#: Slices of a queue that many sources share.
SLICES = 1024


def evenly(made: DataFrame) -> DataFrame:
    """``made`` (:func:`tokens` of several sources) with ``first``, the place of each document in one queue of them all.

    The queue has ``SLICES`` slices, and each source's tokens are dealt to them from first to last by their share of the
    source; a document goes to the slice of its first token. Only totals per (slice, source, task) are summed up, slice by
    slice, so no task holds a whole source or the whole queue.
    """
    shares = written(made.groupBy("queue", "task").agg(F.sum("n").alias("tokens")), "shares")
    totals = shares.groupBy("queue").agg(F.sum("tokens").alias("total"))
    earlier = Window.partitionBy("queue").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    own = shares.withColumn("own", F.coalesce(F.sum("tokens").over(earlier), F.lit(0))).join(totals, "queue")
    own = written(own.select("queue", "task", "own", "total"), "own")
    slice_of = F.floor((F.col("own") + F.col("before")) * SLICES / F.col("total")).cast("int")
    dealt = made.join(own, ["queue", "task"]).withColumn("slice", slice_of)
    parts = written(dealt.groupBy("slice", "queue", "task").agg(F.sum("n").alias("tokens"), F.min("before").alias("since")), "slices")
    sizes = dict(map(tuple, parts.groupBy("slice").agg(F.sum("tokens")).collect()))
    begins, so_far = [], 0
    for k in sorted(sizes):
        begins.append((k, so_far))
        so_far += sizes[k]
    begin = made.sparkSession.createDataFrame(begins, "slice int, begin long")
    inside = Window.partitionBy("slice").orderBy("task", "queue").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.withColumn("at", F.coalesce(F.sum("tokens").over(inside), F.lit(0))).join(begin, "slice")
    bases = written(bases.select("slice", "queue", "task", (F.col("begin") + F.col("at") - F.col("since")).alias("base")), "bases")
    return dealt.join(bases, ["slice", "queue", "task"]).withColumn("first", F.col("base") + F.col("before"))


_NAMES = ["id", "start", "length", "doc_tokens", "sequence_id", "offset", "queue", "ids"]
_TOKENS = "id long, queue string, task int, before long, n long, ids binary"
_PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, queue string, ids binary"


def _written_tokens(df: DataFrame) -> str:
    path = shared_folder(df.sparkSession, "tokens")
    df.write.option("compression", "zstd").parquet(path)
    return path


def with_crc(pieces: DataFrame) -> DataFrame:
    """The pieces with the CRC-32 of their ids instead of the ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
