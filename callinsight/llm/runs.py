"""Runs of words that repeat with a period, found by a suffix array with LCP intervals.

A run is a longest stretch of consecutive words with smallest period q (words q apart are the same) of at
least ``max(least, times * q)`` words. The words of many documents are worked on at once, as numbers:

1. Suffixes are sorted by prefix doubling, a document's among themselves only: its words are told apart
   from those of other documents. After each round only suffixes that still tie are sorted again.
2. Every stretch of ``PROBE`` words inside a run occurs twice in the document (shifted by q to one side or the
   other), so documents without ``least`` words on end that lie in repeated stretches have no run; the ranks of
   the third round show it and only the other documents go on. ``PROBE`` is a third of ``least``.
3. LCP values follow from the ranks of all rounds. An LCP interval of depth d is given by the next smaller values
   on both sides; its children by the places that hold d. For the suffixes of all children but the largest,
   the inverse suffix array tells whether the suffix d words on, or d back, lies in the interval too: then a
   square of period d starts at the earlier one. Every run shows up so, at its last square. Each suffix is in
   a smaller child at most log n times. No tree is made.
4. Squares are rotated to the left as long as the words q apart agree, which gives the run; of periods
   with the same stretch the smallest is the run's.

Rows: a NULL text has no words, a NULL ``doc_id`` comes back as NULL and no words of it are changed by
``planted``; repeated rows each give their row; empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callinsight.llm.common import NO_ID, external_id, internal_id, text_of
from callinsight.llm.words import slices, word_numbers

#: Bytes of text worked on at once, or one document.
CHUNK = 2_000_000


# --- Suffix array -----------------------------------------------------------------------------


def _dense(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, group, tied): positions by key, the place where each ordered key's group starts, whether it has others."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    first = np.ones(len(keys), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    starts = np.flatnonzero(first)
    sizes = np.diff(np.append(starts, len(keys)))
    return order, np.repeat(starts, sizes), np.repeat(sizes > 1, sizes)


def first_ranks(words: np.ndarray, document: np.ndarray) -> np.ndarray:
    """Rank of each position by (document, word): the place in the order where its group starts."""
    order, group, _ = _dense(document * (int(words.max(initial=0)) + 1) + words)
    rank = np.empty(len(words), np.int64)
    rank[order] = group
    return rank


def doubled(rank: np.ndarray, step: int, tied: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks by twice as many words, from ranks by ``step`` words, and the positions that still tie.

    Only the positions ``tied`` are sorted. Ranks stay the place where a group starts, so they never grow
    out of their group's range, and the end of the text counts as less than any word."""
    n = len(rank)
    after = tied + step
    second = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
    order, group, still = _dense(rank[tied] * (n + 1) + second)
    ordered = tied[order]
    # Offset of the new group within the old one, counted over the sorted positions.
    old = rank[ordered]
    begins = np.ones(len(old), bool)
    begins[1:] = old[1:] != old[:-1]
    start_of_old = np.repeat(np.flatnonzero(begins), np.diff(np.append(np.flatnonzero(begins), len(old))))
    new = rank.copy()
    new[ordered] = old + (group - start_of_old)
    return new, np.sort(ordered[still])


def ties(rank: np.ndarray) -> np.ndarray:
    """Positions that share their rank, ascending."""
    return np.flatnonzero(np.bincount(rank, minlength=len(rank))[rank] > 1)


class SuffixArray:
    """``sa`` and ``isa`` of the words, and ``lcp[k]``, the words that suffixes ``sa[k-1]`` and ``sa[k]`` share."""

    def __init__(self, words: np.ndarray, document: np.ndarray):
        levels, step = [first_ranks(words, document)], 1
        tied = ties(levels[0])
        while len(tied):
            rank, tied = doubled(levels[-1], step, tied)
            levels.append(rank)
            step *= 2
        n = len(words)
        self.isa = levels[-1]
        self.sa = np.empty(n, np.int64)
        self.sa[self.isa] = np.arange(n)
        self.lcp = np.zeros(n + 1, np.int64)  # lcp[0] = lcp[n] = 0
        which = np.flatnonzero(levels[0][self.sa[1:]] == levels[0][self.sa[:-1]]) + 1
        left, right = self.sa[which - 1].copy(), self.sa[which].copy()
        length = np.zeros(len(which), np.int64)
        for level in range(len(levels) - 1, -1, -1):
            rank, step = levels[level], 1 << level
            inside = right < n
            inside &= left < n
            same = np.flatnonzero(inside)[rank[left[inside]] == rank[right[inside]]]
            length[same] += step
            left[same] += step
            right[same] += step
        self.lcp[which] = length


def nearest_smaller(values: np.ndarray, at: np.ndarray, step: int) -> np.ndarray:
    """For each index in ``at`` (where the value is above 0) the nearest index to the left (step -1) or right (1)
    with a smaller value. Each round follows the pointers of those that still point to no smaller value."""
    pointer = np.arange(len(values)) + step
    active = at
    while len(active):
        to = pointer[active]
        active = active[values[to] >= values[active]]
        pointer[active] = pointer[pointer[active]]
    return pointer[at]


def squares(array: SuffixArray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of the squares that no rotation to the right follows, from the LCP intervals."""
    sa, isa, lcp, n = array.sa, array.isa, array.lcp, len(words)
    at = np.flatnonzero(lcp > 0)
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low, high = nearest_smaller(lcp, at, -1), nearest_smaller(lcp, at, 1)  # the interval is sa[low:high]
    order = np.lexsort((at, high, low))
    at, low, high = at[order], low[order], high[order]
    first = np.ones(len(at), bool)
    first[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    begins = np.flatnonzero(first)
    per = np.diff(np.append(begins, len(at)))
    # Children: from the interval's start to the first place, between places, from the last place to its end.
    interval = np.repeat(np.arange(len(begins)), per + 1)
    opens, closes = np.empty(len(interval), np.int64), np.empty(len(interval), np.int64)
    lead = begins + np.arange(len(begins))
    tail = lead + per
    inner = np.ones(len(interval), bool)
    inner[lead] = False
    opens[lead], opens[inner] = low[begins], at
    inner[:] = True
    inner[tail] = False
    closes[tail], closes[inner] = high[begins], at
    size = closes - opens
    by_size = np.lexsort((size, interval))  # the largest of an interval comes last
    small = by_size[interval[by_size] == np.append(interval[by_size][1:], -1)]
    opens, size, interval = opens[small], size[small], interval[small]
    places = np.repeat(opens - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    owner = np.repeat(interval, size)
    i, depth, bottom, top = sa[places], lcp[at[begins]][owner], low[begins][owner], high[begins][owner]
    word = np.append(words, -1)  # beyond the end
    found = []
    for start in (i, i - depth):
        after = start + depth
        other = after if start is i else start
        inside = (start >= 0) & (after < n)
        rank = isa[np.where(inside, other, 0)]
        inside &= (rank >= bottom) & (rank < top)
        inside &= word[np.minimum(after, n)] != word[np.minimum(after + depth, n)]
        found.append(start[inside] * (n + 1) + depth[inside])
    return np.divmod(np.unique(np.concatenate(found)), n + 1)


def _rotated(words: np.ndarray, start: np.ndarray, period: np.ndarray, need: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(kept, first): squares that can be rotated left ``need`` times, and where the rotations end.

    The first steps are taken by all squares together, the rest in blocks of doubling length for each that is left.
    Squares of a multiple of a run's period that end with the run belong to it and are passed over, so the words
    of a run are compared once, however often its period fits."""
    kept = np.arange(len(start))
    for step in range(1, 9):
        here = start[kept] - step
        fits = (here >= 0) & (words[np.maximum(here, 0)] == words[np.maximum(here, 0) + period[kept]])
        kept = kept[fits | (need[kept] < step)]
    kept = kept[np.lexsort((period[kept], start[kept] + 2 * period[kept]))]
    out, first, known, known_end = [], [], [], -1
    for k, s, q, least in zip(kept.tolist(), start[kept].tolist(), period[kept].tolist(), need[kept].tolist(), strict=True):
        if s + 2 * q != known_end:
            known, known_end = [], s + 2 * q
        if any(q % p == 0 and s >= f for f, p in known):
            continue
        end, block = s, 64
        while end:
            begin = max(0, end - block)
            differ = np.flatnonzero(words[begin:end] != words[begin + q : end + q])
            if len(differ):
                end = begin + int(differ[-1]) + 1
                break
            end, block = begin, 2 * block
        known.append((end, q))
        if s - end >= least:
            out.append(k)
            first.append(end)
    return np.array(out, np.int64), np.array(first, np.int64)


def runs_of(words: np.ndarray, document: np.ndarray, least: int = 24, times: int = 3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start, then period. ``words``: numbers from 0, ``document``: ascending.

    Two documents' words never agree here, so no run crosses from one to the next."""
    if times < 3 or least < times:
        raise ValueError("a run repeats three times or more, and has a word or more each time")
    nothing = np.zeros(0, np.int64)
    if not len(words):
        return nothing, nothing, nothing
    told = document.astype(np.int64) * (int(words.max()) + 1) + words
    # A stretch of 2**k words shifted by a period stays within the run while it has at most least / 3 words.
    probe = 1 << ((least // 3).bit_length() - 1)
    rank, step = first_ranks(words.astype(np.int64), document.astype(np.int64)), 1
    tied = ties(rank)
    while step < probe and len(tied):
        rank, tied = doubled(rank, step, tied)
        step *= 2
    if not len(tied):
        return nothing, nothing, nothing
    cover = np.zeros(len(words) + 1, np.int64)
    cover[tied] = 1
    cover[tied[tied + probe < len(words)] + probe] -= 1
    repeated = np.cumsum(cover[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate(([False], repeated, [False])).astype(np.int8)))
    opens, closes = edges[::2], edges[1::2]
    long = closes - opens >= least
    # A covered stretch may run over a document's end; documents it touches are looked at.
    chosen = np.zeros(int(document[-1]) + 1, bool)
    for a, b in zip(opens[long], closes[long], strict=True):
        chosen[document[a] : document[b - 1] + 1] = True
    place = np.flatnonzero(chosen[document])
    if not len(place):
        return nothing, nothing, nothing
    part = np.unique(told[place], return_inverse=True)[1]
    start, period = squares(SuffixArray(part, document[place].astype(np.int64)), part)
    need = np.maximum(least, times * period) - 2 * period
    kept, first = _rotated(part, start, period, need)
    end, period = start[kept] + 2 * period[kept], period[kept]
    order = np.lexsort((period, end, first))
    first, end, period = first[order], end[order], period[order]
    smallest = np.ones(len(first), bool)
    smallest[1:] = (first[1:] != first[:-1]) | (end[1:] != end[:-1])
    first, end, period = first[smallest], end[smallest], period[smallest]
    order = np.lexsort((period, first))
    return place[first[order]], (end - first)[order], period[order]


# --- Tables -----------------------------------------------------------------------------------


def planted(numbers: np.ndarray, doc_id: int) -> np.ndarray:
    """The words of one document in ten with a repeated tail: from word ``a`` on, word ``a + (i - a) % p``."""
    n, h = len(numbers), zlib.crc32(str(doc_id).encode())
    if h % 10 or not n or doc_id == NO_ID:
        return numbers
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    out = numbers.copy()
    out[a:] = numbers[a + np.arange(n - a) % p]
    return out


@dataclass
class RepeatedRuns:
    """``least``, ``times``: a run has ``max(least, times * period)`` words or more. ``plant``: see :func:`planted`."""

    least: int = 24
    times: int = 3
    plant: bool = False

    def find(self, docs: DataFrame) -> DataFrame:
        """(doc_id, runs array<struct<start, length, period>>, collapsed) for each row of ``docs`` (doc_id, text).

        ``collapsed``: the words, joined by a space, without those that any run contains after its first period."""
        least, times, plant = self.least, self.times, self.plant

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, CHUNK):
                    numbers, counts, words = word_numbers(part.column("text"))
                    numbers = numbers.astype(np.int64)
                    ends = np.cumsum(counts)
                    begins = ends - counts
                    ids = part.column("id").to_pylist()
                    if plant:
                        for doc, a, b in zip(ids, begins, ends, strict=True):
                            numbers[a:b] = planted(numbers[a:b], doc)
                    document = np.repeat(np.arange(len(ids)), counts)
                    start, length, period = runs_of(numbers, document, least, times)
                    kept = np.ones(len(numbers), bool)
                    for s, n, q in zip(start, length, period, strict=True):
                        kept[s + q : s + n] = False
                    owner = document[start] if len(start) else start
                    of_document = np.searchsorted(owner, np.arange(len(ids) + 1))
                    struct = pa.StructArray.from_arrays(
                        [pa.array(start - begins[owner] if len(start) else start, pa.int64()), pa.array(length, pa.int64()), pa.array(period, pa.int64())],
                        ["start", "length", "period"],
                    )
                    runs = pa.ListArray.from_arrays(pa.array(of_document, pa.int32()), struct)
                    left = np.concatenate(([0], np.cumsum(kept)))
                    flat = words.take(pa.array(numbers[kept]))
                    offsets = pa.array(np.append(left[begins], left[-1] if len(left) else 0), pa.int32())
                    collapsed = pa.compute.binary_join(pa.ListArray.from_arrays(offsets, flat.cast(pa.string())), " ")
                    yield pa.RecordBatch.from_arrays([part.column("id"), runs, collapsed], ["id", "runs", "collapsed"])

        schema = "id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
        found = docs.select(internal_id().alias("id"), text_of().alias("text")).mapInArrow(run, schema)
        return found.select(external_id("id").alias("doc_id"), "runs", "collapsed")


def greatest(runs: list[dict]) -> dict | None:
    """The run with the greatest exact length / period; of equal ones the smallest start, then period."""
    best = None
    for r in runs:
        if best is None or (more := r["length"] * best["period"] - best["length"] * r["period"]) > 0:
            best = r
        elif more == 0 and (r["start"], r["period"]) < (best["start"], best["period"]):
            best = r
    return best


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def summary(found: DataFrame) -> DataFrame:
    """Per document: n_runs, the greatest run, and digests of all runs and of the collapsed words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("runs").to_pylist()
            best = [greatest(r) for r in rows]
            of = lambda key: pa.array([b and b[key] for b in best], pa.int64())
            columns = [
                batch.column("doc_id"),
                pa.array([len(r) for r in rows], pa.int64()),
                of("start"),
                of("length"),
                of("period"),
                pa.array([b and 1000 * b["length"] // b["period"] for b in best], pa.int64()),
                pa.array([digest("".join(f"{x['start']},{x['length']},{x['period']}\n" for x in r)) for r in rows]),
                batch.column("collapsed_sha256"),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    schema = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    return found.select("doc_id", "runs", F.sha2("collapsed", 256).alias("collapsed_sha256")).mapInArrow(run, schema)
