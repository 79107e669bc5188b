"""SimHash near-duplicates: 64-bit fingerprints linked by a binary trie joined with itself.

Fingerprints are folded to distinct values first, so copies cost one row. To spread the trie over the
cluster the 64 bits are cut into ``budget + 2`` blocks: two fingerprints that differ in at most
``budget`` bits agree on two blocks at least. For each pair of blocks the bits are permuted so that the
pair leads, and all fingerprints with the same lead form one subtree. A subtree is a sorted run of the
permuted values, its nodes are ranges of the run; the join walks pairs of nodes together bit by bit,
adds up the bits in which they differ, and drops a pair once that exceeds the budget. Pairs whose
fingerprints are all known to hang together are dropped too: they can only repeat what is known. That
keeps a dense group of m near copies near m log m instead of m * m and loses no connection.

Each subtree yields a spanning forest of its links; components over all forests come from alternating
large-star and small-star rounds, each a Spark job with its result in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callinsight.llm.common import columns, external_id, fresh, internal_id, least_row, text_of, written

BITS = 64
#: Node pairs expanded at once; more are split and walked one half after the other.
FRONTIER = 1 << 20


# --- Fingerprints -----------------------------------------------------------------------------


def shingle_hashes(text: bytes, words_per_shingle: int) -> np.ndarray:
    """The XXH64 (seed 42) of every shingle; a text of fewer words is one shingle, without words it has none."""
    words = text.lower().split()  # on bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(words_per_shingle, len(words))
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)
    xxh = xxhash.xxh64_intdigest
    return np.fromiter((xxh(line[a:b], 42) for a, b in spans), np.uint64, len(words) - k + 1)


def fingerprint(text: bytes, words_per_shingle: int = 4) -> int:
    """Majority bits of the hashes of all shingles; 0 for a text without words."""
    return majority(shingle_hashes(text, words_per_shingle))


def majority(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half of ``hashes``."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # long texts in slices
        part = hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits((counts * 2 > len(hashes)).astype(np.uint8))
    return int.from_bytes(bits.tobytes(), "big")


def text_digest() -> Column:
    """Tells rows of one id apart."""
    return F.unhex(F.md5(text_of()))


def fingerprints(docs: DataFrame, words_per_shingle: int = 4) -> DataFrame:
    """(id, digest, fp): fp holds the 64 bits as a signed long. Whole texts are read."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = (fingerprint(t.as_py(), words_per_shingle) for t in batch.column("text"))
            fp = np.fromiter(found, np.uint64, batch.num_rows).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("digest"), pa.array(fp)], ["id", "digest", "fp"])

    narrow = docs.select(internal_id().alias("id"), text_digest().alias("digest"), text_of().cast("binary").alias("text"))
    return narrow.mapInArrow(score, "id long, digest binary, fp long")


# --- The trie joined with itself --------------------------------------------------------------


def leads(budget: int) -> list[tuple[list[int], int]]:
    """For each pair of blocks: the order of the bits (highest first) and the width of the lead."""
    edges = [BITS * i // (budget + 2) for i in range(budget + 3)]
    blocks = [list(range(BITS - 1 - a, BITS - 1 - b, -1)) for a, b in zip(edges, edges[1:], strict=False)]
    out = []
    for i, j in combinations(range(len(blocks)), 2):
        first = blocks[i] + blocks[j]
        rest = [bit for k, block in enumerate(blocks) if k not in (i, j) for bit in block]
        out.append((first + rest, len(first)))
    return out


def permuted(fp: np.ndarray, order: list[int]) -> np.ndarray:
    out = np.zeros_like(fp)
    one = np.uint64(1)
    for place, bit in enumerate(order):
        out |= ((fp >> np.uint64(bit)) & one) << np.uint64(BITS - 1 - place)
    return out


def restored(values: np.ndarray, order: list[int]) -> np.ndarray:
    inverse = [0] * BITS
    for place, bit in enumerate(order):
        inverse[BITS - 1 - bit] = BITS - 1 - place
    return permuted(values, inverse)


class _Forest:
    """Components of the values of one run, and the links that made them."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.links: list[np.ndarray] = []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while len(a):
            x, y = label[a], label[b]
            a, b, x, y = (v[x != y] for v in (a, b, x, y))
            if not len(a):
                break
            low, high = np.minimum(x, y), np.maximum(x, y)
            # Each larger label gives way to one smaller label: chosen links never close a ring.
            order = np.lexsort((low, high))
            pick = order[np.concatenate(([True], np.diff(high[order]) != 0))]
            self.links.append(np.stack((a[pick], b[pick])))
            parent = np.arange(len(label))
            parent[high[pick]] = low[pick]
            while True:
                up = parent[parent]
                if np.array_equal(up, parent):
                    break
                parent = up
            label[:] = parent[label]

    def known(self, lo: np.ndarray, hi: np.ndarray, lo2: np.ndarray, hi2: np.ndarray) -> np.ndarray:
        """Whether all values in both ranges belong to one component already."""
        breaks = np.concatenate(([0], np.cumsum(self.label[1:] != self.label[:-1])))
        one = (breaks[lo] == breaks[hi - 1]) & (breaks[lo2] == breaks[hi2 - 1])
        return one & (self.label[lo] == self.label[lo2])


def join_trie(values: np.ndarray, lead: int, budget: int) -> np.ndarray:
    """Links (2, n) between indexes of ``values`` (sorted, distinct) that hold together every pair
    which agrees on the ``lead`` highest bits and differs in at most ``budget`` bits."""
    n = len(values)
    forest = _Forest(n)
    if n > 1:
        top = values >> np.uint64(BITS - lead)
        near = (top[1:] == top[:-1]) & (np.bitwise_count(values[1:] ^ values[:-1]) <= budget)
        at = np.flatnonzero(near)
        forest.add(at, at + 1)
        starts = np.flatnonzero(np.concatenate(([True], top[1:] != top[:-1])))
        ends = np.append(starts[1:], n)
        many = ends - starts > 1
        lo, hi = starts[many], ends[many]
        stack = [(lead, lo, hi, lo, hi, np.zeros(len(lo), np.int8))]
        while stack:
            depth, lo, hi, lo2, hi2, err = stack.pop()
            if len(lo) > FRONTIER:
                half = len(lo) // 2
                stack += [(depth, *(v[half:] for v in (lo, hi, lo2, hi2, err))), (depth, *(v[:half] for v in (lo, hi, lo2, hi2, err)))]
                continue
            keep = ~forest.known(lo, hi, lo2, hi2)
            lo, hi, lo2, hi2, err = (v[keep] for v in (lo, hi, lo2, hi2, err))
            single = (hi - lo == 1) & (hi2 - lo2 == 1)  # both paths are unary from here on
            a, b = lo[single], lo2[single]
            close = np.bitwise_count(values[a] ^ values[b]) <= budget
            forest.add(a[close], b[close])
            lo, hi, lo2, hi2, err = (v[~single] for v in (lo, hi, lo2, hi2, err))
            if len(lo) and depth < BITS:
                stack.append((depth + 1, *_children(values, depth, lo, hi, lo2, hi2, err, budget)))
    return np.concatenate(forest.links, axis=1) if forest.links else np.zeros((2, 0), np.int64)


def _split(values: np.ndarray, depth: int, lo: np.ndarray) -> np.ndarray:
    """Where the ones begin in each range of equal prefixes of ``depth`` bits."""
    bit = np.uint64(BITS - 1 - depth)
    prefix = (values[lo] >> bit) | np.uint64(1)
    return np.searchsorted(values, prefix << bit)


def _children(values, depth, lo, hi, lo2, hi2, err, budget):
    mid, mid2 = _split(values, depth, lo), _split(values, depth, lo2)
    mid, mid2 = np.clip(mid, lo, hi), np.clip(mid2, lo2, hi2)
    same = lo == lo2
    parts = [
        (lo, mid, lo2, mid2, err),
        (mid, hi, mid2, hi2, err),
        (lo, mid, mid2, hi2, err + 1),
        *[tuple(v[~same] for v in (mid, hi, lo2, mid2, err + 1))],
    ]
    lo, hi, lo2, hi2, err = (np.concatenate(v) for v in zip(*parts, strict=True))
    live = (hi > lo) & (hi2 > lo2) & (err <= budget) & ~((lo == lo2) & (hi - lo == 1))
    return tuple(v[live] for v in (lo, hi, lo2, hi2, err.astype(np.int8)))


def links(distinct: DataFrame, budget: int = 4) -> DataFrame:
    """(a, b): links between fingerprints of ``distinct`` (fp) whose components are those of all pairs
    within ``budget`` differing bits."""
    plan = leads(budget)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            for k, (order, lead) in enumerate(plan):
                values = permuted(fp, order)
                subtree = (values >> np.uint64(BITS - lead)).astype(np.int64) + (k << 40)
                yield pa.RecordBatch.from_arrays([pa.array(subtree), pa.array(values.view(np.int64))], ["subtree", "value"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:  # sorted by subtree: whole subtrees are walked as they come in
            if not batch.num_rows:
                continue
            trees = batch.column("subtree").to_numpy()
            cut = int(np.searchsorted(trees, trees[-1]))
            if cut == 0 and held and held[-1].column("subtree")[-1].as_py() == trees[0]:
                held.append(batch)
                continue
            yield from solve([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        yield from solve(held)

    def solve(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [p for p in parts if p.num_rows]
        if not parts:
            return
        trees = np.concatenate([p.column("subtree").to_numpy() for p in parts])
        values = np.concatenate([p.column("value").to_numpy() for p in parts]).view(np.uint64)
        for k in np.unique(trees >> 40):
            order, lead = plan[k]
            run = np.sort(values[trees >> 40 == k])
            found = join_trie(run, lead, budget)
            if found.size:
                a, b = (restored(run[side], order).view(np.int64) for side in found)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread_out = distinct.select("fp").mapInArrow(spread, "subtree long, value long")
    return spread_out.repartition(parts, "subtree").sortWithinPartitions("subtree").mapInArrow(walk, "a long, b long")


# --- Components -------------------------------------------------------------------------------


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is the smallest node reachable.

    Large-star and small-star rounds: every node hangs its larger, then its smaller neighbours on the
    least of them. A hub is folded inside the tasks and then met by a join that Spark can split.
    """

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs if not large else pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        met = both.join(least, "a")
        out = met.where("b > a") if large else met
        out = out.select(F.col("b").alias("x"), "least")
        if not large:  # the node itself hangs on the least too
            out = out.unionByName(least.select(F.col("a").alias("x"), "least"))
        return out.where("x != least").select(F.col("x").alias("a"), F.col("least").alias("b")).distinct()

    def downward(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()

    current, mark = written(downward(edges), "edges"), None
    for _ in range(max_rounds):
        now = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == mark or not now[0]:
            break
        mark = tuple(now)
        current = written(star(downward(star(current, large=True)), large=False), "stars")
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    return current.select(F.col("a").alias("node"), F.col("b").alias("component"))


def placed(nodes: DataFrame, hung: DataFrame) -> DataFrame:
    """``nodes`` (fp, ...) with the component of each, itself where no link ends."""
    found = nodes.join(hung.withColumnRenamed("node", "fp"), "fp", "left")
    return found.withColumn("component", F.coalesce("component", "fp"))


def near_duplicates(docs: DataFrame, budget: int = 4, words_per_shingle: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs`` (doc_id, text).

    Equal fingerprints link, and so do texts without words (fingerprint zero). Fingerprints are the nodes, so ids
    that are NULL or repeat link nothing. ``component_id`` is the smallest doc_id reachable; NULL only where no row
    of the component has an id.
    """
    found = written(fingerprints(docs, words_per_shingle), "fingerprints")
    nodes = written(found.groupBy("fp").agg(F.min("id").alias("first")), "nodes")
    settled = written(placed(nodes, components(links(nodes, budget))), "placed")
    labels = settled.groupBy("component").agg(F.min("first").alias("label"))
    settled = settled.select("fp", "component").join(labels, "component").select("fp", "label")
    return found.join(settled, "fp").select(
        external_id("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        external_id("label").alias("component_id"),
    )


def keep_one(docs: DataFrame, budget: int = 4, words_per_shingle: int = 4) -> DataFrame:
    """The rows of ``docs`` with one row of each component left, see ``one_of_each``."""
    found = written(fingerprints(docs, words_per_shingle), "fingerprints")
    return one_of_each(docs, found, components(links(found.select("fp").distinct(), budget)))


def one_of_each(docs: DataFrame, found: DataFrame, hung: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one row of each component left: the one with the smallest doc_id, of rows that
    repeat an id the first by the digest of the text, of rows that repeat both the one whose columns are least.

    ``found`` (id, digest, fp) has a row for each row of ``docs``, ``hung`` (node, component) the components of fp.
    Rows are told apart by id and digest, so ids that are NULL or repeat are settled row by row. Only
    rows with something to drop are joined.
    """
    key, mark = fresh("_id", docs), fresh("_digest", docs)
    touched = decisions(found, hung).select(F.col("id").alias(key), F.col("digest").alias(mark), "stays")
    touched = written(touched, "touched", keep=True)
    return without_dropped(docs, touched.drop("stays"), touched.where("stays").drop("stays"), key, mark)


def decisions(found: DataFrame, hung: DataFrame) -> DataFrame:
    """(id, digest, stays): the rows whose component has others."""
    row = F.struct("id", "digest")
    nodes = found.groupBy("fp").agg(F.min(row).alias("first"), F.count("*").alias("rows"))
    settled = written(placed(nodes, hung), "placed")
    groups = settled.groupBy("component").agg(F.min("first").alias("first"), F.sum("rows").alias("rows")).where("rows > 1")
    crowd = settled.select("fp", "component").join(groups, "component").select("fp", "first")
    decided = found.join(crowd, "fp").select("id", "digest", (row == F.col("first")).alias("stays"))
    per_row = decided.groupBy("id", "digest").agg(F.max("stays").alias("stays"), F.count("*").alias("rows"))
    return per_row.where("not stays or rows > 1").select("id", "digest", "stays")


def without_dropped(docs: DataFrame, touched: DataFrame, repeated: DataFrame, key: str, mark: str) -> DataFrame:
    """The rows of ``docs`` that ``touched`` does not name by id and digest, and of each in ``repeated`` the one whose
    columns are least."""
    tagged = docs.withColumns({key: internal_id(), mark: text_digest()})
    untouched = tagged.join(touched, [key, mark], "left_anti").select(columns(docs))
    if not repeated.head(1):
        return untouched
    return untouched.unionByName(least_row(tagged.join(repeated, [key, mark]), [key, mark], docs))
