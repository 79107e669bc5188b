"""A hierarchical Pitman-Yor bigram model, its seating sampled by Gibbs, and the scores of all documents.

The word before a token is its context; every context has a restaurant, and all restaurants share one parent,
the unigram restaurant over a uniform base. A dish (word) with c customers in a restaurant sits at t tables;
each table is a customer of the parent. A sweep redraws the tables of each dish in each restaurant
given all others: from its exact conditional for up to ``EXACT`` customers, by seating the customers
one after another (skipping to the next who opens a table) beyond. Predictive probabilities are
averaged over the seatings of several sweeps, and their logarithms add up to a document's score.

How it is spread: tokens are packed into arrays and dealt by the hash of the *word*, so all contexts of a
word meet and the parent's customers for it are counted on the spot. What a bucket lacks are its
contexts' totals: it asks the contexts' owners (a shuffle of aggregated rows), which add up and answer.
Words with a large share of all tokens (a bounded list) are dealt to several buckets by their contexts, and
their totals are asked for in the same way.
Three shuffles in all; nothing of the model passes through the driver. As in other distributed
samplers, totals of other buckets stand still during the sweeps after the exchange.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callinsight.llm.common import external_id, internal_id, text_of, written

EXACT = 32
CHUNK_BYTES, CHUNK_DOCS = 4_000_000, 30_000
#: Keys of sums over all buckets, asked for like contexts: (tokens, words), (parent's customers, its tables),
#: and how many dishes have one or two customers in restaurants and in the parent.
SUMS = np.array([1, 2, 3, 4], np.uint64)
SPLIT = np.uint64(0x5851F42D4C957F2D)  # tells a split word's key from that of the same word as a context
END = b""  # closes a document, and is the context of its first word

PACKED = (
    "bucket int, chunk long, ids binary, held binary, words binary, runs binary, contexts binary, context binary, doc binary, n binary"
)
ASKED = "owner int, bucket int, keys binary, customers binary, tables binary"
TOLD = "bucket int, owner int, customers binary, tables binary"
PARTS = "chunk long, bucket int, ids binary, held binary, tokens binary, known binary, base binary, score binary, train long, types long"


def held_out(doc_id: int, modulus: int, remainder: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % modulus == remainder


class _Index(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _batch(rows: dict[str, list], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    columns = [c.split(" ") for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(rows[c], kinds[t]) for c, t in columns], [c for c, _ in columns])


def _narrow(values: np.ndarray) -> bytes:
    """Non-negative numbers in as few bytes each as the largest needs."""
    most = int(values.max()) if len(values) else 0
    return values.astype("<u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<u4" if most < 1 << 32 else "<u8").tobytes()


def _wide(raw: bytes, count: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{len(raw) // count}" if count else "<u1").astype(np.int64)


def _rows(schema: str) -> dict[str, list]:
    return {c.split(" ")[0]: [] for c in schema.split(", ")}


# --- Packing tokens ---------------------------------------------------------------------------


def pack(docs: list[tuple[int, bytes, bool]], chunk: int, buckets: int, split: dict[int, int]) -> pa.RecordBatch:
    """One row per bucket with the (word, context, document) counts of ``docs`` (id, text, held).

    A word of ``split`` (hash: parts) is dealt to as many buckets, by the hash of its context.
    """
    index = _Index()
    get, end = index.__getitem__, index[END]
    words, sizes = [], []
    for _, text, _ in docs:
        found = list(map(get, text.lower().split()))
        found.append(end)
        words.append(np.array(found, np.int64))
        sizes.append(len(found))
    word = np.concatenate(words)
    doc = np.repeat(np.arange(len(docs)), sizes)
    context = np.empty_like(word)
    context[1:] = word[:-1]
    context[np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)] = end
    xxh = xxhash.xxh64_intdigest
    hashes = np.fromiter((xxh(w, 7) for w in index), np.uint64, len(index))
    bucket = (hashes % np.uint64(buckets)).astype(np.int64)
    if at := [n for n, h in enumerate(hashes.tolist()) if h in split]:  # each part becomes a word of its own here
        parts = np.ones(len(hashes), np.int64)
        parts[at] = [split[h] for h in hashes[at].tolist()]
        part = hashes[context] % parts[word].astype(np.uint64)
        moved = np.flatnonzero(part)
        own, new = np.unique(np.stack((word[moved], part[moved].astype(np.int64))), axis=1, return_inverse=True)
        word[moved] = len(hashes) + new.reshape(-1)
        bucket = np.concatenate((bucket, (bucket[own[0]] + own[1]) % buckets))
        hashes = np.concatenate((hashes, hashes[own[0]]))
    # Words in the order of their buckets; a sorted key is (word, context, document).
    order = np.lexsort((hashes, bucket))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    if len(hashes) < 1 << 24:
        keys, n = np.unique((place[word] << 39) | (context << 15) | doc, return_counts=True)
        word, context, doc = keys >> 39, (keys >> 15) & ((1 << 24) - 1), keys & ((1 << 15) - 1)
    else:  # a single text of very many distinct words
        (word, context, doc), n = np.unique(np.stack((place[word], context, doc)), axis=1, return_counts=True)
    hashes_at = hashes[order]
    edges = np.searchsorted(bucket[order][word], np.arange(buckets + 1))
    ids = np.array([i for i, _, _ in docs], "<i8").tobytes()
    held = np.array([h for _, _, h in docs], np.uint8).tobytes()
    rows, seen = _rows(PACKED), np.zeros(len(hashes), np.int64)
    for b in range(buckets):
        lo, hi = edges[b], edges[b + 1]
        if lo == hi:
            continue
        first = np.flatnonzero(np.concatenate(([True], np.diff(word[lo:hi]) != 0)))
        used = np.zeros(len(hashes), bool)
        used[context[lo:hi]] = True
        used = np.flatnonzero(used)
        seen[used] = np.arange(len(used))
        values = {
            "bucket": b, "chunk": chunk, "ids": ids if not rows["bucket"] else b"", "held": held,
            "words": hashes_at[word[lo:hi][first]].astype("<u8").tobytes(), "runs": _narrow(np.diff(np.append(first, hi - lo))),
            "contexts": hashes[used].astype("<u8").tobytes(), "context": _narrow(seen[context[lo:hi]]),
            "doc": doc[lo:hi].astype("<u2").tobytes(), "n": _narrow(n[lo:hi]),
        }
        for column, value in values.items():
            rows[column].append(value)
    return _batch(rows, PACKED)


# --- Seating ----------------------------------------------------------------------------------


def stirling(discount: float) -> np.ndarray:
    """log S[c, t]: ways to seat c customers at t tables, weighted as the discount asks; -inf: none."""
    s = np.full((EXACT + 1, EXACT + 1), -np.inf)
    s[1, 1] = 0.0
    for c in range(1, EXACT):
        for t in range(1, c + 2):
            with np.errstate(divide="ignore"):
                stay = s[c, t] + np.log(c - discount * t) if t <= c else -np.inf
            s[c + 1, t] = np.logaddexp(stay, s[c, t - 1])
    return s


def reseat(
    rng: np.random.Generator, customers: np.ndarray, others: np.ndarray, share: np.ndarray, discount: float, strength: float, table: np.ndarray
) -> np.ndarray:
    """New numbers of tables of dishes with ``customers`` each, given the tables of the restaurant's other
    dishes and the parent's probability ``share`` of the dish."""
    tables = np.minimum(customers, 1)
    draws = rng.random(len(customers))
    for c in range(2, EXACT + 1):
        at = np.flatnonzero(customers == c)
        for part in np.array_split(at, max(1, len(at) // 50_000)):
            if not len(part):
                continue
            opened = np.arange(c)
            weight = np.log(strength + discount * (others[part, None] + opened)).cumsum(axis=1)
            weight += np.log(share[part])[:, None] * (opened + 1) + table[c, 1 : c + 1]
            weight = np.exp(weight - weight.max(axis=1, keepdims=True)).cumsum(axis=1)
            tables[part] = 1 + (weight < draws[part, None] * weight[:, -1:]).sum(axis=1)
    many = np.flatnonzero(customers > EXACT)
    busy = np.ones(len(many), np.int64)
    opening = lambda at: (strength + discount * (others[many[at]] + busy[at])) * share[many[at]]
    everyone = np.arange(len(many))
    for k in range(1, EXACT):  # the first ones one by one
        a = opening(everyone)
        busy += rng.random(len(many)) * (k - discount * busy + a) < a
    seated, live = np.full(len(many), float(EXACT)), everyone
    while len(live):  # then each dish skips to its next customer who opens a table
        a = opening(live)
        base = seated[live] - discount * busy[live] + a / 2 - 0.5
        joined = base * np.expm1(np.minimum(rng.exponential(size=len(live)) / a, 600.0))
        ahead = seated[live] + np.floor(joined) + 1
        on = ahead <= customers[many[live]]
        live = live[on]
        seated[live] = ahead[on]
        busy[live] += 1
    tables[many] = busy
    return tables


def discount_of(ones: float, twos: float) -> float:
    """The usual estimate from how many dishes have one and two customers, kept inside (0, 1)."""
    return float(np.clip(ones / max(1.0, ones + 2 * twos), 0.05, 0.95))


class Bucket:
    """All tokens of the words of one bucket: entries, and the distinct (word, context) pairs among them.

    Everything is in the order of hashes, whatever order the rows came in.
    """

    def __init__(self, table: pa.Table, bucket: int, split: dict[int, int]):
        rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
        get = lambda r, c, t: np.frombuffer(r[c], t)
        small = lambda parts: np.concatenate([p.astype(np.int32) for p in parts])
        self.bucket, self.rows = bucket, [{c: r[c] for c in ("chunk", "ids", "held")} for r in rows]
        self.docs = np.concatenate(([0], np.cumsum([len(r["held"]) for r in rows])))
        self.doc = small([get(r, "doc", "<u2").astype(np.int32) + np.int32(s) for r, s in zip(rows, self.docs, strict=False)])
        self.n = small([_wide(r["n"], len(r["doc"]) // 2) for r in rows])
        self.words, word_at = np.unique(np.concatenate([get(r, "words", "<u8") for r in rows]), return_inverse=True)
        self.contexts, context_at = np.unique(np.concatenate([get(r, "contexts", "<u8") for r in rows]), return_inverse=True)
        key = np.repeat(word_at, np.concatenate([_wide(r["runs"], len(r["words"]) // 8) for r in rows])) << 32
        at = shift = 0
        for r in rows:  # in place: these are the largest arrays
            found = context_at[_wide(r["context"], len(r["doc"]) // 2) + shift]
            key[at : at + len(found)] |= found
            at, shift = at + len(found), shift + len(r["contexts"]) // 8
        held = np.concatenate([get(r, "held", np.uint8) for r in rows]).astype(bool)
        del rows, word_at, context_at
        pairs, pair = np.unique(key, return_inverse=True)
        self.pair = pair.astype(np.int32)
        del key, pair
        self.word, self.context = pairs >> 32, pairs & 0xFFFFFFFF
        train = np.where(held[self.doc], 0, self.n)
        self.customers = np.bincount(self.pair, train, len(pairs)).astype(np.int64)
        self.seen = np.bincount(self.word, self.customers, len(self.words)).astype(np.int64)
        self.rng = np.random.default_rng([11, bucket])
        # Words that are dealt to several buckets, in the same order everywhere, and which of the words here they are.
        self.split = np.array(sorted(split), np.uint64)
        self.parts = np.array([split[h] for h in self.split.tolist()], np.int64)
        at = np.minimum(np.searchsorted(self.split, self.words), max(0, len(split) - 1))
        self.is_split = self.split[at] == self.words if len(split) else np.zeros(len(self.words), bool)
        self.split_at = at[self.is_split]

    def per_context(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.context, values, len(self.contexts)).astype(np.int64)

    def per_word(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.word, values, len(self.words)).astype(np.int64)

    def first_seating(self, buckets: int, strength: float) -> tuple[np.ndarray, np.ndarray]:
        """Tables of pairs and of words in the parent, with this bucket standing for all."""
        c = self.customers
        d = discount_of((c == 1).sum(), (c == 2).sum())
        tables, log_s = np.minimum(c, 1), stirling(d)
        for _ in range(2):
            parent = self.per_word(tables)
            share = (parent + 0.5) / max(1, buckets * parent.sum())
            share[self.is_split] *= self.parts[self.split_at]
            others = buckets * self.per_context(tables)[self.context] - tables
            tables = reseat(self.rng, c, others, share[self.word], d, strength, log_s)
        parent = self.per_word(tables)
        d0 = discount_of((parent == 1).sum(), (parent == 2).sum())
        known = np.full(len(parent), 1.0 / max(1, buckets * (self.seen > 0).sum()))
        root = reseat(self.rng, parent, buckets * (parent > 0).sum() - np.minimum(parent, 1), known, d0, strength, stirling(d0)) if len(parent) else parent
        return tables, root

    def keys(self) -> np.ndarray:
        """What is asked for: contexts, all split words, sums."""
        return np.concatenate((self.contexts, self.split ^ SPLIT, SUMS))

    def owners(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """The keys in the order of their owners, and the owners."""
        owner = (self.keys() % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(owner, kind="stable")
        return order, owner[order]

    def share_of(self, tables: np.ndarray, root: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """This bucket's part of the customers and tables of each key. Split words count as words elsewhere."""
        parent, c, one = self.per_word(tables), self.customers, ~self.is_split
        a = [c.sum(), parent.sum(), (c == 1).sum(), (parent[one] == 1).sum()]
        b = [(self.seen[one] > 0).sum(), root[one].sum(), (c == 2).sum(), (parent[one] == 2).sum()]
        customers, seated = np.zeros(len(self.split), np.int64), np.zeros(len(self.split), np.int64)
        customers[self.split_at], seated[self.split_at] = self.seen[self.is_split], parent[self.is_split]
        return np.concatenate((self.per_context(c), customers, a)), np.concatenate((self.per_context(tables), seated, b))


# --- The three shuffles -----------------------------------------------------------------------


@dataclass
class PitmanYor:
    """``sweeps``: redrawn seatings before, and ``samples``: after which probabilities are averaged.
    ``strength``: of all restaurants; discounts are estimated from the counts. Documents with
    crc32(doc_id) mod ``modulus`` = ``remainder`` are scored but not learnt from."""

    sweeps: int = 2
    samples: int = 3
    strength: float = 1.0
    modulus: int = 7
    remainder: int = 2

    def hot_words(self, docs: DataFrame, buckets: int) -> dict[int, int]:
        """Words with more than about half a bucket's share of all tokens, and the buckets to deal them to.

        Tasks report words that are frequent in a chunk; at most ``4 * buckets`` words can be so in the whole.
        """
        least = 1 / (4 * buckets)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                count, size = Counter(), 0
                for n, text in enumerate(batch.column("text")):
                    text = text.as_py()
                    count.update(text.lower().split())
                    count[END] += 1
                    size += len(text)
                    if size >= CHUNK_BYTES or n == batch.num_rows - 1:
                        total = count.total()
                        found = [(xxhash.xxh64_intdigest(w, 7), c) for w, c in count.items() if c >= least * total]
                        words = np.array([w for w, _ in found], np.uint64).view(np.int64)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([False] * len(found) + [True]), pa.array([*words.tolist(), 0], pa.int64()), pa.array([*(c for _, c in found), total], pa.int64())],
                            ["whole", "word", "n"],
                        )
                        count, size = Counter(), 0

        texts = docs.select(text_of().cast("binary").alias("text"))
        found = texts.mapInArrow(run, "whole boolean, word long, n long").groupBy("whole", "word").agg(F.sum("n").alias("n"))
        found = written(found, "frequent")
        total = found.where("whole").agg(F.sum("n")).first()[0] or 0
        rows = found.where(~F.col("whole") & (F.col("n") > least * total)).collect()
        return {r["word"] % (1 << 64): min(buckets, int(2 * buckets * r["n"] / total) + 1) for r in rows}

    def packed(self, docs: DataFrame, buckets: int, split: dict[int, int]) -> DataFrame:
        modulus, remainder = self.modulus, self.remainder

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            chunk, held, size = TaskContext.get().partitionId() << 32, [], 0
            for batch in batches:
                for doc, text in zip(batch.column("id"), batch.column("text"), strict=True):
                    doc, text = doc.as_py(), text.as_py()
                    held.append((doc, text, held_out(doc, modulus, remainder)))
                    size += len(text)
                    if size >= CHUNK_BYTES or len(held) >= CHUNK_DOCS:
                        yield pack(held, chunk, buckets, split)
                        chunk, held, size = chunk + 1, [], 0
            if held:
                yield pack(held, chunk, buckets, split)

        narrow = docs.select(internal_id().alias("id"), text_of().cast("binary").alias("text"))
        return narrow.mapInArrow(run, PACKED)

    def score(self, docs: DataFrame) -> DataFrame:
        """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), a row per row of ``docs``
        (doc_id, text). Scores are log10 probabilities; a text without words is its end token alone."""
        buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        strength, sweeps, samples = self.strength, self.sweeps, self.samples
        split = self.hot_words(docs, buckets)
        packed = self.packed(docs, buckets, split)

        def ask(key: tuple, table: pa.Table) -> pa.Table:
            b = Bucket(table, key[0].as_py(), split)
            customers, tables = b.share_of(*b.first_seating(buckets, strength))
            keys, (order, owner), rows = b.keys(), b.owners(buckets), _rows(ASKED)
            for at in np.split(np.arange(len(order)), np.flatnonzero(np.diff(owner)) + 1):
                k = order[at]
                values = (int(owner[at[0]]), b.bucket, keys[k].astype("<u8").tobytes(), _narrow(customers[k]), _narrow(tables[k]))
                for column, value in zip(rows.values(), values, strict=True):
                    column.append(value)
            return pa.Table.from_batches([_batch(rows, ASKED)])

        def tell(key: tuple, table: pa.Table) -> pa.Table:
            asked = table.to_pylist()
            keys = np.concatenate([np.frombuffer(r["keys"], "<u8") for r in asked])
            _, at = np.unique(keys, return_inverse=True)
            rows, totals = _rows(TOLD), {}
            for c in ("customers", "tables"):
                values = np.concatenate([_wide(r[c], len(r["keys"]) // 8) for r in asked])
                totals[c] = np.bincount(at, values)[at].astype(np.int64)
            start = 0
            for r in asked:
                end = start + len(r["keys"]) // 8
                values = (r["bucket"], key[0].as_py(), _narrow(totals["customers"][start:end]), _narrow(totals["tables"][start:end]))
                for column, value in zip(rows.values(), values, strict=True):
                    column.append(value)
                start = end
            return pa.Table.from_batches([_batch(rows, TOLD)])

        def finish(key: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
            b = Bucket(table, key[0].as_py(), split)
            tables, root = b.first_seating(buckets, strength)
            order, owner = b.owners(buckets)
            asked = dict(zip(*np.unique(owner, return_counts=True), strict=True))
            total = {}
            answers = sorted(told.to_pylist(), key=lambda r: r["owner"])
            for c in ("customers", "tables"):
                total[c] = np.empty(len(order), np.int64)
                total[c][order] = np.concatenate([_wide(r[c], asked[r["owner"]]) for r in answers])
            train, parent_all, ones, parent_ones = (int(x) for x in total["customers"][-len(SUMS) :])
            types, root_all, twos, parent_twos = (int(x) for x in total["tables"][-len(SUMS) :])
            n_contexts = len(b.contexts)
            customers, held_tables = total["customers"][:n_contexts], total["tables"][:n_contexts]
            split_seen, split_parent = total["customers"][n_contexts : -len(SUMS)], total["tables"][n_contexts : -len(SUMS)]
            types += int((split_seen > 0).sum())
            d, d0 = discount_of(ones, twos), discount_of(parent_ones, parent_twos)
            log_s, log_s0 = stirling(d), stirling(d0)
            parent, uniform = b.per_word(tables), 1.0 / (types + 1)
            seen, elsewhere = b.seen.copy(), np.zeros_like(parent)  # what split words have in other buckets
            seen[b.is_split] = split_seen[b.split_at]
            elsewhere[b.is_split] = split_parent[b.split_at] - parent[b.is_split]
            parent = parent + elsewhere
            split_root = np.minimum(split_parent, 1)
            split_root = reseat(
                np.random.default_rng(13), split_parent, root_all - split_root, np.full(len(split_parent), uniform), d0, strength, log_s0
            )  # the same draw everywhere
            root_all += int(split_root.sum())
            root = np.where(b.is_split, 0, root)
            root[b.is_split] = split_root[b.split_at]
            probability = np.zeros(len(b.word))
            for sweep in range(sweeps + samples):
                share = (np.maximum(parent - d0 * root, 0) + (strength + d0 * root_all) * uniform) / (strength + parent_all)
                new = reseat(b.rng, b.customers, held_tables[b.context] - tables, share[b.word], d, strength, log_s)
                held_tables = held_tables + b.per_context(new - tables)
                parent_all += int((new - tables).sum())
                tables, parent = new, b.per_word(new) + elsewhere
                new = reseat(b.rng, parent, root_all - root, np.full(len(parent), uniform), d0, strength, log_s0)
                root_all += int((new - root).sum())
                root = new
                if sweep >= sweeps:
                    share = (parent - d0 * root + (strength + d0 * root_all) * uniform) / (strength + parent_all)
                    own = b.customers - d * tables
                    back = (strength + d * held_tables)[b.context] * share[b.word]
                    probability += (own + back) / (strength + customers[b.context]) / samples
            count = lambda values: np.bincount(b.doc, values, b.docs[-1])
            seen = seen[b.word][b.pair]
            found = {
                "tokens": count(b.n).astype(np.int64), "known": count(np.where(seen > 0, b.n, 0)).astype(np.int64),
                "base": count(b.n * np.log10(seen + 1.0)), "score": count(b.n * np.log10(probability)[b.pair]),
            }
            rows = _rows(PARTS)
            for r, lo, hi in zip(b.rows, b.docs, b.docs[1:], strict=False):
                values = {"chunk": r["chunk"], "bucket": b.bucket, "ids": r["ids"], "held": r["held"] if r["ids"] else b"", "train": train, "types": types}
                values |= {c: _narrow(v[lo:hi]) if v.dtype == np.int64 else v[lo:hi].tobytes() for c, v in found.items()}
                for column, value in values.items():
                    rows[column].append(value)
            return pa.Table.from_batches([_batch(rows, PARTS)])

        def add_up(key: tuple, table: pa.Table) -> pa.Table:
            rows = sorted(table.to_pylist(), key=lambda r: r["bucket"])
            (home,) = (r for r in rows if r["ids"])
            size = len(home["held"])
            whole = lambda c: sum(_wide(r[c], size) for r in rows)
            add = lambda c: sum(np.frombuffer(r[c], "<f8") for r in rows)
            n = whole("tokens")
            base = add("base") - n * np.log10(home["train"] + home["types"] + 1.0)
            ids, held = np.frombuffer(home["ids"], "<i8"), np.frombuffer(home["held"], np.uint8).astype(bool)
            columns = [ids, held, n, whole("known"), np.full(len(ids), home["train"]), base, add("score")]
            return pa.table([pa.array(c) for c in columns], ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

        asked = packed.groupBy("bucket").applyInArrow(ask, ASKED)
        told = asked.groupBy("owner").applyInArrow(tell, TOLD)
        parts = packed.groupBy("bucket").cogroup(told.groupBy("bucket")).applyInArrow(finish, PARTS)
        scored = parts.groupBy("chunk").applyInArrow(
            add_up, "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
        )
        return scored.withColumn("doc_id", external_id("id")).select(
            "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
        )


def perplexity(scored: DataFrame) -> DataFrame:
    """(held_out, documents, tokens, perplexity, base_perplexity) of scored documents."""
    per = lambda c: F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))
    return scored.groupBy("held_out").agg(
        F.count("*").alias("documents"), F.sum("n_tokens").alias("tokens"), per("score").alias("perplexity"), per("base_score").alias("base_perplexity")
    )
