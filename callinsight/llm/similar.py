"""Near copies by shingle sets: all pairs whose Jaccard similarity reaches 4/5, and what hangs together by them.

Candidates come from operator 4's binary trie of 64-bit fingerprints, here of the shingle sets and with a budget of
``BUDGET`` bits, joined with itself: each set is held against the one in the middle of its group. Fingerprints alone do not
find every pair, so what they leave is found exactly by the prefixes of the sets. All shingles have one order, rare ones first; of two sets of similarity t
each holds a common shingle among its first ``n - ceil(t n) + 1`` ones, so only these are posted, and their
positions bound what two sets can share. The order takes frequencies from some rows; it decides how much
is compared, never what is found.

Pairs are confirmed on whole sets before they count. With the pairs of the trie each set is held against one hub, the most
typical set that it meets by its prefix, which joins dense groups with one comparison a member; then all pairs that
are still in different components and pass the bounds are compared. Parities of the sets in 1,024 bits go ahead: bits in
which they differ stand for at least as many different shingles, so no pair that is similar enough is lost by them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callinsight.llm.common import fresh, internal_id, release, scratch, text_of, written
from callinsight.llm.simhash import BITS, components, decisions, links, majority, placed, shingle_hashes, text_digest, without_dropped
from callinsight.llm.words import slices

WORDS = 5
#: The least similarity as a ratio of whole numbers: comparisons are exact.
PART, WHOLE = 4, 5
#: Rows that frequencies are taken from, and shingles that are put last by them.
SEEN, COMMON = 20_000, 1 << 18
#: Bytes of text whose sets a worker holds at once, or one document.
CHUNK = 2_000_000
#: Differing bits at which the trie links fingerprints, and bits of the parities, a multiple of 64.
BUDGET, PARITY = 8, 1024
#: Bits (as a power of two) of the bitmap of rows to compare.
BITMAP = 24


def shingle_set(text: bytes, words: int = WORDS) -> np.ndarray:
    return np.unique(shingle_hashes(text, words))


def set_key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def leading(n: int) -> int:
    """How many shingles of a set of ``n`` are posted."""
    return n and n - -(-PART * n // WHOLE) + 1


def parity(shingles: np.ndarray) -> np.ndarray:
    """How often, modulo two, a shingle falls on each of ``PARITY`` places."""
    odd = np.bincount((shingles % np.uint64(PARITY)).astype(np.int64), minlength=PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    values = np.concatenate([*parts, np.zeros(0, np.uint64)]).view(np.int64)
    offsets = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def common_shingles(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingles ascending, their counts) of those that several rows share, from about ``SEEN`` rows."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(slices(b, CHUNK) for b in batches):
            parts = [shingle_set(t.as_py(), words) for t in batch.column("text")]
            values = np.concatenate([*parts, np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(values)], ["shingle"])

    share = min(1.0, SEEN / max(1, docs.count()))
    found = docs.select(text_of().cast("binary").alias("text")).sample(share, 1).mapInArrow(each, "shingle long")
    counts = found.groupBy("shingle").count().where("count > 1").orderBy(F.desc("count")).limit(COMMON).toArrow()
    shingles = counts.column("shingle").to_numpy().view(np.uint64)
    order = np.argsort(shingles)
    return shingles[order], counts.column("count").to_numpy()[order]


def postings(docs: DataFrame, words: int) -> DataFrame:
    """(id, digest, fp, n, lead, print, parity) for each row: key and size of its set, the shingles to post in order,
    the fingerprint and the parities of the set."""
    common, counts = common_shingles(docs, words)

    def ranked(shingles: np.ndarray) -> np.ndarray:
        often = np.zeros(len(shingles), np.int64)
        if len(common):
            at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
            often = np.where(common[at] == shingles, counts[at], 0)
        return shingles[np.lexsort((shingles, often))[: leading(len(shingles))]]

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(slices(b, CHUNK) for b in batches):
            sets = [shingle_set(t.as_py(), words) for t in batch.column("text")]
            fp = pa.array(list(map(set_key, sets)), pa.binary())
            n = np.fromiter(map(len, sets), np.int64, len(sets))
            prints = np.fromiter(map(majority, sets), np.uint64, len(sets)).view(np.int64)
            columns = [batch.column("id"), batch.column("digest"), fp, pa.array(n), _lists([ranked(s) for s in sets])]
            columns += [pa.array(prints), _lists([parity(s) for s in sets])]
            yield pa.RecordBatch.from_arrays(columns, ["id", "digest", "fp", "n", "lead", "print", "parity"])

    narrow = docs.select(internal_id().alias("id"), text_digest().alias("digest"), text_of().cast("binary").alias("text"))
    return narrow.mapInArrow(post, "id long, digest binary, fp binary, n long, lead array<long>, print long, parity array<long>")


def whole_sets(docs: DataFrame, rows: DataFrame, words: int) -> DataFrame:
    """(fp, shingles) of the texts of ``rows`` (id, digest). A bitmap of fixed size tells most other rows before
    their sets are made, so that texts are not shuffled; the join decides."""
    bucket = F.xxhash64("id", "digest").bitwiseAND((1 << BITMAP) - 1)
    marks = rows.groupBy(F.shiftright(bucket, 15).alias("at")).agg(F.bitmap_construct_agg(bucket.bitwiseAND(32767)).alias("bits"))
    bitmap = np.zeros((1 << (BITMAP - 15), 4096), np.uint8)
    for mark in marks.collect():
        bitmap[mark.at] = np.frombuffer(bytes(mark.bits), np.uint8)
    bitmap = bitmap.reshape(-1)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(slices(b, CHUNK) for b in batches):
            at = batch.column("bucket").to_numpy()
            hits = np.flatnonzero(bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1)
            part = batch.take(pa.array(hits))
            sets = [shingle_set(t.as_py(), words) for t in part.column("text")]
            fp = pa.array(list(map(set_key, sets)), pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("digest"), fp, _lists(sets)], ["id", "digest", "fp", "shingles"])

    texts = docs.select(internal_id().alias("id"), text_digest().alias("digest"), text_of().cast("binary").alias("text"))
    made = texts.withColumn("bucket", bucket).mapInArrow(each, "id long, digest binary, fp binary, shingles array<long>")
    return made.join(rows, ["id", "digest"]).dropDuplicates(["id", "digest"]).select("fp", "shingles")


def confirmed(docs: DataFrame, found: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """The ``pairs`` (a, b) whose whole sets are similar enough; sets are made only for those in pairs that parities let pass.

    Sets of ``na`` and ``nb`` shingles, ``d`` of them in one alone, are similar enough if (WHOLE - PART) * (na + nb) is at
    least (WHOLE + PART) * d, and ``d`` is at least the number of places where the parities differ."""
    marks = found.groupBy("fp").agg(F.first("n").alias("n"), F.first("parity").alias("parity"))
    met = pairs.join(marks.toDF("a", "na", "qa"), "a").join(marks.toDF("b", "nb", "qb"), "b")
    apart = F.aggregate(F.zip_with("qa", "qb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, v: s + v)
    pairs = written(met.where((WHOLE - PART) * (F.col("na") + F.col("nb")) >= (WHOLE + PART) * apart).select("a", "b"), "pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("fp")).distinct()
    rows = found.join(ends, "fp").groupBy("fp").agg(F.min(F.struct("id", "digest")).alias("row"))
    rows = written(rows.select("row.id", "row.digest"), "compared")
    sets = written(whole_sets(docs, rows, words), "sets")
    met = pairs.join(sets.select(F.col("fp").alias("a"), F.col("shingles").alias("sa")), "a")
    met = met.join(sets.select(F.col("fp").alias("b"), F.col("shingles").alias("sb")), "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    return met.where((WHOLE + PART) * shared >= PART * (F.size("sa") + F.size("sb"))).select("a", "b")


def able(n: str, pos: str, other_n: str, other_pos: str) -> Column:
    """Whether two sets can be similar that meet first at these positions."""
    most = F.least(F.col(n) - F.col(pos), F.col(other_n) - F.col(other_pos))
    return (WHOLE + PART) * most >= PART * (F.col(n) + F.col(other_n))


def trie_pairs(found: DataFrame) -> DataFrame:
    """(a, b): each set with the middle one of its group, the groups being what the trie of fingerprints links.

    The middle is the set whose fingerprint differs least from the majority bits of all in the group."""
    sets = found.select("fp", "print").distinct()
    prints = sets.select(F.col("print").alias("fp")).distinct()
    groups = placed(prints, components(links(prints, BUDGET))).select(F.col("fp").alias("print"), F.col("component").alias("group"))
    grouped = written(sets.join(groups, "print"), "groups")
    votes = [F.sum(F.shiftrightunsigned("print", bit).bitwiseAND(F.lit(1))).alias(f"b{bit}") for bit in range(BITS)]
    voted = grouped.groupBy("group").agg(F.count("*").alias("size"), *votes).where("size > 1")
    middle = F.lit(0).cast("long")
    for bit in range(BITS):
        middle = middle.bitwiseOR(F.when(F.col(f"b{bit}") * 2 > F.col("size"), F.shiftleft(F.lit(1).cast("long"), bit)).otherwise(F.lit(0).cast("long")))
    near = grouped.join(voted.select("group", middle.alias("middle")), "group")
    hub = near.groupBy("group").agg(F.min(F.struct(F.bit_count(F.col("print").bitwiseXOR(F.col("middle"))).alias("far"), "fp")).alias("hub"))
    return grouped.join(hub, "group").where("fp != hub.fp").select(F.col("fp").alias("a"), F.col("hub.fp").alias("b"))


def hubs(shared: DataFrame) -> DataFrame:
    """(a, b): each set with the most typical one that it meets most often among those of about its size."""
    score = shared.groupBy("fp").agg((F.sum("often") / F.max("n")).alias("score"))
    size = F.log("n") / F.log(F.lit(1.5))
    sized = shared.join(score, "fp").select("shingle", "fp", "n", "pos", "score", F.explode(F.array(F.floor(size) * 2, F.floor(size + 0.5) * 2 + 1)).alias("size"))
    top = sized.groupBy("shingle", "size").agg(F.max(F.struct("score", "fp", "n", "pos")).alias("hub"))
    met = sized.join(top, ["shingle", "size"]).where("fp != hub.fp")
    met = met.where(able("n", "pos", "hub.n", "hub.pos"))
    met = met.groupBy("fp", "hub.fp", "hub.score").agg(F.count("*").alias("times")).toDF("a", "b", "score", "times")
    return met.groupBy("a").agg(F.max(F.struct("times", "score", "b")).alias("best")).select("a", "best.b")


def other_pairs(shared: DataFrame, hung: DataFrame) -> DataFrame:
    """(a, b): the pairs of different components that can still be similar, by size and positions."""
    marked = shared.join(hung.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    mixed = marked.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    still = written(marked.join(mixed.select("shingle"), "shingle", "left_semi").select("shingle", "fp", "n", "pos", "component"), "still")
    one = still.toDF("shingle", "a", "na", "pa", "ca")
    two = still.toDF("shingle", "b", "nb", "pb", "cb")
    return one.join(two, "shingle").where("a < b and ca != cb").where(able("na", "pa", "nb", "pb")).select("a", "b").distinct()


def keep_one(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """The rows of ``docs`` with one row of each component of similar texts left, see ``simhash.one_of_each``.

    All tables made on the way are removed but the list of the rows that go; shuffle files go after each step."""
    spark = docs.sparkSession
    key, mark = fresh("_id", docs), fresh("_digest", docs)
    with scratch(spark):
        found = written(postings(docs, words), "postings")
        posts = found.select("fp", "n", F.posexplode("lead").alias("pos", "shingle"))
        often = posts.groupBy("shingle").agg(F.count("*").alias("often")).where("often > 1")
        shared = posts.join(often, "shingle").groupBy("shingle", "fp").agg(F.min("n").alias("n"), F.min("pos").alias("pos"), F.min("often").alias("often"))
        shared = written(shared, "shared")
        found = written(found.select("id", "digest", "fp", "n", "print", "parity"), "found")
        release(spark)
        linked = written(trie_pairs(found), "linked")
        release(spark)
        hubbed = written(linked.unionByName(hubs(shared)).distinct(), "hubs")
        release(spark)
        near = written(confirmed(docs, found, hubbed, words), "near")
        release(spark)
        others = written(other_pairs(shared, components(near)), "others")
        release(spark)
        rest = written(confirmed(docs, found, others, words), "rest")
        release(spark)
        touched = decisions(found, components(near.unionByName(rest)))
        touched = written(touched.select(F.col("id").alias(key), F.col("digest").alias(mark), "stays"), "touched", keep=True)
    return without_dropped(docs, touched.drop("stays"), touched.where("stays").drop("stays"), key, mark)
