"""Exact and near deduplication against brute force, with awkward rows."""

from collections import defaultdict

import corpus_pipeline
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from callinsight.llm import exact_dedup, simhash, similar

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, id string, row int, component string, stay int"


def awkward(spark):
    base = [
        (5, "a b\tc"), (3, "a b c"), (9, "a  b\nc"), (None, "a b c"), (1, None), (2, ""), (7, "x"), (7, "x"), (7, "y z"),
        (8, "y z"), (None, "only"), (11, "w " * 60_000), (12, "w " * 60_000), (13, "  "), (6, "y z"),
    ]
    return spark.createDataFrame([(i, t, "extra", 1, "c", n) for n, (i, t) in enumerate(base)], SCHEMA)


def brute_groups(rows):
    groups = defaultdict(list)
    for i, t in rows:
        key = exact_dedup_normal(t or "")
        groups[key].append(i)
    return groups


def exact_dedup_normal(text):
    import re

    return re.sub(r"[\x20\x09-\x0D]+", " ", text)


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda t: F.substring(F.unhex(F.sha2(t, 256)), 1, 0)])
def test_exact_groups_with_and_without_collisions(spark, digest):
    docs = awkward(spark)
    op = exact_dedup.ExactDedup(digest=digest)
    got = op.groups_of(docs).collect()
    groups = brute_groups([(r.doc_id, r.text) for r in docs.collect()])
    want = sorted((str(i), str(min((x for x in g if x is not None), default=None)), len(g)) for g in groups.values() for i in g)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_rows_that_stay(spark):
    kept = exact_dedup.deduplicate(awkward(spark))
    assert kept.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    rows = kept.collect()
    texts = [exact_dedup_normal(r.text or "") for r in rows]
    assert len(set(texts)) == len(texts) == 7
    assert {r.doc_id for r in rows if r.text == "y z"} == {6}


def test_state_goes_on_from_where_it_was(spark):
    op, path = exact_dedup.ExactDedup(), exact_dedup.shared_folder(spark, "t")
    checkpoint = exact_dedup.shared_folder(spark, "c")
    for ids in ([4, 6], [2]):
        docs = spark.createDataFrame([(i, "same") for i in ids], "doc_id long, text string")
        op.arrivals(docs).write.mode("append").parquet(path)
        op.update_state(spark, path, checkpoint)
    (row,) = op.read_state(spark, checkpoint).collect()
    assert (row.keep_id, row.group_size) == (2, 3)


def test_empty_tables(spark):
    none = awkward(spark).where("false")
    assert exact_dedup.deduplicate(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.keep_one(none).count() == 0


# --- SimHash ----------------------------------------------------------------------------------


def plain_fingerprint(text, k=4):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def brute_components(nodes, linked):
    """nodes: sorted ids; linked(i, j) on positions."""
    parent = list(range(len(nodes)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(nodes)):
        for j in range(i):
            if linked(i, j):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [nodes[root(i)] for i in range(len(nodes))]


def test_near_duplicates_match_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = sorted((r.doc_id, plain_fingerprint(r.text or "")) for r in docs.collect())
    fps = np.array([f for _, f in rows], np.uint64)
    want = brute_components([i for i, _ in rows], lambda i, j: int(fps[i] ^ fps[j]).bit_count() <= 4)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {i: (f"{f:016x}", c) for (i, f), c in zip(rows, want, strict=True)}
    kept = simhash.keep_one(docs).collect()
    assert {r.doc_id for r in kept} == set(want) and len(kept) == len(set(want))


def test_near_duplicates_of_awkward_rows(spark):
    got = simhash.near_duplicates(awkward(spark)).collect()
    assert len(got) == 15
    zero = {r.doc_id: r.component_id for r in got if r.fingerprint == "0" * 16}
    assert zero == {1: 1, 2: 1, 13: 1}
    assert [r.doc_id for r in simhash.keep_one(awkward(spark)).collect()].count(7) == 1


def test_rows_without_an_id_or_with_one_id_link_nothing(spark):
    far = [" ".join(f"{w}{i}" for i in range(30)) for w in ("oak", "elm", "ash", "fir")]
    rows = [(None, far[0]), (None, far[1]), (7, far[2]), (7, far[3]), (3, far[3]), (None, far[3]), (None, far[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.near_duplicates(docs).collect()}
    prints = [f"{plain_fingerprint(t):016x}" for t in far]
    want = {(None, prints[0]): None, (None, prints[1]): None, (7, prints[2]): 7, (7, prints[3]): 3, (3, prints[3]): 3, (None, prints[3]): 3}
    assert got == want
    kept = sorted(((r.doc_id, r.text) for r in simhash.keep_one(docs).collect()), key=str)
    assert kept == sorted([(None, far[0]), (None, far[1]), (7, far[2]), (3, far[3])], key=str)
    left = [(r.doc_id, r.text) for r in simhash.keep_one(awkward(spark)).collect()]
    assert (None, "only") in left and (None, "a b c") not in left


def link_components(values, lead, budget):
    found = simhash.join_trie(values, lead, budget)
    n = len(values)
    pairs = set(map(tuple, found.T.tolist()))
    assert len(pairs) < max(n, 1)  # a forest
    return brute_components(list(range(n)), lambda i, j: (i, j) in pairs or (j, i) in pairs), found


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2**64 - 1), st.lists(st.integers(0, 63), max_size=6)), min_size=1, max_size=40), st.integers(0, 5))
def test_trie_links_every_pair(seeds, budget):
    values = set()
    for base, flips in seeds:
        values.add(base)
        for f in flips:
            base ^= 1 << f
            values.add(base)
    values = np.array(sorted(values), np.uint64)
    edges = set()
    for order, lead in simhash.leads(budget):
        run = np.sort(simhash.permuted(values, order))
        assert np.array_equal(np.sort(simhash.restored(run, order)), values)
        for a, b in simhash.join_trie(run, lead, budget).T:
            x, y = simhash.restored(run[[a, b]], order)
            assert int(x ^ y).bit_count() <= budget
            edges.add((int(x), int(y)))
    at = {int(v): i for i, v in enumerate(values)}
    ids = list(range(len(values)))
    known = {(at[x], at[y]) for x, y in edges}
    got = brute_components(ids, lambda i, j: (i, j) in known or (j, i) in known)
    want = brute_components(ids, lambda i, j: int(values[i] ^ values[j]).bit_count() <= budget)
    assert got == want


def test_dense_group_gives_a_forest(monkeypatch):
    monkeypatch.setattr(simhash, "FRONTIER", 64)
    rng = np.random.default_rng(1)
    base = np.uint64(0x123456789ABCDEF0)
    values = np.unique([base ^ np.uint64(sum(1 << int(b) for b in rng.choice(40, rng.integers(0, 4), replace=False))) for _ in range(400)])
    comp, _ = link_components(values, 20, 4)
    want = brute_components(list(range(len(values))), lambda i, j: int(values[i] ^ values[j]).bit_count() <= 4)
    assert comp == want


def test_long_chain_of_links(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    got = {r.node: r.component for r in simhash.components(edges).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {501: 500}


# --- Similar shingle sets -----------------------------------------------------------------------


def plain_set(text, k=5):
    words = text.encode().lower().split()
    return {b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def plain_similar(texts):
    """Pairs (i, j) of Jaccard >= 0.8, by counting every shared shingle; texts without words are alike."""
    sets, holders, shared = [plain_set(t) for t in texts], defaultdict(list), defaultdict(int)
    for i, s in enumerate(sets):
        for x in s or {None}:
            for j in holders[x]:
                shared[i, j] += 1
            holders[x].append(i)
    size = [max(1, len(s)) for s in sets]
    return {(i, j) for (i, j), n in shared.items() if 5 * n >= 4 * (size[i] + size[j] - n)}


def test_similar_texts_match_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(3)
    word = lambda: f"w{rng.integers(5000)}"
    base, passage = [word() for _ in range(120)], [word() for _ in range(30)]
    rows = [(i, " ".join([word() for _ in range(int(rng.integers(3, 40)))] + passage)) for i in range(100, 140)]
    for i in range(200, 260):  # near copies of one text, most of them far from each other
        copy = list(base)
        for at in rng.integers(0, 120, int(rng.integers(1, 6))):
            copy[at] = word()
        rows.append((i if i % 3 else None, " ".join(copy)))
    chain = [word() for _ in range(100)]
    for i in range(300, 312):  # each near the one before
        chain = chain[9:] + [word() for _ in range(9)]
        rows.append((i, " ".join(chain)))
    rows += [(1, None), (2, ""), (3, " "), (4, "Two words"), (5, "two  WORDS"), (None, "four words are here"), (6, " ".join(base))]
    table = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id >= 400").selectExpr("doc_id + 1000", "text").collect()
    rows += [(i, t) for i, t in map(tuple, table)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    rows.sort(key=lambda r: (r[0] is None, r[0]))
    pairs = plain_similar([t or "" for _, t in rows])
    want = brute_components(list(range(len(rows))), lambda i, j: (i, j) in pairs)
    sizes = {c: want.count(c) for c in want}
    for seen in (20_000, 50):  # the frequencies known must not change what is found
        monkeypatch.setattr(similar, "SEEN", seen)
        kept = sorted((str(r.doc_id) for r in corpus_pipeline.near_copies(spark, docs, SF).collect()))
        assert kept == sorted(str(rows[c][0]) for c in sizes)
    assert max(sizes.values()) > 20


def test_documents_of_a_template_stay(spark):
    """Documents of a hundred shared and fourteen own words are no near copies; their postings meet, none of them goes."""
    rng = np.random.default_rng(5)
    template = [f"t{i}" for i in range(100)]
    texts = [" ".join([*template[:50], *(f"w{rng.integers(10**9)}" for _ in range(14)), *template[50:]]) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert similar.keep_one(docs).count() == 300


def test_near_copies_come_from_the_trie(spark):
    """Copies with a word or two changed meet the middle one of their group; the prefixes find what is left."""
    rng = np.random.default_rng(7)
    base = [f"w{rng.integers(10**6)}" for _ in range(400)]
    texts = [" ".join([*base[:at], f"x{at}", *base[at + 1 :]]) for at in range(10, 390, 19)]
    texts += [" ".join(f"v{rng.integers(10**6)}" for _ in range(60)) for _ in range(50)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = similar.postings(docs, 5).cache()
    fps = {r.id: bytes(r.fp) for r in found.collect()}
    pairs = [(bytes(r.a), bytes(r.b)) for r in similar.trie_pairs(found).collect()]
    middles = {b for _, b in pairs}
    assert len(middles) == 1 and {a for a, _ in pairs} | middles == {fps[i] for i in range(20)}
    assert similar.keep_one(docs).count() == 51


def test_parities_differ_in_no_more_places_than_sets():
    rng = np.random.default_rng(8)
    for n in (0, 1, 30, 3000):
        sets = [np.unique(rng.integers(0, 2 * n + 1, n).astype(np.uint64) * np.uint64(11400714819323198485)) for _ in range(2)]
        one, two = map(similar.parity, sets)
        assert len(one) * 64 == similar.PARITY
        assert int(np.bitwise_count(one ^ two).sum()) <= len(np.setxor1d(*sets))
        assert int(np.bitwise_count(one).sum()) == len(sets[0]) % 2 or n > 1


def _deliveries():
    base = [(10, "a  b"), (11, "c"), (12, "a b"), (13, None), (14, "long " * 30_000)]
    second = [(1, "a b"), (2, "c d"), (3, "c\td"), (20, ""), (21, "new"), (21, "new"), (None, "c"), (None, "only")]
    third = [(5, "only"), (6, "new "), (7, "long\n" * 30_000), (8, "fresh"), (21, "new")]
    return [base, second, third, []]


def test_deliveries_are_deduplicated_against_one_state(spark, tmp_path):
    """Each delivery against all before it."""
    operator = exact_dedup.ExactDedup()
    seen: dict[str, int] = {}
    for n, rows in enumerate(_deliveries()):
        spark.createDataFrame(rows, "doc_id long, text string").repartition(2).write.parquet(f"{tmp_path}/d{n}")
        docs = spark.read.schema("doc_id long, text string").parquet(f"{tmp_path}/d{n}")
        got = sorted(((r.doc_id is None, r.doc_id or 0, r.kept, r.keep_delivery) for r in operator.deliver(docs, f"file://{tmp_path}/state").collect()))
        want, taken = [], set()
        for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0])):
            x = exact_dedup_normal(t or "")
            want.append((i is None, i or 0, x not in seen and x not in taken, seen.get(x, n)))
            taken.add(x)
        assert got == sorted(want), n
        seen |= {x: n for x in taken if x not in seen}


def test_a_digest_met_again_is_compared_by_bytes(spark, tmp_path):
    """Texts of one digest in different deliveries: the content that the state locates tells them apart."""
    operator = exact_dedup.ExactDedup(digest=lambda text: F.unhex(F.sha2(F.substring(text, 1, 1), 256)))
    for n, rows in enumerate([[(1, "apple"), (2, "berry")], [(3, "avocado"), (4, "apple"), (5, "berry")]]):
        spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/d{n}")
        got = {r.doc_id: (r.kept, r.keep_delivery, r.keep_id) for r in operator.deliver(spark.read.parquet(f"{tmp_path}/d{n}"), f"file://{tmp_path}/state").collect()}
    assert got == {3: (True, 1, 3), 4: (False, 0, 1), 5: (False, 0, 2)}
