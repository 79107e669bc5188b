"""Edit-aware token counts against whole encodings, and the Pitman-Yor model against exact figures."""

import json
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from callinsight.llm import bpe, hpylm, queries, token_counts

SF = "/root/testdata/sf0.01"
TEXT = st.text(st.sampled_from(list("ab c\n  '1.!s") + ["é"]), max_size=400)
EDIT = st.tuples(st.integers(0, 450), st.integers(0, 30), st.text(st.sampled_from("ab \n's1!"), max_size=200))


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(bpe.DEFAULT_PATH)
    t.encode_special_tokens = True
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("remember", [250_000, 5])
def test_counts_follow_edits(plain, remember):
    encoder = bpe.Encoder(bpe.DEFAULT_PATH, remember=remember)

    @settings(max_examples=150, deadline=None)
    @given(TEXT, st.lists(EDIT, max_size=5))
    def run(text, edits):
        tree = token_counts.tree(text, encoder)
        for start, size, new in edits:
            tree.edit(start, start + size, new)
            text = text[:start] + new + text[start + size :] if start <= len(text) else text + new
            assert tree.text() == text
            assert tree.length == len(text) and tree.total == plain(text)

    run()


def test_an_edit_encodes_little_of_a_long_text(plain):
    text = "one two three four five. " * 20_000
    tree = token_counts.tree(text, bpe.Encoder(bpe.DEFAULT_PATH))
    tree.edit(250_000, 250_010, "something else")
    assert tree.encoded < 400
    assert tree.total == plain(tree.text())


def test_an_edit_over_many_leaves_copies_words_once(plain):
    copied = 0

    class Leaf(list):
        def __radd__(self, other):  # the words read so far, copied to put a leaf behind them
            nonlocal copied
            copied += len(other)
            return [*other, *self]

    tree = token_counts.tree("x y " * 20_000, bpe.Encoder(bpe.DEFAULT_PATH))
    tree.leaves = [Leaf(leaf) for leaf in tree.leaves]
    tree.edit(10, tree.length - 10, "short")
    assert copied < 100_000
    assert tree.total == plain(tree.text())


def test_short_words_need_no_trie(plain, monkeypatch):
    encoder = bpe.Encoder(bpe.DEFAULT_PATH)
    assert encoder.sizes.merged
    monkeypatch.setattr(bpe.Vocabulary, "encode_sorted", None)
    text = "It's 3.14 straße, 日本語 🎉🎉\n\n  unheardofwordiness <|endoftext|>\x1c" * 40 + " " * bpe.LONG
    tree = token_counts.tree(text, encoder)
    assert tree.total == plain(text)
    tree.edit(500, 900, "anotherlongishinventedword'll  \t")
    assert tree.total == plain(tree.text())


def test_long_words_and_words_known_again(plain):
    words = ["x" * bpe.LONG, "x" * (bpe.LONG + 1), " " + "ab" * 3000, "é" * 5000, "!" * 101, " one", "日本" * 60]
    sizes = bpe.Encoder(bpe.DEFAULT_PATH, remember=2).sizes
    for word in [*words, *words, *reversed(words)]:
        assert sizes[word] == plain(word) and len(sizes) <= 3


def test_merges_that_ranks_do_not_tell(tmp_path):
    """``abc`` is a token of the vocabulary, but its bytes encode as ``a`` and ``bc``."""
    alphabet = [c for c, _ in sorted(bpe._byte_alphabet().items(), key=lambda x: x[1])]
    merges = [("b", "c"), ("a", "b"), ("ab", "c")]
    vocab = {t: i for i, t in enumerate([*alphabet, *map("".join, merges)])}
    (tmp_path / "v.json").write_text(json.dumps({"added_tokens": [], "model": {"vocab": vocab, "merges": [list(m) for m in merges]}}))
    encoder = bpe.Encoder(str(tmp_path / "v.json"))
    assert not encoder.vocabulary.ranks_suffice() and encoder.sizes["abc"] == 2
    assert token_counts.tree("abc abc ab", encoder).total == 7


def test_counts_of_the_table(spark, plain):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for r in token_counts.count_edits(token_counts.usual_edits(docs)).collect():
        assert r.edited_tokens == plain(r.edited_text)
    rows = [(None, "a", None), (1, None, [(0, 0, "hi")]), (2, "", [(5, 9, None)]), (3, "x " * 50_000, [(None, 2, "y")]), (3, "z", [])]
    odd = spark.createDataFrame(rows, f"doc_id long, text string, edits {token_counts.EDITS}").withColumn("n_words", F.lit(1))
    assert {(r.doc_id, r.edited_tokens) for r in token_counts.count_edits(odd).collect()} >= {(None, 1), (1, 1), (2, 0), (3, 1)}
    assert token_counts.count_edits(odd.where("false")).count() == 0


# --- Pitman-Yor -------------------------------------------------------------------------------


def test_small_restaurants_are_seated_as_the_conditional_says():
    rng, d, theta, share, others = np.random.default_rng(5), 0.6, 1.5, 0.2, 3
    weights = {}

    def ways(c, t):  # weighted ways to seat, by the recursion over the last customer
        if c == t == 0:
            return 1.0
        if c == 0 or t == 0:
            return 0.0
        return ways(c - 1, t - 1) + (c - 1 - d * t) * ways(c - 1, t)

    for t in range(1, 6):
        weights[t] = ways(5, t) * share**t * math.prod(theta + d * (others + k) for k in range(t))
    total = sum(weights.values())
    n = 40_000
    got = hpylm.reseat(rng, np.full(n, 5), np.full(n, others), np.full(n, share), d, theta, hpylm.stirling(d))
    counts = Counter(got.tolist())
    for t, w in weights.items():
        assert abs(counts[t] / n - w / total) < 0.01


def test_busy_dishes_are_seated_like_single_customers():
    rng, d, theta, share, others, c = np.random.default_rng(6), 0.5, 1.0, 0.3, 10, 200
    got = hpylm.reseat(rng, np.full(3000, c), np.full(3000, others), np.full(3000, share), d, theta, hpylm.stirling(d))
    want = []
    for _ in range(600):
        t = 1
        for k in range(1, c):
            opening = (theta + d * (others + t)) * share
            t += rng.random() < opening / (k - d * t + opening)
        want.append(t)
    assert abs(got.mean() - np.mean(want)) < 0.05 * np.mean(want)


def plain_scores(rows):
    tokens = {i: [*(w.decode() for w in (t or "").encode().lower().split()), ""] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    c = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    return {
        i: (held[i], len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) for i, ws in tokens.items()
    }


def test_counts_base_and_gain_on_held_out_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = queries.language_model(spark, SF).collect()
    want = plain_scores([(r.doc_id, r.text) for r in docs.collect()])
    assert len(got) == len(want)
    for r in got:
        held, tokens, known, n, base = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, tokens, known, n)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score < 0
    for held in (True, False):
        assert sum(r.score for r in got if r.held_out == held) > sum(r.base_score for r in got if r.held_out == held)


def test_probabilities_of_a_context_add_up(spark):
    words = ["red", "blue", "green", "red"]
    train = [(i, " ".join(words[(i * k) % 4] for k in range(1, 12))) for i in range(200)]
    train = [(i, t) for i, t in train if not hpylm.held_out(i, 7, 2)]
    tests = [i for i in range(1000, 3000) if hpylm.held_out(i, 7, 2)][:4]
    probes = [*zip(tests, ["red", "blue", "green", "never"], strict=True)]
    empty = next(i for i in range(5000, 9000) if hpylm.held_out(i, 7, 2))
    rows = [*train, *probes, (empty, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.score for r in hpylm.PitmanYor(samples=1).score(docs).collect()}
    # From the start of a text: each word or its end; a text of one word also ends after it.
    assert 10 ** got[empty] < 1 and all(10 ** got[i] < 1 for i, _ in probes)
    firsts = [10 ** got[i] for i, _ in probes]
    assert firsts[0] > firsts[3] and sum(firsts) + 10 ** got[empty] < 1.05


def test_model_of_awkward_rows(spark):
    rows = [(None, "a b"), (1, None), (1, ""), (2, " \n "), (3, "w " * 30_000), (3, "w " * 30_000), (4, "é x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit(1)).withColumn("chunk", F.lit("x"))
    got = hpylm.PitmanYor().score(docs).collect()
    assert sorted(r.n_tokens for r in got) == [1, 1, 1, 2, 3, 30_001, 30_001]
    assert hpylm.PitmanYor().score(docs.where("false")).count() == 0
    (alone,) = hpylm.PitmanYor().score(docs.where("doc_id = 4")).collect()
    assert math.isfinite(alone.score)


def test_stored_trees_follow_later_edits(spark, tmp_path):
    """Trees that were written are edited twice; each time they equal fresh ones, and few words are encoded."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) > 2000").select("doc_id", "text")
    odd = spark.createDataFrame([(None, None), (1_000_001, ""), (1_000_002, "x" * 5000)], "doc_id long, text string")
    token_counts.trees(docs.unionByName(odd)).write.parquet(f"{tmp_path}/0")
    for n in (1, 2):
        stored = spark.read.parquet(f"{tmp_path}/{n - 1}")
        with_edits = stored.join(token_counts.usual_edits(stored).drop("text").withColumnRenamed("doc_id", "_id"), F.col("doc_id").eqNullSafe(F.col("_id"))).drop("_id")
        token_counts.edit_trees(with_edits).write.parquet(f"{tmp_path}/{n}")
        after = {r.doc_id: r for r in spark.read.parquet(f"{tmp_path}/{n}").collect()}
        want = {r.doc_id: r for r in token_counts.count_edits(token_counts.usual_edits(stored)).collect()}
        fresh = {r.doc_id: r for r in token_counts.trees(spark.read.parquet(f"{tmp_path}/{n}")).collect()}
        assert after.keys() == want.keys() == fresh.keys() and len(after) > 100
        for doc, r in after.items():
            assert r.text == want[doc].edited_text and r.n_tokens == want[doc].edited_tokens == fresh[doc].n_tokens == sum(r.leaf_tokens)
            assert r.word_chars == fresh[doc].word_chars and sum(r.leaf_words) == len(r.word_chars)
        assert sum(r.encoded_words for r in after.values()) < sum(len(r.word_chars) for r in after.values()) / 4
