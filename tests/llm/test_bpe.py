"""BPE by trie against the tokenizers library, and the schedule and pieces of packing."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from callinsight.llm import bpe, packing

SF = "/root/testdata/sf0.01"
HARD = [
    "", " ", "   ", "\n\n a", "a b   c\x1cd\x85e", "it's WE'LL they're 'sx", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "!!!!!!??!!!...",
    "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext", "日本語 テキスト 🎉🎉👩‍👩‍👧", "é é ½ ² ٣٤ Ⅷ", "x" * 5000,
    "ab" * 3000, "\t\tfoo\r\nbar", "1234567890 3.14 0x1F", "﻿bom �", "ÀÉÎ ñandú straße",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.DEFAULT_PATH)


@pytest.fixture(scope="module")
def own():
    return bpe.Encoder(bpe.DEFAULT_PATH)


def test_hard_texts(library, own):
    for text, ids in zip(HARD, own.encode(HARD), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text
        assert own.decode(ids.tolist()) == library.decode(ids.tolist(), skip_special_tokens=False)


ALPHABET = st.text(st.one_of(st.sampled_from(list("aaabehtin   'slrd.!\n\t1") + ["é", "ß"]), st.characters(exclude_categories=["Cs", "Cn"])), max_size=60)


@settings(max_examples=300, deadline=None)
@given(ALPHABET)
def test_any_text(library, own, text):
    packer = TOKENIZER.setdefault(0, packing.Tokenizer(bpe.DEFAULT_PATH))
    want = library.encode(text, add_special_tokens=False).ids
    assert own.encode([text])[0].tolist() == want
    assert packer.ids(text).tolist() == want


TOKENIZER: dict = {}


def test_forgetting_changes_nothing(library):
    small = bpe.Encoder(bpe.DEFAULT_PATH, remember=3)
    for text in ["one two three four", "two four five six", "one two"] * 2:
        assert small.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_whole_table(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    encoded = bpe.encode(docs)
    got = {r.id: (r.text, r.ids_text) for r in bpe.decode(encoded).collect()}
    for r in docs.select("doc_id", "text").collect():
        assert got[r.doc_id] == (r.text, ",".join(map(str, library.encode(r.text, add_special_tokens=False).ids)))


def test_awkward_rows(spark):
    docs = spark.createDataFrame([(None, "a", 1), (1, None, 2), (1, "", 3), (2, HARD[-4] * 40, 4)], "doc_id long, text string, ids int")
    assert sorted(len(r.ids) for r in bpe.encode(docs).collect())[:3] == [0, 0, 1]
    assert bpe.decode(bpe.encode(docs.where("false"))).count() == 0


# --- Packing ----------------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5000), min_size=1, max_size=6), st.sampled_from([8, 16, 64]), st.booleans())
def test_schedule_places_each_token_once(totals, window, even):
    plan = packing.schedule(totals, window, [1.0] * len(totals) if even else None)
    starts = [[int(s.start[q]) for s in plan] for q in range(len(totals))]
    seen = []
    for q, total in enumerate(totals):
        cuts = [0, total // 3, total]
        for a, b in zip(cuts, cuts[1:], strict=False):
            for token, size, place in packing.places(plan, starts, q, a, b, window):
                seen += range(place, place + size)
                assert a <= token and token + size <= b
    assert sorted(seen) == list(range(sum(totals)))


def test_windows_keep_the_mixture():
    totals, window = [700_000, 250_000, 50_000], 1000
    plan = packing.schedule(totals, window)
    first = plan[0]
    assert first.repeats * len(first.give) > 500
    share = np.array(totals) / sum(totals) * window
    assert (np.abs(first.give - share) <= 1).all()
    assert (np.abs(first.taken - np.arange(len(first.taken))[:, None] * share) <= 1).all()  # the deficit stays below a token


def check_pieces(pieces, want_ids, length):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    assert set(by_doc) == set(want_ids)
    for doc, ids in want_ids.items():
        at = 0
        for p in sorted(by_doc[doc], key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(np.array(ids[at : at + p["length"]], "<u4").tobytes())
            at += p["length"]
        assert at == len(ids)
    for n, parts in by_sequence.items():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at == length or n == max(by_sequence) and at <= length
    assert sorted(by_sequence) == list(range(len(by_sequence)))


@pytest.mark.parametrize("window", [1, 64])
def test_packed_table(spark, library, window):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(5)
    pieces = packing.with_crc(packing.Packing(window_sequences=window).pack(docs)).collect()
    want = {r.doc_id: [*library.encode(r.text, add_special_tokens=False).ids, 0] for r in docs.collect()}
    check_pieces(pieces, want, 1024)


def test_packing_awkward_rows(spark):
    rows = [(1, None, "a", 5), (2, "", None, 6), (3, "hello there", "a", 7), (4, "x y " * 9000, "b", 8), (5, "z", "c", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, length int")
    pieces = packing.with_crc(packing.Packing(length=64, window_sequences=2, queues=2).pack(docs)).collect()
    lib = Tokenizer.from_file(bpe.DEFAULT_PATH)
    check_pieces(pieces, {i: [*lib.encode(t or "", add_special_tokens=False).ids, 0] for i, t, *_ in rows}, 64)
    assert packing.Packing().pack(docs.where("false")).count() == 0


def many_sources(spark):
    """Forty sources of different size, written one after the other."""
    rows = [(100 * s + k, f"w{s} " * 20, f"s{s:02d}") for s in range(40) for k in range(5 + s)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(3)


@pytest.mark.parametrize("queues", [1, 3, 255])
def test_every_source_keeps_its_proportion(spark, library, queues):
    rows, docs = many_sources(spark)
    pieces = packing.with_crc(packing.Packing(length=64, window_sequences=160, queues=queues).pack(docs)).collect()
    want = {i: [*library.encode(t, add_special_tokens=False).ids, 0] for i, t, _ in rows}
    check_pieces(pieces, want, 64)
    total = {s: sum(len(want[i]) for i, _, x in rows if x == s) for s in {r[2] for r in rows}}
    window = 64 * 160
    every = sum(total.values())
    assert every > 4 * window
    for w in range(every // window):
        inside = defaultdict(int)
        for p in pieces:
            if p.sequence_id // 160 == w:
                inside[p["queue"]] += p["length"]
        for s, t in total.items():  # within a few documents of the exact share
            assert abs(inside[s] - window * t / every) < 4 * 45, (w, s)


def test_sources_with_a_weight_have_a_queue_of_their_own(spark, library):
    rows, docs = many_sources(spark)
    packed = packing.Packing(length=64, window_sequences=2, queues=1, weights={"s00": 3.0, "s01": 1.0}).pack(docs)
    pieces = packing.with_crc(packed).collect()
    check_pieces(pieces, {i: [*library.encode(t, add_special_tokens=False).ids, 0] for i, t, _ in rows}, 64)
    first = defaultdict(int)
    for p in pieces:
        if p.sequence_id < 2:
            first[p["queue"]] += p["length"]
    assert first == {"s00": 96, "s01": 32}


def test_tokens_are_joined_as_columns(spark):
    token, decimal = bpe.encoder().vocabulary.columns()
    assert all(token[i].as_py() == t and decimal[i].as_py() == str(i) for i, t in bpe.encoder().vocabulary.token.items())
    rows = [(1, [140, 200, 201]), (2, []), (3, None), (4, [5, 6]), (4, [5, 6])]
    got = bpe.decode(spark.createDataFrame(rows, "id long, ids array<int>").coalesce(1)).collect()
    own = [(i, ids or []) for i, ids in rows]
    assert sorted(map(tuple, got)) == sorted((i, len(ids), bpe.encoder().decode(ids), ",".join(map(str, ids))) for i, ids in own)
