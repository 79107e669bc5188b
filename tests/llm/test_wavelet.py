"""Wavelet matrix shards against the tokenizers library and plain arrays."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from callinsight.llm import queries, wavelet

SF = "/root/testdata/sf0.01"
HARD = [
    "", " ", "\n\t\x0b\x0c\r", "it's WE'LL they're 'sx 'S", "ONE, two.. three!!! (four) <five>", "<|endoftext|> a<|endoftext|>b x<|startoftext|>.", "<|endoftext",
    "İ. İstanbul!! Σς. straße, ǅ. ﬁ; K.", "é. ä́, ́ .́ ≮", "日本語 テキスト。 🎉🎉!", "a b c\x85d\x1ce", "½ ² ٣٤ Ⅷ 2023, 3.14 0x1F", "don't. rock'n'roll'", "x" * 5000, "-- - _ _a_ a_b.",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(wavelet.DEFAULT_PATH)


@pytest.fixture(scope="module")
def own():
    return wavelet.Tokenizer(wavelet.DEFAULT_PATH, remember=50)


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, wavelet.END]


def test_hard_texts(library, own):
    ids, sizes = own.encode(pa.array(HARD))
    for text, got in zip(HARD, np.split(ids, np.cumsum(sizes)[:-1]), strict=True):
        assert got.tolist() == ids_of(library, text), text


ALPHABET = st.text(st.one_of(st.sampled_from(list("aaBehtin   'slrd.!,<|>\n\t1") + ["é", "ß", "İ", "́"]), st.characters(exclude_categories=["Cs", "Cn"])), max_size=50)


@settings(max_examples=300, deadline=None)
@given(st.lists(ALPHABET, min_size=1, max_size=4))
def test_any_text(library, own, texts):
    ids, sizes = own.encode(pa.array(texts))
    assert [g.tolist() for g in np.split(ids, np.cumsum(sizes)[:-1])] == [ids_of(library, t) for t in texts]


@pytest.mark.parametrize("n, distinct, block", [(0, 1, 64), (1, 1, 64), (300, 1, 64), (1000, 2, 64), (5000, 300, 512), (70_001, 70_001, 1 << 16)])
def test_one_shard(monkeypatch, n, distinct, block):
    monkeypatch.setattr(wavelet, "BLOCK", block)
    rng = np.random.default_rng(n)
    tokens = (rng.integers(0, distinct, n) ** 2 // max(1, distinct)).astype(np.uint32) * 3
    cut = np.sort(rng.integers(0, n + 1, 7))
    sizes = np.diff(np.concatenate(([0], cut, [n])))
    shard = wavelet.Shard(wavelet.build(tokens, np.arange(8) * 5, sizes))
    assert (shard.decode() == tokens).all() and shard.sizes.tolist() == sizes.tolist() and shard.doc_ids.tolist() == (np.arange(8) * 5).tolist()
    for i in rng.integers(0, n, min(n, 60)):
        token = int(tokens[i])
        places = np.flatnonzero(tokens == token)
        assert shard.access(i) == token
        assert shard.rank(token, int(i)) == int((tokens[:i] == token).sum())
        assert shard.count(token, int(i) // 2, int(i)) == int((tokens[i // 2 : i] == token).sum())
        assert shard.locate(token).tolist() == places.tolist()
        k = int(rng.integers(0, len(places)))
        assert shard.select(token, k) == places[k]
    assert shard.count(1) == 0 and shard.locate(1).size == 0  # no token
    with pytest.raises(IndexError):
        shard.access(n)
    with pytest.raises(IndexError):
        shard.select(int(tokens[0]) if n else 0, n)


def test_planes_are_compressed():
    tokens = np.minimum(np.random.default_rng(0).geometric(0.02, 400_000), 40_000).astype(np.uint32)
    assert len(wavelet.build(tokens, np.array([1]), np.array([len(tokens)]))) < 1.2 * len(tokens)


def test_whole_table(spark, library):
    texts = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    want, start = [], 0
    for doc, text in texts:
        ids = np.array(ids_of(library, text), "<u4")
        want.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = sorted(tuple(r) for r in queries.queries()["op11_wavelet_shards"](spark, SF).collect())
    assert got == want


def test_small_shards_count_and_locate(spark, library, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(200).repartition(5)
    shards = wavelet.WaveletShards(shard_tokens=5_000)
    manifest = shards.write(docs, f"file://{tmp_path}/shards")
    assert manifest.count() > 5
    rows = {r.doc_id: np.frombuffer(r.ids, "<u4") for r in shards.read(manifest).collect()}
    want = {r.doc_id: np.array(ids_of(library, r.text)) for r in docs.collect()}
    assert rows.keys() == want.keys() and all((rows[d] == want[d]).all() for d in want)
    tokens = np.concatenate(list(want.values()))
    common = int(np.bincount(tokens).argsort()[-3])
    counted = {r.token: r.occurrences for r in shards.count(manifest, [common, 2, 7]).collect()}
    assert counted == {t: int((tokens == t).sum()) for t in (common, 2, 7)}
    places = sorted(tuple(r) for r in shards.locate(manifest, common).collect())
    assert places == sorted((d, int(p)) for d, ids in want.items() for p in np.flatnonzero(ids == common))


def test_awkward_rows(spark, library):
    rows = [(None, "a b", "x"), (None, "c", "x"), (1, None, "x"), (1, "", "x"), (1, "", "x"), (2, " \n ", "x"), (3, "word. " * 30_000, "x"), (3, "word. " * 30_000, "x"), (-4, "é" * 50, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").withColumn("start", F.lit(2)).withColumn("mix", F.lit("m"))
    shards = wavelet.WaveletShards(shard_tokens=100)
    got = sorted(shards.read(shards.write(docs)).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [-4, 1, 1, 1, 2, 3, 3, None, None]
    assert [r.start for r in got] == [sum(g.n_tokens for g in got[:k]) for k in range(len(got))]
    assert sorted(bytes(r.ids) for r in got) == sorted(np.array(ids_of(library, t), "<u4").tobytes() for _, t, _ in rows)
    assert shards.read(shards.write(docs.where("false"))).count() == 0
