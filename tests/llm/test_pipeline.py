"""The corpus pipeline stage by stage against brute force, and the registered SQL."""

from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
import oracle
from callinsight.llm import bpe, pii, quality, queries
from callinsight.llm.common import shared_folder
from test_bpe import check_pieces
from test_dedup import brute_components, exact_dedup_normal, plain_similar

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    """The table, and rows with NULLs, repeats, a long text and personal data."""
    table = spark.read.parquet(f"{SF}/documents.parquet")
    text = "A quiet river runs along the old stone wall of the town. It turns at the mill and goes on to the sea."
    rows = [(None, text + " No id here.", "en", None, 1), (9001, None, "en", "src1", 0), (9002, "", None, "src1", 0), (9003, text, "en", "src2", 7), (9003, text, "en", "src2", 7)]
    rows += [(9004, text + "  Write to a.b@example.org now.", "en", "src3", 9), (9005, (text + " ") * 3000, "en", "src4", 9), (9006, text.upper().replace(".", "!!"), "en", "x", 3)]
    return table.unionByName(spark.createDataFrame(rows, table.schema)).cache()


def test_every_stage(spark, docs):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "exact dedup", "near dedup", "personal data", "packing"]
    rows = lambda df: [(r.doc_id, r.text) for r in df.collect()]
    written = lambda name, df: corpus_pipeline.written(stages[name](spark, df, SF), "t")

    scored = quality.QualityClassifier().score(docs).collect()
    good = written("quality", docs)
    assert sorted(str(i) for i, _ in rows(good)) == sorted(str(r.doc_id) for r in scored if r.keep)
    assert {9003, 9004, None} <= {i for i, _ in rows(good)} and not {9001, 9002, 9006} & {i for i, _ in rows(good)}
    assert good.columns == docs.columns

    exact = written("exact dedup", good)
    firsts = {}
    for i, t in sorted(rows(good), key=lambda r: (r[0] is None, r[0])):
        firsts.setdefault(exact_dedup_normal(t), i)
    assert sorted(map(str, firsts.values())) == sorted(str(i) for i, _ in rows(exact))

    near = written("near dedup", exact)
    have = sorted(rows(exact), key=lambda r: (r[0] is None, r[0]))
    pairs = plain_similar([t or "" for _, t in have])
    components = brute_components(list(range(len(have))), lambda i, j: (i, j) in pairs)
    assert sorted(str(have[c][0]) for c in set(components)) == sorted(str(i) for i, _ in rows(near))

    clean = written("personal data", near)
    assert sorted(map(str, rows(clean))) == sorted(str((i, pii.mask(t, pii.find(t)))) for i, t in rows(near))
    assert all(r.n_chars == len(r.text) for r in clean.collect() if "[" in r.text)

    packed = written("packing", clean).collect()
    library = Tokenizer.from_file(bpe.DEFAULT_PATH)
    check_pieces(packed, {i: [*library.encode(t, add_special_tokens=False).ids, 0] for i, t in rows(clean)}, 1024)


def test_whole_run_and_empty_table(spark, tmp_path):
    done = corpus_pipeline.run(spark, SF)
    assert done.count() > 0 and "ids_crc32" in done.columns
    spark.read.parquet(f"{SF}/documents.parquet").where(F.lit(False)).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_sql(spark, name):
    assert oracle.compare(queries.queries()[name](spark, SF), oracle.connect(SF), queries.oracle_sql()[name]) is None


def test_every_operator_is_registered():
    numbers = defaultdict(list)
    for name in queries.queries():
        numbers[int(name[2:].split("_")[0])].append(name)
    assert sorted(numbers) == list(range(1, 14)) and all(len(v) == 1 for v in numbers.values())


CLASHING = "doc_id long, text string, _id string, `_digest` string, __id int, `a.b` string, source string"


@pytest.mark.parametrize("stage", ["exact dedup", "near dedup"])
@pytest.mark.parametrize("parts", [1, 3, 5])
def test_stages_keep_columns_of_any_name_and_decide_repeated_rows(spark, stage, parts):
    """Columns called as internal ones come back untouched; of rows equal in id and text the least by all columns stays."""
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, f"keep-me-{s}", f"d{s}", s, f"dot{s}", f"src{s}") for s in (5, 3, 4)]
    rows += [(None, text + " tail", "x", "y", 1, "z", "n"), (2, "other words", "keep-me-2", "d", 0, "q", "s"), (2, "other words", "keep-me-1", "d", 0, "q", "s")]
    docs = spark.createDataFrame(rows, CLASHING).repartition(parts)
    got = sorted(tuple(r) for r in dict(corpus_pipeline.STAGES)[stage](spark, docs, SF).collect() if r.doc_id is not None)
    assert got == [rows[1], rows[5]]


def test_stages_leave_few_tables(spark, docs, tmp_path):
    """What a stage makes on its way is gone once its decision is written."""
    root = Path(shared_folder(spark, "probe").removeprefix("file:").rpartition("/")[0])
    listed = lambda: set(root.iterdir()) if root.exists() else set()
    before = listed()
    for name in ("exact dedup", "near dedup"):
        dict(corpus_pipeline.STAGES)[name](spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
    left = {p.name.rsplit("-", 1)[0] for p in listed() - before}
    assert left == {"touched", "stay", "dedup-state"}
