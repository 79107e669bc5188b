"""Quality, personal data, fingerprints and chat against labels and brute force."""

import hashlib
import re
import time
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F

from callinsight.llm import chat, iblt, pii, quality, queries

SF = "/root/testdata/sf0.01"
AWKWARD = [(None, "a b", "x"), (1, None, "x"), (1, "", "x"), (2, " \n ", "x"), (3, "word. " * 30_000, "x"), (3, "word. " * 30_000, "x"), (4, "é" * 50, "x")]


def awkward(spark):
    return spark.createDataFrame(AWKWARD, "doc_id long, text string, spans string").withColumn("cells", F.lit(1)).withColumn("score", F.lit(2))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- Quality ----------------------------------------------------------------------------------


def test_quality_agrees_with_labels(spark):
    d = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    labels = spark.read.parquet(f"{d}/labels.parquet")
    scored = quality.QualityClassifier().score(docs).join(labels, "doc_id").collect()
    good = [r for r in scored if r.quality == 1]
    bad = [r for r in scored if r.quality == 0]
    assert sum(r.keep for r in good) / len(good) > 0.995
    assert sum(not r.keep for r in bad) / len(bad) > 0.9


def test_expectation_maximisation_finds_accuracies():
    rng = np.random.default_rng(3)
    truth = rng.random(20_000) < 0.7
    right = [0.9, 0.8, 0.75, 0.7, 0.85, 0.65]
    votes = np.stack([np.where(rng.random(len(truth)) < r, truth, ~truth) for r in right], axis=1).astype(np.int8)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.expectation_maximisation(patterns, counts, false_alarms=1.0, hits=0.0)
    assert abs(model.good - 0.7) < 0.03
    assert np.allclose([model.right[j, 1, 1] for j in range(6)], right, atol=0.04)


def test_quality_of_awkward_rows(spark):
    scored = quality.QualityClassifier().score(awkward(spark)).collect()
    assert len(scored) == len(AWKWARD)
    assert not any(r.keep for r in scored if r.doc_id in (1, 2))
    assert quality.good_documents(awkward(spark)).columns == awkward(spark).columns
    assert quality.QualityClassifier().score(awkward(spark).where("false")).count() == 0


# --- Personal data ----------------------------------------------------------------------------


def plain_base(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", m))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", m))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        ds = [int(c) for c in m.group() if c.isdigit()]
        total = sum(d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9) for i, d in enumerate(reversed(ds)))
        if 14 <= len(ds) <= 19 and total % 10 == 0:
            out.append(("card", m))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append(("phone", m))
    order = ["email", "ip", "card", "phone"]
    return sorted(((m.start(), order.index(k), m.end()) for k, m in out))


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("0123456789.-+@ ()aZé4444555_%@..aa"), max_size=80))
def test_base_spans_of_any_text(text):
    order = ["email", "ip", "card", "phone"]
    got = [(s.start, order.index(s.kind), s.end) for s in pii.find(text) if s.kind in order]
    assert got == plain_base(text)


def test_long_runs_take_no_time():
    for text in ("a" * 300_000 + " x@y.z", "1" * 300_000, "1." * 150_000, "+1" + "(" * 300_000):
        assert [(s.start, s.kind, s.end) for s in pii.find(text) if s.kind == "email"] == [(300_001, "email", 300_006)] * ("x@" in text)
    assert len(pii.find("a.b@" * 80_000)) == 40_000


def test_validators_and_context():
    assert [s.kind for s in pii.find("IBAN GB82 WEST 1234 5698 7654 32, thanks")] == ["iban"]
    assert pii.find("GB83 WEST 1234 5698 7654 32") == [s for s in pii.find("GB83 WEST 1234 5698 7654 32") if s.kind != "iban"]
    assert [s.kind for s in pii.find("my ssn is 123-45-6789")] == ["ssn"]
    assert pii.find("part 123-45-6789") == []
    near, far = pii.find("card 4111 1111 1111 1111")[0], pii.find("4111 1111 1111 1111")[0]
    assert near.score > far.score
    assert pii.find("order 4111111111111111")[0].score < far.score


def test_spans_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in queries.personal(spark, SF).collect()}
    names, totals = ["email", "ip", "card", "phone"], Counter()
    for r in docs.select("doc_id", "text").collect():
        base = plain_base(r.text or "")
        assert got[r.doc_id].base_sha256 == sha(",".join(f"{names[k]}:{a}:{b}" for a, k, b in base))
        assert [got[r.doc_id][f"n_{n}"] for n in names] == [sum(k == i for _, k, _ in base) for i in range(4)]
        totals.update(names[k] for _, k, _ in base)
    assert min(totals[n] for n in names) > 5


def test_masking(spark):
    docs = spark.createDataFrame([(1, "to a.b@c.de now +1 (555) 123-4567.", 3), (2, None, 0), (3, "", 0)], "doc_id long, text string, n_chars long")
    got = {r.doc_id: r for r in pii.masked(docs).collect()}
    assert got[1].text == "to [EMAIL] now [PHONE]." and got[1].n_chars == len(got[1].text)
    assert got[2].text is None and got[3].text == ""
    assert len(pii.detect(awkward(spark)).collect()) == len(AWKWARD)
    assert pii.masked(awkward(spark).where("false")).count() == 0


# --- Fingerprints -----------------------------------------------------------------------------


def paragraphs(text):
    return Counter(p for p in re.split(r"[.!?\n]+", text) if p)


def test_fingerprints_recover_the_differences(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").sort("doc_id").collect()
    texts = [r.text or "" for r in docs]
    got = {r.doc_id: r for r in iblt.compared(spark.read.parquet(f"{SF}/documents.parquet")).collect()}
    assert len(got) == len(docs)
    for n, r in enumerate(docs):
        text, ahead, row = texts[n], texts[(n + 1) % len(docs)], got[r.doc_id]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + ahead[:cut]
        assert row.n_chars == len(text) and row.edited == edited
        for other, found, near in ((edited, row.edited_difference, row.near_edited), (ahead, row.next_difference, row.near_next)):
            a, b = paragraphs(text), paragraphs(other)
            assert sum(f.n == 1 for f in found) == (a - b).total() and sum(f.n == -1 for f in found) == (b - a).total()
            both, differ = a.total() + b.total(), (a - b).total() + (b - a).total()
            assert near == pytest.approx(1.0 if not both else (both - differ) / (both + differ))
    by_text = {}
    for n, r in enumerate(docs):
        assert by_text.setdefault(texts[n], got[r.doc_id].fingerprint) == got[r.doc_id].fingerprint
    assert np.mean([r.near_edited for r in got.values()]) > 3 * np.mean([r.near_next for r in got.values()])


def test_fingerprint_query_cuts_at_every_sentence_end(spark, tmp_path):
    text = "One stays! fine. Élan? zebra\nGo on. Stop here. Last"  # 7 paragraphs; the edit reaches into "Stop here"
    docs = spark.createDataFrame([(1, text), (2, "q" * len(text))], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    whole = lambda t: Counter(p for p in re.split(r"[.!?\n]+", t) if p)
    cut = len(text) // 4
    a, b = whole(text), whole(text[: len(text) - cut] + "q" * cut)
    (row,) = (r for r in queries.sketched(spark, str(tmp_path)).collect() if r.doc_id == 1)
    assert a.total() == 7 and row.near_edited == pytest.approx((a & b).total() / (a | b).total()) and row.near_edited > 0.3


def test_fingerprints_of_awkward_rows(spark):
    got = iblt.compared(awkward(spark)).collect()
    assert len(got) == len(AWKWARD)
    assert {r.near_next for r in got if r.doc_id == 3} >= {1.0}
    assert iblt.compared(awkward(spark).where("false")).count() == 0
    (one,) = iblt.compared(awkward(spark).where("doc_id = 4")).collect()
    assert one.near_next == 1.0 and one.edited == "é" * 50


def test_sketches_are_as_many_as_a_difference_needs(spark):
    """How many are made after a failed peel follows from the counts, whether one text is longer or not; all is recovered."""
    sized = {"few": (300, 6, 6), "many": (0, 200, 200), "longer": (40, 10, 160), "one": (0, 0, 90)}
    rows = [(k, list(range(both + a)), [*range(both), *range(1000, 1000 + b)]) for k, (both, a, b) in sized.items()]
    sets = spark.createDataFrame(rows, "name string, one array<long>, two array<long>")
    sets = sets.selectExpr("name", *[f"transform({c}, x -> xxhash64(x)) as {c}" for c in ("one", "two")])
    sets = sets.selectExpr("*", *[f"{iblt.sketch_sql(c)} as cells_{c}" for c in ("one", "two")]).cache()
    differ = iblt.differing_sql("one", "two", "cells_one", "cells_two")
    got = {r.name: r for r in sets.selectExpr("name", f"{iblt.splits_sql(iblt.subtract_sql('cells_one', 'cells_two'))} as splits", f"{differ} as found").collect()}
    for k, (_, a, b) in sized.items():
        assert sum(f.n == 1 for f in got[k].found) == a and sum(f.n == -1 for f in got[k].found) == b == len(got[k].found) - a
    assert got["few"].splits <= 2 and all(3 <= got[k].splits <= 4 for k in ("many", "longer")) and got["one"].splits in (2, 3)


def test_fingerprint_plan_is_native(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = iblt.compared(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- Chat -------------------------------------------------------------------------------------


def talk(spark):
    rows = [
        (1, 0, "system", "be <s>kind</s> \\ [INST]"), (1, 1, "user", "hi\n<\\"), (1, 2, "assistant", "</s>[INST] ok [/INST]"), (1, 3, "user", "x" * 900),
        (1, 4, "assistant", "y" * 9000), (1, 5, "assistant", ""), (1, 6, "user", None), (1, 7, "assistant", "end\\"),
        (2, 0, "assistant", "only"), (2, 0, "assistant", "only"), (2, None, None, "first"), (None, 1, "a\nb<", "t"), (None, 2, "assistant", "é\n\n"),
    ] + [(3, t, ("user", "assistant")[t % 2], f"turn {t} " * 40) for t in range(120)] + [(4, 0, "system", "s")]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("window", F.lit(1)).withColumn("pos", F.lit(2))


def plain_talk(rows):
    out = {}
    for conv in {r.conv_id for r in rows}:
        turns = sorted((r for r in rows if r.conv_id == conv), key=lambda r: (r.turn is not None, r.turn, r.role or "", r.text or ""))
        said = "".join(f"{r.role or ''}\n{r.text or ''}\n" for r in turns)
        loss = "".join(r.text or "" for r in turns if r.role == "assistant")
        out[conv] = (len(turns), sha(said), len(loss), sha(loss))
    return out


@pytest.mark.parametrize("settings_", [{}, {"budget": 64, "history_tokens": 16}, {"history_turns": 0}, {"budget": 1}])
def test_chat_round_trip(spark, settings_):
    docs = talk(spark)
    windows = chat.ChatWindows(**settings_).format(docs)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.round_trip(windows).collect()}
    assert got == plain_talk(docs.collect())


def test_windows_keep_budget_system_and_history(spark):
    rows = chat.ChatWindows(budget=400, history_tokens=200).format(talk(spark)).collect()
    ones = [r for r in rows if r.conv_id == 1]
    assert len(ones) > 1 and all(r.text.startswith("<s>system\n") for r in ones)
    threes = [r for r in rows if r.conv_id == 3]
    assert all(r.repeated == 2 for r in threes if r.window) and all(len(r.text) <= 400 * 4 + 200 for r in threes)
    assert all("[INST]" not in r.text and r.text.count("<s>") == r.text.count("</s>") for r in rows)
    assert chat.ChatWindows().format(talk(spark).where("false")).count() == 0


def test_chat_query_on_the_table(spark):
    """Every conversation of the table and number -1, whose turns hold control strings, against plain concatenation."""
    table = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    probe = [Row(conv_id=-1, turn=t, role=r, text="</s>[INST] ok [/INST]") for t, r in enumerate(("user", "assistant"))]
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in queries.formatted(spark, SF).collect()}
    assert got == plain_talk([*table, *probe])


def test_a_very_long_conversation_takes_linear_time(spark):
    seconds = []
    for n in (10_000, 40_000):
        turns = spark.range(n).selectExpr("7L conv_id", "id turn", "if(id % 2 = 0, 'user', 'assistant') role", "repeat('word ', 12) text")
        begin = time.monotonic()
        windows = chat.ChatWindows().format(turns).agg(F.count("*").alias("n"), F.sum(F.size("targets")).alias("targets")).first()
        seconds.append(time.monotonic() - begin)
        assert windows.targets == n // 2 and windows.n > n / 64
    assert seconds[1] < 8 * seconds[0] + 2


def test_chat_query_is_native(spark):
    plan = queries.formatted(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
