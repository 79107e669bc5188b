"""Statements that must hold on any data, checked on the derived tables."""

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from callinsight.operators import frame, outcomes, quality, timeline, turns, updates
from callinsight.sources import star

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("gold"))
    frame.dashboard_frame(star.calls(spark, SF_DIR), star.clients(spark, SF_DIR)).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("chart", [outcomes.upsales, outcomes.concerns])
def test_shares_and_counts(gold, chart):
    per_agent = chart(gold, "comparison").groupBy("Agent ID").agg(F.sum("share").alias("s"), F.sum("counts").alias("n"))
    assert per_agent.filter("abs(s - 1) > 1e-9").count() == 0
    total = chart(gold).agg(F.sum("counts")).first()[0]
    assert per_agent.agg(F.sum("n")).first()[0] == total
    known = (
        gold.dropna(subset=["Upsale Attempted", "Upsale Success"])
        if chart is outcomes.upsales
        else gold.dropna(subset=["Concern Addressed"])
    )
    assert total == known.count()


def test_months_cover_all_calls(gold):
    assert timeline.calls_over_time(gold).agg(F.sum("calls")).first()[0] == gold.count()


def test_boxes_are_ordered(gold):
    box = quality.score_distribution(gold, "comparison")
    order = ["minimum", "lower_fence", "q1", "median", "q3", "upper_fence", "maximum"]
    wrong = " or ".join(f"{a} > {b}" for a, b in zip(order, order[1:]))
    assert box.filter(wrong).count() == 0


def test_turns_keep_every_word(spark):
    texts = star.transcripts(spark, SF_DIR)
    words = lambda df: df.agg(F.sum(F.regexp_count("text", F.lit(r"\S+")))).first()[0]
    split = turns.split_turns(texts)
    labels = split.filter("speaker is not null").count()
    assert words(split) + labels == words(texts)


KEYS = st.sampled_from(["a", "b", "c", None])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(KEYS, min_size=1, max_size=8), st.lists(st.tuples(KEYS, st.sampled_from(["x", "y", None])), max_size=8))
def test_update_matches_a_row_by_row_update(spark, keys, changes):
    """Statements run one after another, as a bulk UPDATE executes them."""
    table = pd.DataFrame({"call_id": [str(i) for i in range(len(keys))], "audio_file": keys, "topic": "old", "status": None})
    for key, topic in changes:
        hit = table["audio_file"].map(lambda k: k is not None and k == key)
        table.loc[hit, "topic"], table.loc[hit, "status"] = topic, "Transcribed"
    calls = spark.createDataFrame([(str(i), k, "old", None) for i, k in enumerate(keys)], "call_id string, audio_file string, topic string, status string")
    data = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(changes)], "audio_file string, topic string, seq int")
    got = updates.update_calls(calls, data, "Transcribed", "audio_file", "audio_file", order_by="seq")
    want = {(r.call_id, r.topic if isinstance(r.topic, str) else None, r.status if isinstance(r.status, str) else None) for r in table.itertuples()}
    assert {(r.call_id, r.topic, r.status) for r in got.collect()} == want
