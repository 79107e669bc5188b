"""Physical plans: shuffles per chart, joins, and skewed keys without broadcast."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from callinsight.operators import frame, indicators, locations, outcomes, quality, reconcile, relations, timeline, updates
from callinsight.sources import star

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("gold"))
    frame.dashboard_frame(star.calls(spark, SF_DIR), star.clients(spark, SF_DIR)).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    """Exchanges of the plan, the final ordering of the small result left out."""
    return len(re.findall(r"Exchange (?:hash|Single)", plan(df)))


@pytest.mark.parametrize(
    "chart, expected",
    [
        (lambda f: outcomes.upsales(f, "comparison"), 1),
        (lambda f: outcomes.upsales(f), 1),
        (lambda f: outcomes.concerns(f, "comparison"), 1),
        (lambda f: quality.quality(f, "comparison"), 1),
        (lambda f: quality.quality(f), 2),  # agents, then all
        (lambda f: quality.score_distribution(f, "comparison"), 2),  # histogram, then agents
        (lambda f: timeline.calls_over_time(f), 1),
        (lambda f: timeline.upsales_vs_concerns(f), 1),
    ],
)
def test_shuffles(gold, chart, expected):
    assert exchanges(chart(gold)) == expected


def test_charts_read_only_their_columns(gold):
    text = plan(outcomes.concerns(gold, "comparison"))
    assert "ReadSchema: struct<Agent ID:string,Concern Addressed:boolean>" in text


def test_locations_scan_the_calls_once(gold):
    df = locations.call_locations(gold)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan(df) or final.count("FileScan") == 1


def test_no_cross_joins_or_python(spark):
    import __spark_entry__ as registry

    for name, query in registry.call_queries().items():
        text = plan(query(spark, SF_DIR))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "MapInPandas"):
            assert bad not in text, (name, bad)


def test_small_clients_are_broadcast_and_large_ones_are_not(spark):
    df = frame.dashboard_frame(star.calls(spark, SF_DIR), star.clients(spark, SF_DIR))
    assert "BroadcastHashJoin" in plan(df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(df.select("*")) and "BroadcastHashJoin" not in plan(df.select("*"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_person_is_split(spark):
    """A third of the calls belong to one agent; without broadcast AQE splits that partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        calls = spark.range(0, 60000, 1, 8).selectExpr(
            "cast(id as string) call_id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE cast(id % 997 as string) END agent_id", "date'2024-01-01' date", "'09:00:00' time"
        )
        people = spark.range(1000).selectExpr("cast(id as string) agent_id", "'f' first_name", "'l' last_name").unionByName(
            spark.createDataFrame([("hot", "f", "l")], "agent_id string, first_name string, last_name string")
        )
        df = relations.calls_of(people, calls, "agent_id")
        rows = df.collect()
        assert len(rows) == 60000 + sum(1 for r in rows if r.call_id is None)
        assert {r.agent_id for r in rows if r.call_id is None} == {"997", "998", "999"}
        assert sum(r.agent_id == "hot" for r in rows) == 20000
        assert "skew" in plan(df)
    finally:
        for k in settings:
            spark.conf.unset(k)


@pytest.mark.parametrize("order_by", [None, "seq"])
def test_hot_update_key_is_split(spark, order_by):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        calls = spark.range(0, 60000, 1, 8).selectExpr(
            "cast(id as string) call_id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE cast(id % 997 as string) END audio_file", "cast(null as string) status", "'t' topic"
        )
        new = spark.range(900).selectExpr("IF(id = 0, 'hot', cast(id as string)) audio_file", "'new' topic", "1 seq")
        df = updates.update_calls(calls, new if order_by else new.drop("seq"), "Transcribed", "audio_file", "audio_file", order_by)
        assert df.count() == 60000 and df.filter("topic = 'new'").count() > 20000
        df.collect()
        assert "skew" in plan(df)
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_chain_shuffles_the_call_table_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(updates.apply_chain(star.new_calls(spark, SF_DIR).withColumn("summary", F.lit("wide")), dict(star.step_outputs(spark, SF_DIR))))
        wide = [line for line in text.splitlines() if "Exchange" in line or "SortMergeJoin" in line]
        assert sum("SortMergeJoin" in line for line in wide) == 5
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_kpis_fold_agents_and_callers_apart(gold):
    text = plan(indicators.kpis(gold))
    scans = re.findall(r"ReadSchema: struct<(.*?)>", text)
    assert "Expand" not in text
    assert sorted(map(len, (s.split(",") for s in scans))) == [1, 4] and "Caller ID:string" in scans


@pytest.mark.parametrize("mode", ["average", "comparison"])
def test_quantiles_have_no_window_without_a_key(gold, mode):
    text = plan(quality.value_distribution(gold, mode))
    assert "SinglePartition" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


HOT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
}


def test_a_hot_recording_is_split(spark):
    """A third of all calls and of all texts name one recording, another third none."""
    for k, v in HOT.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 60_000, 1, 8)
        name = "CASE id % 3 WHEN 0 THEN 'hot.wav' WHEN 1 THEN concat(id % 997, '.wav') END audio_file"
        calls = rows.selectExpr("cast(id as string) call_id", name)
        texts = rows.selectExpr(name, "concat(id, '.txt') transcription_file", "concat('text ', id) text")
        found = reconcile.by_recording(calls, texts)
        of_calls = reconcile.call_outcomes(calls, found)
        assert {r.outcome: r["count"] for r in of_calls.groupBy("outcome").count().collect()} == {"has a text": 40_000, "no recording named": 20_000}
        of_texts = reconcile.text_outcomes(texts, found)
        used = of_texts.filter("outcome = 'used'").collect()
        assert len(used) == 998 and {r.transcription_file for r in used if r.audio_file == "hot.wav"} == {"9999.txt"}
        for df in (of_calls, of_texts):
            df.collect()
            assert "skew=true" in plan(df)
    finally:
        for k in HOT:
            spark.conf.unset(k)


def test_a_poll_answer_is_one_draw_on_its_row(spark):
    from callinsight.sources import star

    plan = star.poll_answers(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 1


DELIVERED = [("a", "1", "x"), ("a", "1", "x"), ("a", "0", "y"), ("b", "2", None), ("b", "2", None), ("c", None, "x"), ("s", "7", "x"), ("s", "7", "x"), ("s", "6", "x")]
DELIVERED += [(None, "8", "x"), (None, None, None), ("d", "9", "\x00"), ("d", "9", None), ("a", None, "z"), ("c", None, "x")]


def test_counts_and_errors_need_no_join_by_recording(spark):
    """A recording with many texts or calls meets nothing in one task; counts and errors are those of the outcomes."""
    texts = spark.createDataFrame(DELIVERED, "audio_file string, transcription_file string, text string").repartition(3)
    calls = spark.createDataFrame([("1", "a"), ("2", "a"), ("3", "b"), ("4", None), ("5", "c"), ("6", "d"), ("7", "e"), ("8", "gone")], "call_id string, audio_file string")
    inventory = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), ("d",), ("e",), ("x",), (None,)], "audio_file string")
    found = reconcile.by_recording(calls, texts, inventory)
    errors = reconcile.text_errors(texts, found)
    listed = lambda df: Counter(map(tuple, df.collect()))
    assert listed(errors) == listed(reconcile.errors_of_texts(reconcile.text_outcomes(texts, found)))
    counted = {(r.input, r.outcome): r.rows for r in reconcile.accounted(calls, texts, inventory).collect()}
    of_calls = Counter(r.outcome for r in reconcile.call_outcomes(calls, found, True).collect())
    assert {o: n for (kind, o), n in counted.items() if kind == "call"} == of_calls
    of_texts = Counter(r.error for r in errors.collect())
    assert {o: n for (kind, o), n in counted.items() if kind == "text" and o != "used"} == of_texts
    assert counted["text", "used"] == len(DELIVERED) - of_texts.total() == 2
    assert {o: n for (kind, o), n in counted.items() if kind == "recording"} == {"used": 6, "no call has this recording": 1, "no recording named": 1}
    assert "Join" not in reconcile.accounted(calls, texts, inventory)._jdf.queryExecution().optimizedPlan().toString()
    joined = errors._jdf.queryExecution().optimizedPlan().toString()
    assert joined.count("Join") == 1 and "digest" in joined.split("Join")[1].splitlines()[0]


def test_many_orders_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(star, "ROWS", 100)
    rows = star.table.__wrapped__(spark, "/root/testdata/sf0.001", "orders")
    assert rows.rdd.getNumPartitions() == -(-rows.count() // 100) > 10
