import pytest

from callinsight import schemas as S
from callinsight.operators import answers, integrity, relations, updates
from callinsight.sources import star

CALL = "call_id string, audio_file string, topic string, empathy int, status string"


def calls(spark):
    return spark.createDataFrame(
        [("1", "a.wav", "old", 1, None), ("2", "a.wav", "old", 2, None), ("3", "b.wav", "old", 3, "Created"), ("4", None, "old", 4, None)], CALL
    )


def test_rules(spark, rows):
    new = spark.createDataFrame([("a.wav", "new"), ("b.wav", None), ("zzz.wav", "lost"), (None, "null key")], "file string, topic string")
    got = updates.update_calls(calls(spark), new, "Transcribed", "audio_file", "file")
    assert got.columns == calls(spark).columns
    assert rows(got) == [
        ("1", "a.wav", "new", 1, "Transcribed"),
        ("2", "a.wav", "new", 2, "Transcribed"),
        ("3", "b.wav", None, 3, "Transcribed"),
        ("4", None, "old", 4, None),
    ]


def test_status_only(spark, rows):
    new = spark.createDataFrame([("1",), ("3",)], "call_id string")
    got = updates.update_calls(calls(spark), new, "Speech diarized", "call_id", "call_id")
    assert rows(got, "call_id", "status") == [("1", "Speech diarized"), ("2", None), ("3", "Speech diarized"), ("4", None)]


def test_last_duplicate_wins(spark, rows):
    new = spark.createDataFrame([("1", "first", 1), ("1", None, 3), ("1", "second", 2)], "call_id string, topic string, seq int")
    got = updates.update_calls(calls(spark), new, "Analyzed", "call_id", "call_id", order_by="seq")
    assert rows(got, "call_id", "topic")[0] == ("1", None)


def test_duplicates_without_order_fail(spark):
    new = spark.createDataFrame([("1", "x"), ("1", "y")], "call_id string, topic string")
    with pytest.raises(Exception, match="several updates for call_id 1"):
        updates.update_calls(calls(spark), new, "Analyzed", "call_id", "call_id").collect()


def test_duplicates_never_multiply_calls(spark):
    new = spark.createDataFrame([("1", "x"), ("1", "y")], "call_id string, topic string")
    try:
        assert updates.update_calls(calls(spark), new, "Analyzed", "call_id", "call_id").count() == 4
    except Exception as e:
        assert "several updates" in str(e)


def test_equal_order_values_have_one_winner(spark, rows):
    new = [("1", "x", 1), ("1", "y", 1), ("1", None, 1), ("1", "z", 0)]
    for data in (new, new[::-1]):
        df = spark.createDataFrame(data, "call_id string, topic string, seq int").repartition(3)
        got = updates.update_calls(calls(spark), df, "Analyzed", "call_id", "call_id", order_by="seq")
        assert rows(got, "call_id", "topic")[0] == ("1", "y")


def test_bad_arguments(spark):
    new = spark.createDataFrame([("1", "x")], "call_id string, mood string")
    with pytest.raises(ValueError, match="mood"):
        updates.update_calls(calls(spark), new, "Analyzed", "call_id", "call_id")
    with pytest.raises(ValueError, match="not a call status"):
        updates.update_calls(calls(spark), new.drop("mood"), "Done", "call_id", "call_id")


def test_update_can_set_its_own_key_column(spark, rows):
    new = spark.createDataFrame([("b.wav", "c.wav")], "old_file string, audio_file string")
    got = updates.update_calls(calls(spark), new, "Transcribed", "audio_file", "old_file")
    assert ("3", "c.wav") in rows(got, "call_id", "audio_file")


def test_hot_and_null_keys_keep_every_call(spark):
    many = spark.range(3000).selectExpr(
        "cast(id as string) call_id", "CASE id % 3 WHEN 0 THEN 'hot.wav' WHEN 1 THEN NULL ELSE concat(id, '.wav') END audio_file", "'old' topic", "1 empathy", "cast(null as string) status"
    )
    new = spark.createDataFrame([("hot.wav", "new")], "audio_file string, topic string")
    got = updates.update_calls(many, new, "Transcribed", "audio_file", "audio_file")
    assert got.count() == 3000
    assert got.filter("topic = 'new' and status = 'Transcribed'").count() == 1000


def test_integrity(spark):
    client = spark.createDataFrame([("c1", "x" * 31, "b")], "client_id string, first_name string, last_name string")
    agent = spark.createDataFrame([("a1", "f", "l"), ("a1", "f", "l")], "agent_id string, first_name string, last_name string")
    call = spark.createDataFrame(
        [("1", "c1", "a1", "Created"), ("2", "c9", "a1", "Nope"), ("3", "c9", None, None)], "call_id string, client_id string, agent_id string, status string"
    )
    report = {(r.table_name, r.rule, r.column_name): r.violations for r in integrity.integrity_report({"client": client, "agent": agent, "call": call}).collect()}
    assert report[("client", "length", "first_name")] == 1
    assert report[("client", "not null", "client_city")] == 1  # a column the input lacks
    assert report[("agent", "primary key", "agent_id")] == 1
    assert report[("call", "foreign key", "client_id")] == 2
    assert report[("call", "foreign key", "agent_id")] == 0
    assert report[("call", "not null", "agent_id")] == 1
    assert report[("call", "domain", "status")] == 1
    good, bad = integrity.quarantine(call, client, agent.distinct())
    assert [r.call_id for r in good.collect()] == ["1"]
    assert sorted(r.call_id for r in bad.collect()) == ["2", "3"]


def test_batch_join(spark, rows):
    conversations = spark.createDataFrame([("1", "1.txt"), ("2", "2.txt"), ("3", "3.txt"), (None, "4.txt")], "call_id string, text_file string")
    audio = spark.createDataFrame([("1.txt", "1.wav"), ("2.txt", "2a.wav"), ("2.txt", "2b.wav"), ("4.txt", "4.wav"), ("9.txt", "9.wav")], "text_file string, audio_file string")
    got = relations.create_batch_for_analysis(conversations, audio)
    assert got.columns == ["call_id", "audio_file"]
    assert rows(got) == [("1", "1.wav"), ("2", "2a.wav"), ("2", "2b.wav")]


def test_calls_of_people(spark, rows):
    people = spark.createDataFrame([("a", "A", "B"), ("b", "C", "D")], "agent_id string, first_name string, last_name string")
    call = spark.createDataFrame([("1", "a", None, None), ("2", "a", None, None)], "call_id string, agent_id string, date date, time string")
    assert rows(relations.calls_of(people, call, "agent_id"), "agent_id", "call_id") == [("a", "1"), ("a", "2"), ("b", None)]
    assert rows(relations.call_totals(people, call, "agent_id"), "agent_id", "calls") == [("a", 2), ("b", 0)]


def test_chain_keeps_every_call(spark):
    d = "/root/testdata/sf0.001"
    steps = dict(star.step_outputs(spark, d))
    steps["answered"] = answers.postprocess_answers(steps["answered"])
    before = star.new_calls(spark, d)
    after = updates.apply_chain(before, steps)
    assert after.count() == before.count()
    assert {r[0] for r in after.select("status").distinct().collect()} <= {None, *S.CALL_STATUSES}
