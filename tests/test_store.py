"""Snapshots, their manifest, and updates that rewrite the days they reach."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from callinsight import schemas as S
from callinsight.operators import updates
from callinsight.sources import star
from callinsight.sources.manifest import ConcurrentChange, Manifest
from callinsight.sources.store import CallStore

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def store(spark, tmp_path):
    made = CallStore(spark, str(tmp_path / "tables"), period="month")
    made.create_tables()
    return made


def filled(spark, store):
    store.insert_clients(star.clients(spark, SF_DIR))
    store.insert_agents(star.agents(spark, SF_DIR))
    store.insert_calls(star.new_calls(spark, SF_DIR))
    return store


def counts(store):
    return store.get_clients().count(), store.get_agents().count(), store.get_calls().count()


def test_another_session_sees_the_tables(spark, store):
    filled(spark, store)
    assert counts(CallStore(spark.newSession(), store.root)) == (150, 10, 1500)


def test_a_failure_before_the_switch_changes_nothing(spark, store, monkeypatch):
    filled(spark, store)

    def fails(*_, **__):
        raise OSError("lost the driver")

    with monkeypatch.context() as m:
        m.setattr(Manifest, "commit", fails)
        for change in (
            lambda: store.insert_clients(star.clients(spark, SF_DIR).limit(3)),
            lambda: store.insert_agents(star.agents(spark, SF_DIR).limit(3)),
            lambda: store.insert_calls(star.new_calls(spark, SF_DIR).limit(3)),
            lambda: store.append_people(spark.createDataFrame([("n", "f", "l")], S.AGENT.fieldNames()), spark.createDataFrame([("n",)], ["client_id"])),
            lambda: store.update_calls("Analyzed", "call_id", "call_id", spark.createDataFrame([("7",)], "call_id string")),
            store.recreate_tables,
        ):
            with pytest.raises(OSError, match="lost"):
                change()
            assert counts(CallStore(spark.newSession(), store.root)) == (150, 10, 1500)
    assert store.get_calls().filter("status is not null").count() == 0
    assert os.listdir(f"{store.root}/_work") == []


def test_a_failing_write_changes_nothing(spark, store):
    filled(spark, store)
    broken = star.clients(spark, SF_DIR).withColumn("email", F.raise_error(F.lit("bad input")).cast("string"))
    with pytest.raises(Exception, match="bad input"):
        store.insert_clients(broken)
    assert counts(store) == (150, 10, 1500)


def test_people_and_calls_switch_in_one_version(spark, store):
    filled(spark, store)
    before = store.manifest.read()
    store.insert_clients(star.clients(spark, SF_DIR).limit(5))
    after = store.manifest.read()
    assert after.number == before.number + 1
    assert after.tables["call"] == {} and len(after.tables["client"]) == 1 and after.tables["agent"] == before.tables["agent"]
    assert store.manifest.at(before.number) == before


def test_two_writers_from_one_version(spark, store):
    base = store.manifest.read()
    store.manifest.commit(base, {"agent": {}})
    with pytest.raises(ConcurrentChange):
        store.manifest.commit(base, {"client": {}})
    assert store.manifest.read().number == base.number + 1
    assert not [n for n in os.listdir(f"{store.root}/_versions") if n.endswith(".part")]


@pytest.mark.parametrize("period", ["day", "month"])
def test_an_update_rewrites_only_its_periods(spark, tmp_path, period):
    """A hundred updates of calls of one day rewrite the folder of that day, or month, alone."""
    store = CallStore(spark, str(tmp_path / "tables"), period=period)
    calls = star.new_calls(spark, SF_DIR).withColumn("date", F.date_add(F.lit(dt.date(2024, 3, 28)), F.pmod(F.crc32("call_id"), F.lit(9)).cast("int")))
    store.insert_calls(calls)
    (first,) = store.manifest.read().tables["call"]
    before = {r.call_id: r.asDict() for r in store.get_calls().collect()}
    day = dt.date(2024, 3, 30)
    ids = sorted(i for i, r in before.items() if r["date"] == day)[:100]
    name = f"date={day}" if period == "day" else "month=2024-03"
    files = set(os.listdir(f"{store.root}/call/{first}"))
    store.update_calls("Speech diarized", "call_id", "call_id", spark.createDataFrame([(i,) for i in ids], "call_id string"))
    tables = store.manifest.read().tables["call"]
    (second,) = set(tables) - {first}
    folders = lambda names: {n for n in names if "=" in n}
    assert folders(os.listdir(f"{store.root}/call/{second}")) == {name}
    assert set(tables[first]) == {n.partition("=")[2] for n in folders(files) - {name}}
    assert set(os.listdir(f"{store.root}/call/{first}")) == files  # untouched
    after = {r.call_id: r.asDict() for r in CallStore(spark.newSession(), store.root).get_calls().collect()}
    assert after == {i: {**r, "status": "Speech diarized"} if i in ids else r for i, r in before.items()}
    # Folders that are not read are no input of the scan.
    partial = store._read("call", store.manifest.read(), [name.partition("=")[2]])
    partial.collect()
    scanned = partial.select(F.input_file_name()).distinct().collect()
    assert all(f"/{name}/" in r[0] and second in r[0] for r in scanned) and scanned
    plan = partial._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    # An update that reaches nothing makes no snapshot.
    store.update_calls("Analyzed", "call_id", "call_id", spark.createDataFrame([("none",)], "call_id string"))
    assert store.manifest.read().tables["call"] == tables


def test_a_store_keeps_its_period(spark, store):
    filled(spark, store)
    again = CallStore(spark, store.root, period="day")
    again.update_calls("Created", "call_id", "call_id", spark.createDataFrame([("7",)], "call_id string"))
    assert again.get_calls().count() == 1500 and again.manifest.read().period == "month"
    with pytest.raises(ValueError):
        CallStore(spark, store.root, period="week")


def test_many_updates_on_one_day_and_over_days_equal_one_plan(spark, store):
    filled(spark, store)
    plain = star.new_calls(spark, SF_DIR)
    for n, status in enumerate(["Speech diarized", "Transcribed", "Analyzed"]):
        data = plain.filter(F.abs(F.xxhash64("call_id")) % 5 <= n).select("call_id", F.lit(f"topic {n}").alias("topic"))
        store.update_calls(status, "call_id", "call_id", data)
        plain = updates.update_calls(plain, data, status, "call_id", "call_id")
    have, want = store.get_calls(), plain.select(store.get_calls().columns)
    assert have.exceptAll(want).count() == 0 and want.exceptAll(have).count() == 0


def test_an_update_may_move_a_call_to_another_day(spark, store):
    filled(spark, store)
    call = store.get_calls().orderBy("date", "call_id").first()
    target = store.get_calls().select(F.max("date")).first()[0]
    both = store.get_calls().filter(F.col("date") == target).count()
    store.update_calls("Created", "call_id", "call_id", spark.createDataFrame([(call.call_id, target)], "call_id string, date date"))
    assert store.get_calls().count() == 1500
    assert store.get_calls().filter(F.col("date") == target).count() == both + 1
    store.update_calls("Created", "call_id", "call_id", spark.createDataFrame([(call.call_id, dt.date(1990, 1, 1))], "call_id string, date date"))
    assert [r.call_id for r in store.get_calls().filter("date = '1990-01-01'").collect()] == [call.call_id]


def test_the_chain_in_the_store_equals_the_plan(spark, store):
    filled(spark, store)
    steps = dict(star.step_outputs(spark, SF_DIR))
    steps.pop("answered")
    store.apply_chain(steps)
    want = updates.apply_chain(star.new_calls(spark, SF_DIR), steps)
    assert store.get_calls().exceptAll(want).count() == 0 and store.get_calls().count() == want.count()


def test_rules_hold_for_updates(spark, store):
    filled(spark, store)
    for values, kind in (((None,), "string"), (("x" * 51,), "string")):
        column = "client_id" if values[0] is None else "topic"
        data = spark.createDataFrame([("7", *values)], f"call_id string, {column} {kind}")
        with pytest.raises(ValueError, match=f"of {column}"):
            store.update_calls("Analyzed", "call_id", "call_id", data)
    with pytest.raises(ValueError, match="not a unique key"):
        store.update_calls("Analyzed", "client_id", "old", spark.createDataFrame([(store.get_calls().first().client_id, "same")], "old string, call_id string"))
    assert store.get_calls().filter("status is not null").count() == 0


def test_rules_hold_for_inserts(spark, store):
    for broken, rule in (
        (star.new_calls(spark, SF_DIR).withColumn("status", F.lit("Lost")), "domain of status"),
        (star.new_calls(spark, SF_DIR).withColumn("audio_file", F.lit(None).cast("string")), "not null of audio_file"),
        (star.new_calls(spark, SF_DIR).withColumn("date", F.lit(None).cast("date")), "not null of date"),
    ):
        with pytest.raises(ValueError, match=rule):
            store.insert_calls(broken)
    assert store.get_calls().count() == 0


def test_an_insert_scans_its_data_once(spark, store):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    calls = star.new_calls(spark, SF_DIR)
    store.insert_calls(calls.mapInArrow(counted, calls.schema))
    assert seen.value == 1500


def test_appended_people(spark, store):
    filled(spark, store)
    old = store.manifest.read().tables["agent"]
    new_agent = spark.createDataFrame([("A-new", "N", "N")], "agent_id string, first_name string, last_name string")
    new_client = spark.createDataFrame([("C-new", "N")], "client_id string, first_name string")
    store.append_people(new_agent, new_client)
    assert counts(store) == (151, 11, 1500)
    assert set(old) < set(store.manifest.read().tables["agent"])  # nothing is written again
    for agent, client in ((new_agent, new_client.withColumn("client_id", F.lit("C2"))), (new_agent.withColumn("agent_id", F.lit("A2")), new_client)):
        with pytest.raises(ValueError, match="not a unique key"):
            store.append_people(agent, client)
    with pytest.raises(ValueError, match="length of first_name"):
        store.append_people(new_agent.withColumns({"agent_id": F.lit("A3"), "first_name": F.lit("x" * 31)}), new_client.limit(0))
    assert counts(store) == (151, 11, 1500)


def test_a_repeated_batch_is_skipped(spark, store):
    filled(spark, store)
    data = lambda topic: spark.createDataFrame([("7", topic)], "call_id string, topic string")
    update = lambda topic, n, stream="s": store.apply_updates([(data(topic), "Created", "call_id", "call_id")], batch=(stream, n))
    assert update("one", 0) and not update("two", 0) and update("three", 1) and not update("four", 0)
    assert store.get_calls().filter("call_id = '7'").first().topic == "three"
    assert update("other", 0, "another stream")


def test_many_snapshots_are_joined_again(spark, store, monkeypatch):
    monkeypatch.setattr("callinsight.sources.store.MAX_SNAPSHOTS", 3)
    filled(spark, store)
    ids = [r.call_id for r in store.get_calls().orderBy("date", "call_id").limit(200).collect()]
    for i in ids[::40]:
        store.update_calls("Created", "call_id", "call_id", spark.createDataFrame([(i,)], "call_id string"))
        assert len(store.manifest.read().tables["call"]) <= 3
    assert store.get_calls().count() == 1500 and store.get_calls().filter("status = 'Created'").count() == 5


def test_old_versions_can_be_removed(spark, store):
    filled(spark, store)
    store.update_calls("Created", "call_id", "call_id", spark.createDataFrame([("7",)], "call_id string"))
    store.insert_calls(star.new_calls(spark, SF_DIR))
    gone = store.forget_old_versions(keep=1)
    assert len([g for g in gone if g.startswith("call/")]) == 2
    assert counts(store) == (150, 10, 1500) and len(os.listdir(f"{store.root}/call")) == 1


def test_views(spark, store):
    filled(spark, store)
    store.register_views()
    assert spark.sql("SELECT count(*) FROM callinsight_call JOIN callinsight_client USING (client_id)").first()[0] == 1500
