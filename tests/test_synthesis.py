import datetime as dt

from pyspark.sql import functions as F

from callinsight import schemas as S
from callinsight.operators import synthesis


def test_dense_index(spark):
    people = spark.range(1000).selectExpr("concat('p', id) key").repartition(7)
    got = synthesis.with_dense_index(people, "key")
    index = {r.key: r._index for r in got.collect()}
    assert sorted(index.values()) == list(range(1000))
    again = {r.key: r._index for r in synthesis.with_dense_index(people.repartition(3), "key").collect()}
    assert index == again


def test_people(spark):
    clients = synthesis.synthetic_clients(spark.range(500))
    assert clients.columns == S.CLIENT.fieldNames()
    rows = clients.collect()
    assert len({r.client_id for r in rows}) == len({r.email for r in rows}) == 500
    assert all(r.client_id.isdigit() and len(r.client_id) >= 8 and r.client_id[0] != "0" for r in rows)
    places = {c: (la, lo) for c, la, lo in synthesis.CITIES}
    assert all(places[r.client_city] == (r.latitude, r.longitude) for r in rows)
    agents = synthesis.synthetic_agents(spark.range(20), "es")
    assert agents.columns == S.AGENT.fieldNames()
    assert {r.first_name for r in agents.collect()} <= set(synthesis.FIRST_NAMES["es"])


def make(spark, n=400, **settings):
    agents, clients = synthesis.synthetic_agents(spark.range(7)), synthesis.synthetic_clients(spark.range(50))
    return synthesis.synthetic_calls(spark.range(n), agents, clients, synthesis.CallSettings(**settings))


def test_calls(spark):
    calls = make(spark, from_date="01.30.2024", to_date="02.02.2024", from_time="22:00", to_time="02:00").cache()
    assert synthesis.metadata(calls).columns == S.METADATA.fieldNames()
    truths = synthesis.ground_truths(calls)
    assert truths.columns == S.GROUND_TRUTHS.fieldNames()
    assert [f.dataType for f in truths.schema] == [f.dataType for f in S.GROUND_TRUTHS]
    rows = calls.collect()
    assert len({r.call_id for r in rows}) == 400
    assert {r.date for r in rows} == {dt.date(2024, 1, 30) + dt.timedelta(days=i) for i in range(4)}
    assert all(r.time >= "22:00:00" or r.time <= "02:00:00" for r in rows)
    assert {(r.agent_tries_upsale, r.agent_succeeds_upsale) for r in rows} == {(False, False), (True, False), (True, True)}
    assert all(1 <= r[c] <= 5 for r in rows for c in S.SCORE_COLUMNS)
    assert {r.topic for r in rows} == set(S.TOPICS)
    assert len({r.agent_id for r in rows}) == 7
    assert all(r.text_file == f"{r.call_id}.txt" for r in rows)


def test_ids_are_under_their_own_names(spark):
    # agents number 10000000..10000006, clients up to 10000049
    calls = make(spark)
    assert calls.filter(F.col("agent_id").cast("int") > 10000006).count() == 0
    assert calls.filter(F.col("client_id").cast("int") > 10000006).count() > 0


def test_prompt(spark):
    clients = {r.client_id: r for r in synthesis.synthetic_clients(spark.range(50)).collect()}
    for r in make(spark, 20, min_minutes=1, max_minutes=3).collect():
        client = clients[r.client_id]
        assert f"{client.first_name} {client.last_name} (e-mail {client.email}, phone {client.phone_number})" in r.prompt
        assert "use 240 to 720 words" in r.prompt and r.topic in r.prompt
        assert "{" not in r.prompt


def test_repeatable_under_any_partitioning(spark):
    agents, clients = synthesis.synthetic_agents(spark.range(7)), synthesis.synthetic_clients(spark.range(50))
    one = synthesis.synthetic_calls(spark.range(0, 200, 1, 2), agents, clients)
    other = synthesis.synthetic_calls(spark.range(0, 200, 1, 5), agents.repartition(3), clients.repartition(6))
    assert one.exceptAll(other).count() == 0
