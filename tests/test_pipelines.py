"""Generation, analysis, dashboard and incremental runs end to end on small batches."""

import re

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callinsight import schemas as S
from callinsight.operators import answers, indicators, reconcile
from callinsight.operators.synthesis import CallSettings
from callinsight.plans import analysis, dashboard, generation, rollup
from callinsight.sources import files
from callinsight.sources.store import CallStore
from callinsight.streaming import incremental


@pytest.fixture
def store(spark, tmp_path):
    made = CallStore(spark, str(tmp_path / "tables"), period="month")
    made.create_tables()
    return made


def model(batch: pd.DataFrame) -> pd.DataFrame:
    """Stands in for question answering: refuses one text and answers another incompletely."""
    if batch["text_file"].str.startswith("refused").any():
        raise RuntimeError("refused")
    first = "1. billing discrepancies\n2. A summary.\n3. Yes.\n4. Neutral\n5. Positive"
    first = ["1. too short" if f.startswith("short") else first for f in batch["text_file"]]
    polls = [f"1. Yes\n2. No\n3. {x}\n4. 5\n5. 4\n6. 5\n7. 4\n8. 3" for x in (2, 4, 4)]
    return pd.DataFrame({"block_1": first, **{p: [t] * len(batch) for p, t in zip(analysis.POLLS, polls)}})


def made_calls(spark, store, tmp_path, n=12):
    out = generation.generate(store, n, 6, 3, str(tmp_path / "gen"), CallSettings(from_date="01.01.2024", to_date="03.31.2024"))
    audio = out.metadata.select("text_file", F.concat("call_id", F.lit(".wav")).alias("audio_file"))
    return out, generation.create_batch(out.metadata, audio, str(tmp_path / "gen"))


def test_generation(spark, store, tmp_path):
    out, batch = made_calls(spark, store, tmp_path)
    assert store.get_clients().count() == 6 and store.get_agents().count() == 3
    assert out.metadata.count() == out.ground_truths.count() == out.prompts.count() == 12
    assert batch.columns == S.CALLS_BATCH.fieldNames() and batch.count() == 12
    again = generation.generate(store, 4, 0, 0, str(tmp_path / "more"), generate_clients_and_agents=False)
    assert again.metadata.count() == 4 and store.get_clients().count() == 6


def transcripts_of(spark, store, batch):
    """One transcript per call that names both speakers; odd ones break in some step."""
    people = batch.join(store.get_clients().select("client_id", "first_name", "last_name", "phone_number"), "client_id")
    text = F.concat(F.lit("Agent: Hello "), "first_name", F.lit(" "), "last_name", F.lit("\nClient: call 555-123-4567"))
    n = F.row_number().over(__import__("pyspark").sql.Window.orderBy("call_id"))
    named = people.withColumn("n", n)
    prefix = F.when(F.col("n") == 3, "refused_").when(F.col("n") == 4, "short_").otherwise("")
    return named.filter("n > 1").select(
        "audio_file",
        F.concat(prefix, "call_id", F.lit(".txt")).alias("transcription_file"),
        F.when(F.col("n") == 2, None).otherwise(text).alias("text"),
    )


@pytest.mark.parametrize("show_progress", [False, True])
def test_analysis(spark, store, tmp_path, show_progress):
    _, batch = made_calls(spark, store, tmp_path)
    texts = transcripts_of(spark, store, batch)
    out = analysis.analyze(store, texts, model, str(tmp_path / "run"), batch, show_progress=show_progress)
    status = {r.status: r["count"] for r in store.get_calls().groupBy("status").count().collect()}
    # one call without transcript and one without text, two whose answers failed, eight done
    assert status == {None: 2, "Anonymized": 2, "Analyzed": 8}
    done = store.get_calls().filter("status = 'Analyzed'").collect()
    assert all(r.empathy == 4 and r.upsale_attempted and not r.upsale_success and r.concern_addressed for r in done)
    assert all(r.topic == "billing discrepancies" and r.agent_tone == "Positive" for r in done)
    text = out.anonymized.filter("error is null").first().text
    assert text == "Agent: Hello John Doe\nClient: call 123456789"
    errors = {re.sub(r"_.*", "", r.text_file): r.error for r in spark.read.parquet(f"{tmp_path}/run/answers_errors").collect()}
    assert errors == {"refused": "RuntimeError: refused", "short": "block 1 incomplete"}
    assert spark.read.parquet(f"{tmp_path}/run/anonymized_errors").count() == 1
    for step in ("diarization", "transcription"):
        assert [r.error for r in spark.read.parquet(f"{tmp_path}/run/{step}_errors").collect()] in (["no speaker turn"], ["no text"])
    assert out.turns.groupBy("call_id").count().filter("count = 2").count() == 10


def test_dashboard(spark, store, tmp_path):
    _, batch = made_calls(spark, store, tmp_path)
    analysis.analyze(store, transcripts_of(spark, store, batch), model, str(tmp_path / "run"), batch)
    df = dashboard.build(store.get_calls(), store.get_clients(), str(tmp_path / "gold"))
    assert df.schema == S.DASHBOARD and df.count() == 12
    figures = dashboard.summary_page(df, {"Client Tone": ["Neutral"]})
    assert {r.kpi: r.value for r in figures["kpis"].collect()}["Number of Calls"] == 8.0
    for name, figure in figures.items():
        assert figure.count() > 0, name
    grid = dashboard.transcripts_page(df)
    anonymized = spark.read.parquet(f"{tmp_path}/run/anonymized").select(F.col("anonymized_file").alias("text_file"), "text")
    recordings = batch.select("audio_file", F.concat(F.lit("/rec/"), "audio_file").alias("path"))
    view = dashboard.transcript(grid, anonymized, recordings)
    shown = view.filter("transcript is not null")
    assert shown.count() == 10
    assert shown.first().transcript == "**Agent**: Hello John Doe  \n**Client**: call 123456789"


def test_filters_reach_the_scan(spark, store, tmp_path):
    _, batch = made_calls(spark, store, tmp_path)
    store.insert_calls(batch)
    df = dashboard.build(store.get_calls(), store.get_clients(), str(tmp_path / "gold"))
    plan = dashboard.summary_page(df, {"Effective Communication": (2, 4)})["concerns_donut_comparison"]
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(`Effective Communication`,2)" in text
    assert "ReadSchema: struct<Agent ID:string,Concern Addressed:boolean,Effective Communication:int>" in text


def test_incremental_updates(spark, store, tmp_path):
    _, batch = made_calls(spark, store, tmp_path)
    store.insert_calls(batch)
    ids = [r.call_id for r in batch.orderBy("call_id").collect()]
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    schema = T.StructType([T.StructField("call_id", T.StringType())])

    def arrive(some):
        spark.createDataFrame([(i,) for i in some], schema).coalesce(1).write.mode("append").parquet(folder)
        incremental.follow_updates(store, folder, schema, checkpoint, "Speech diarized", "call_id", "call_id").awaitTermination()
        return store.get_calls().filter("status = 'Speech diarized'").count()

    assert arrive(ids[:3]) == 3
    assert arrive(ids[3:5]) == 5
    assert store.get_calls().count() == 12


def test_incremental_analysis(spark, store, tmp_path):
    _, batch = made_calls(spark, store, tmp_path)
    store.insert_calls(batch)
    ids = [r.call_id for r in batch.orderBy("call_id").collect()]
    folder = tmp_path / "texts"

    def arrive(some):
        df = spark.createDataFrame([(f"{i}.txt", "Agent: hi\nClient: bye") for i in some], "text_file string, text string")
        files.export_transcript_files(df, str(folder))
        incremental.follow_transcripts(store, str(folder), model, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        return store.get_calls().filter("status = 'Analyzed'").count()

    assert arrive(ids[:2]) == 2
    assert arrive(ids[2:7]) == 7


def test_odd_recordings_never_end_a_run(spark, store, tmp_path):
    """Two texts of one recording, a text of no call, a recording of two calls, a call without text."""
    _, batch = made_calls(spark, store, tmp_path, 4)
    rows = sorted(batch.collect(), key=lambda r: r.call_id)
    shared = rows[0].audio_file
    batch = spark.createDataFrame([{**r.asDict(), "audio_file": shared if i == 1 else r.audio_file} for i, r in enumerate(rows)], batch.schema)
    people = {r.client_id: r for r in store.get_clients().collect()}
    names = " ".join(f"{people[r.client_id].first_name} {people[r.client_id].last_name}" for r in rows[:2])
    texts = [(shared, "a.txt", "Agent: old"), (shared, "b.txt", f"Agent: hi {names}"), ("stray.wav", "c.txt", "Agent: x"), (rows[2].audio_file, "d.txt", "Agent: y")]
    texts = spark.createDataFrame(texts, "audio_file string, transcription_file string, text string")
    out = analysis.analyze(store, texts, model, str(tmp_path / "run"), batch)
    errors = spark.read.parquet(f"{tmp_path}/run/transcription_errors").collect()
    assert sorted((r.audio_file, r.error) for r in errors) == sorted(
        [(shared, "a later text of the recording is used"), ("stray.wav", "no call has this recording")]
    )
    assert [r.call_id for r in spark.read.parquet(f"{tmp_path}/run/missing_transcripts").collect()] == [rows[3].call_id]
    assert out.answers.count() == 2 and texts.count() == out.anonymized.count() + len(errors)
    (masked,) = out.anonymized.filter("original_file = 'b.txt'").collect()
    assert all(people[r.client_id].first_name not in masked.text for r in rows[:2])
    assert store.get_calls().filter("status = 'Analyzed'").count() == 3


def short_model(batch: pd.DataFrame) -> pd.DataFrame:
    """Answers a block of three questions, asked twice."""
    assert batch["prompt_1"].str.startswith("Q: 1. What?").all()
    return pd.DataFrame({"one": ["1. billing\n2. maybe\n3. 4"] * len(batch), "two": ["1. billing\n2. no\n3. 2"] * len(batch)})


def test_analysis_with_questions_of_ones_own(spark, store, tmp_path):
    _, batch = made_calls(spark, store, tmp_path)
    block = answers.Block(["topic", "mood", "empathy"], ["What?", "Mood?", "1 to 5?"], ["one", "two"], "Q: {questions} T: {text}")
    texts = transcripts_of(spark, store, batch)
    out = analysis.analyze(store, texts, None, str(tmp_path / "run"), batch, blocks=[block], make_model=lambda: short_model)
    assert out.answers.columns == ["text_file", "topic", "mood", "empathy"] and out.answers.count() == 10
    assert {(r.topic, r.mood, r.empathy) for r in out.answers.collect()} == {("billing", "maybe", 4)}
    done = store.get_calls().filter("status = 'Analyzed'")
    assert done.count() == 10 and {(r.topic, r.empathy, r.kindness) for r in done.collect()} == {("billing", 4, None)}


def test_every_input_is_accounted_for(spark, store, tmp_path):
    """Inputs of a run are its results plus its errors: calls without a recording name, texts without one, equal copies."""
    _, batch = made_calls(spark, store, tmp_path, 6)
    rows = sorted(batch.collect(), key=lambda r: r.call_id)
    store.insert_calls(batch)
    a, b, c, d, e, _ = (r.audio_file for r in rows)
    given = [(a, "1.txt", "Agent: x"), (a, "1.txt", "Agent: x"), (a, "1.txt", "Agent: x"), (b, "2.txt", None), (b, "2.txt", None), (c, "3.txt", "Agent: old"), (c, "4.txt", "Agent: new")]
    given += [(None, "5.txt", "lost"), (None, "6.txt", None), ("stray.wav", "7.txt", "x"), ("stray.wav", "7.txt", "x"), (d, None, "Agent: no name"), (e, "8.txt", "")]
    texts = spark.createDataFrame(given, "audio_file string, transcription_file string, text string").repartition(3)
    inventory = batch.select("audio_file").filter(F.col("audio_file") != rows[5].audio_file)
    out = analysis.analyze(store, texts, model, str(tmp_path / "run"), insert_calls=False, recordings=inventory)
    errors = [(r.audio_file, r.transcription_file, r.error) for r in spark.read.parquet(f"{tmp_path}/run/transcription_errors").collect()]
    later, stray = "a later text of the recording is used", "no call has this recording"
    assert sorted(errors, key=str) == sorted(
        [(a, "1.txt", later)] * 2 + [(b, "2.txt", "no text"), (b, "2.txt", later), (c, "3.txt", later), (None, "5.txt", "no recording named"), (None, "6.txt", "no recording named")]
        + [("stray.wav", "7.txt", stray)] * 2, key=str
    )
    used = out.anonymized.filter("error is null")
    assert used.count() + len(errors) == len(given)
    missing = {r.call_id: r.error for r in spark.read.parquet(f"{tmp_path}/run/missing_transcripts").collect()}
    assert missing == {rows[5].call_id: "no such recording"}
    counted = {(r.input, r.outcome): r.rows for r in reconcile.accounted(store.get_calls(), texts, inventory).collect()}
    assert sum(n for (kind, _), n in counted.items() if kind == "text") == len(given)
    assert sum(n for (kind, _), n in counted.items() if kind == "call") == 6 and counted["recording", "used"] == 5
    assert counted["text", "used"] == used.count() == 4


def test_outputs_of_one_detection(spark, store, tmp_path):
    _, batch = made_calls(spark, store, tmp_path)
    out = analysis.analyze(store, transcripts_of(spark, store, batch), model, str(tmp_path / "run"), batch)
    assert {r.entity for r in out.pii_report.collect()} == {"PERSON", "PHONE"}
    html = out.highlighted.filter("html is not null").first().html
    assert html.startswith('Agent: Hello <mark class="PERSON">') and '<mark class="PHONE">555-123-4567</mark>' in html
    assert out.spans.count() == out.pii_report.agg(F.sum("findings")).first()[0] == 20


def test_a_delivery_is_applied_once(spark, store, tmp_path):
    _, batch = made_calls(spark, store, tmp_path)
    store.insert_calls(batch)
    texts = transcripts_of(spark, store, batch)
    run = lambda n: analysis.analyze(store, texts, model, str(tmp_path / f"run{n}"), insert_calls=False, delivery=("s", 0))
    run(0)
    before = store.manifest.read()
    run(1)
    assert store.manifest.read() == before


def test_rollup(spark, store, tmp_path):
    _, batch = made_calls(spark, store, tmp_path, 40)
    analysis.analyze(store, transcripts_of(spark, store, batch), model, str(tmp_path / "run"), batch)
    df = dashboard.build(store.get_calls(), store.get_clients(), str(tmp_path / "gold"))
    totals = rollup.build(df, str(tmp_path / "totals"))
    assert {r.kpi: r.value for r in rollup.kpis(totals).collect()} == {r.kpi: r.value for r in indicators.kpis(df).collect()}
    days = [r[0] for r in df.select("Call Date").distinct().orderBy("Call Date").collect()]
    some = df.filter(F.col("Call Date") <= days[3])
    assert {r.kpi: r.value for r in rollup.kpis(rollup.between(totals, last=days[3])).collect()} == {r.kpi: r.value for r in indicators.kpis(some).collect()}
    # A day that is written again replaces its own totals only.
    rollup.build(df.filter(F.col("Call Date") == days[0]).limit(0).unionByName(df.filter(F.col("Call Date") == days[1])), str(tmp_path / "totals"))
    totals = rollup.load(spark, str(tmp_path / "totals"))
    assert totals.agg(F.sum("rows")).first()[0] == 40
    for figure in rollup.page(totals).values():
        assert figure.count() > 0


def test_caller_sketches_keep_their_error_bound(spark):
    rows = spark.range(0, 200_000, 1, 4).selectExpr("date_add(date'2024-01-01', cast(id % 20 as int)) d", "concat('A', id % 7) a", "cast(id % 50000 as string) c")
    df = rows.select(F.col("d").alias("Call Date"), F.col("a").alias("Agent ID"), F.col("c").alias("Caller ID"), *[F.lit(None).cast("boolean").alias(c) for c in ("Upsale Attempted", "Upsale Success", "Concern Addressed")], *[F.lit(1).alias(m) for m in S.QUALITY_METRICS])
    (callers,) = [r.value for r in rollup.kpis(rollup.rollup(df)).collect() if r.kpi == "Number of Callers"]
    assert abs(callers / 50_000 - 1) < 4 * rollup.ERROR


def test_example_data_travel(spark, store, tmp_path):
    """Export of a generated batch and its import into another store, in one call each."""
    out, batch = made_calls(spark, store, tmp_path)
    audio = out.metadata.select("text_file", F.concat("call_id", F.lit(".wav")).alias("audio_file"))
    texts = out.metadata.select("text_file", F.concat(F.lit("Agent: "), "call_id").alias("text"))
    example = generation.Example(out.metadata, out.ground_truths, audio, batch, texts, audio.select("audio_file"))
    generation.export_example(store, example, f"{tmp_path}/example", "es")
    other = CallStore(spark, str(tmp_path / "other"))
    back = generation.import_example(other, f"{tmp_path}/example", "es")
    for name in ("metadata", "ground_truths", "dataframe", "calls_batch", "conversations", "recordings"):
        have, want = getattr(back, name), getattr(example, name)
        assert have.count() == want.count() == 12 and have.select(want.columns).exceptAll(want).count() == 0, name
    assert other.get_clients().exceptAll(store.get_clients()).count() == 0 and other.get_clients().count() == 6
    assert other.get_agents().count() == 3 and other.get_calls().count() == 0
    other.insert_calls(back.calls_batch)
    assert other.get_calls().count() == 12


def test_bundled_people_without_details(spark, tmp_path):
    import json

    for kind, key in (("agents", "agent_id"), ("clients", "client_id")):
        people = [{"first_name": f"F{i}", "last_name": "L", "phone_number": "1", "email": "e", key: str(i)} for i in range(10)]
        (tmp_path / f"en_{kind}.json").write_text(json.dumps(people, indent=2))
    for name, schema in S.DATASETS.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/en_{name}.parquet")
    store = CallStore(spark, str(tmp_path / "tables"))
    example = generation.import_example(store, str(tmp_path))
    assert store.get_clients().count() == 10 and store.get_clients().filter("client_city is null").count() == 10
    assert example.conversations is None and example.calls_batch.count() == 0
