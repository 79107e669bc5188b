import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from callinsight import schemas as S
from callinsight.operators import frame
from callinsight.sources import files, star
from callinsight.sources.store import CallStore

SF_DIR = "/root/testdata/sf0.001"


def test_people_json(spark, tmp_path):
    people = [{"first_name": f"F{i}", "last_name": "L", "phone_number": "1", "email": "e", "client_id": str(i)} for i in range(10)]
    (tmp_path / "en_clients.json").write_text(json.dumps(people, indent=2))
    df = files.read_people_json(spark, str(tmp_path), "clients", "en")
    assert df.columns == S.CLIENT.fieldNames()
    assert df.count() == 10
    assert df.filter("client_city is null").count() == 10  # the file has no such field


def test_datasets(spark, tmp_path):
    audio = spark.createDataFrame([("1.txt", "1.wav", 3.5)], "text_file string, audio_file string, length double")
    audio.write.parquet(f"{tmp_path}/es_dataframe.parquet")
    assert files.read_dataset(spark, str(tmp_path), "dataframe", "es").columns == ["text_file", "audio_file"]
    out = files.write_dataset(audio, f"{tmp_path}/steps/audio")
    assert out.collect() == audio.collect()
    files.export_datasets(spark, {"text_to_audio/dataframe": f"{tmp_path}/steps/audio"}, f"{tmp_path}/example_data")
    assert spark.read.parquet(f"{tmp_path}/example_data/text_to_audio/dataframe").count() == 1


def test_errors(spark, tmp_path):
    df = spark.createDataFrame([("1", 1, None), ("2", None, "broken")], "text_file string, n int, error string")
    files.write_errors(df, ["text_file"], f"{tmp_path}/errors")
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_path}/errors").collect()] == [("2", "broken")]


def test_transcript_files(spark, tmp_path):
    text = "Agent: a\n\nClient: é\r\nend"
    df = spark.createDataFrame([("1.txt", text), ("2.txt", ""), ("3.txt", None)], "text_file string, text string")
    files.export_transcript_files(df, str(tmp_path / "texts"))
    back = {r.text_file: r.text for r in files.read_transcripts(spark, str(tmp_path / "texts")).collect()}
    assert back["1.txt"] == text
    assert "3.txt" not in back
    by_day = df.withColumn("date", F.lit(dt.date(2024, 1, 2)))
    files.write_transcripts(by_day, f"{tmp_path}/parquet")
    assert spark.read.parquet(f"{tmp_path}/parquet").filter("date = '2024-01-02'").count() == 3
    files.write_transcripts(df, f"{tmp_path}/flat")
    assert spark.read.parquet(f"{tmp_path}/flat").count() == 3


def test_transcript_files_in_a_store_of_another_scheme(spark, tmp_path):
    root = str(tmp_path)

    def mount(uri):
        import pyarrow.fs

        scheme, _, path = uri.partition("://")
        assert scheme == "mounted"
        return pyarrow.fs.SubTreeFileSystem(root, pyarrow.fs.LocalFileSystem()), path

    df = spark.createDataFrame([(f"{n}.txt", f"text {n}\r\n") for n in range(20)], "text_file string, text string").repartition(3)
    for _ in range(2):  # a repetition leaves the same files
        files.export_transcript_files(df, "mounted://deep/er", mount)
        files.export_transcript_files(df, f"file://{root}/plain")
    for folder in ("deep/er", "plain"):
        assert sorted(p.name for p in (tmp_path / folder).iterdir()) == sorted(f"{n}.txt" for n in range(20))
        assert (tmp_path / folder / "7.txt").read_bytes() == b"text 7\r\n"
    with pytest.raises(Exception, match="not a file name"):
        files.export_transcript_files(df.limit(1).withColumn("text_file", F.lit("../x.txt")), "mounted://deep", mount)


def test_audio_listing(spark, tmp_path):
    for name in ("1.wav", "2.OPUS", "3.aif", "4.gsm"):
        (tmp_path / name).write_bytes(b"abc")
    df = files.list_audio_files(spark, str(tmp_path))
    assert sorted((r.audio_file, r.length) for r in df.collect()) == [(n, 3) for n in ("1.wav", "2.OPUS", "3.aif", "4.gsm")]
    assert [r.audio_file for r in files.list_audio_files(spark, str(tmp_path), "*.wav").collect()] == ["1.wav"]
    assert "content" not in df._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0]


ODD = ['Line one,\n"two"', "\r\n", "back\\slash", "\\n", "\\\\n\n\\", "ends with \\", " spaced ", "é, 'q'", '"', '""', "a\rb"]


def test_dashboard_csv(spark, tmp_path):
    df = frame.dashboard_frame(star.calls(spark, SF_DIR), star.clients(spark, SF_DIR))
    odd = F.element_at(F.array(*[F.lit(o) for o in ODD]), (F.length("call_id") + F.crc32("call_id") % len(ODD)).cast("int") % len(ODD) + 1)
    odd = df.withColumn("Summary", F.when(F.crc32("call_id") % 3 == 0, odd).when(F.crc32("call_id") % 3 == 1, F.col("Summary")))
    files.write_dashboard_csv(odd, f"{tmp_path}/csv")
    back = files.read_dashboard_csv(spark, f"{tmp_path}/csv")
    assert back.schema == S.DASHBOARD
    assert back.exceptAll(odd).count() == 0 and odd.exceptAll(back).count() == 0


def test_a_large_csv_file_is_read_by_several_tasks(spark, tmp_path):
    df = frame.dashboard_frame(star.calls(spark, SF_DIR), star.clients(spark, SF_DIR)).withColumn("Summary", F.concat(F.lit("a\nb"), "call_id"))
    files.write_dashboard_csv(df.coalesce(1), f"{tmp_path}/csv")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64KB")
    spark.conf.set("spark.sql.files.openCostInBytes", "1KB")
    try:
        back = files.read_dashboard_csv(spark, f"{tmp_path}/csv")
        assert back.rdd.getNumPartitions() > 3 and back.count() == 1500
        assert back.exceptAll(df).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_csv_of_other_origin(spark, tmp_path):
    df = frame.dashboard_frame(star.calls(spark, SF_DIR), star.clients(spark, SF_DIR)).limit(1).withColumn("Summary", F.lit('one\n"two"\\n'))
    df.write.options(header=True, escape='"').csv(f"{tmp_path}/csv")
    assert files.read_dashboard_csv(spark, f"{tmp_path}/csv", escaped=False).first().Summary == 'one\n"two"\\n'


@pytest.fixture
def store(spark, tmp_path):
    made = CallStore(spark, str(tmp_path / "tables"), period="month")
    made.create_tables()
    return made


def test_store_starts_empty_and_keeps_tables(spark, store):
    assert store.get_calls().schema == S.CALL or store.get_calls().columns == S.CALL.fieldNames()
    assert store.get_calls().count() == store.get_agents().count() == store.get_clients().count() == 0
    store.insert_agents(star.agents(spark, SF_DIR))
    store.create_tables()
    assert store.get_agents().count() == 10
    store.recreate_tables()
    assert store.get_agents().count() == 0


def test_inserting_people_deletes_calls(spark, store):
    store.insert_clients(star.clients(spark, SF_DIR))
    store.insert_agents(star.agents(spark, SF_DIR))
    batch, audio = store.insert_calls(star.new_calls(spark, SF_DIR))
    assert store.get_calls().count() == 1500 and audio.columns == ["audio_file"]
    store.append_people(
        spark.createDataFrame([("A-new", "N", "N")], "agent_id string, first_name string, last_name string"),
        spark.createDataFrame([("C-new",)], "client_id string"),
    )
    assert store.get_agents().count() == 11 and store.get_clients().count() == 151
    assert store.get_calls().count() == 1500
    store.insert_agents(star.agents(spark, SF_DIR))
    assert store.get_calls().count() == 0 and store.get_clients().count() == 151


def test_a_refused_insert_changes_nothing(spark, store):
    store.insert_clients(star.clients(spark, SF_DIR))
    store.insert_calls(star.new_calls(spark, SF_DIR))
    twice = star.clients(spark, SF_DIR).unionByName(star.clients(spark, SF_DIR).limit(1))
    with pytest.raises(ValueError, match="not a unique key"):
        store.insert_clients(twice)
    with pytest.raises(ValueError, match="not a unique key"):
        store.insert_clients(spark.createDataFrame([(None, "x")], "client_id string, first_name string"))
    assert store.get_clients().count() == 150 and store.get_calls().count() == 1500


def test_update_in_store(spark, store):
    store.insert_calls(star.new_calls(spark, SF_DIR))
    before = store.get_calls().filter("call_id = '7'").first()
    store.update_calls("Speech diarized", "call_id", "call_id", spark.createDataFrame([("7",)], "call_id string"))
    after = store.get_calls()
    assert after.count() == 1500 and after.columns == S.CALL.fieldNames()
    assert after.filter("status = 'Speech diarized'").first().asDict() == {**before.asDict(), "status": "Speech diarized"}
    with pytest.raises(ValueError):
        store.update_calls("Unknown", "call_id", "call_id", spark.createDataFrame([("7",)], "call_id string"))


def test_an_empty_insert_leaves_an_empty_table(spark, store):
    store.insert_calls(star.new_calls(spark, SF_DIR).filter("false"))
    assert store.get_calls().count() == 0
