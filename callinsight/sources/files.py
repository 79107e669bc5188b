"""Readers and writers of files: people, datasets, transcripts, recordings, the dashboard CSV."""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable, Iterable, Mapping

import pyarrow.fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callinsight import schemas as S
from callinsight.operators.integrity import with_schema

# Worker functions travel with their code: nothing of this package has to be installed on the workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PEOPLE = {"agents": S.AGENT, "clients": S.CLIENT}


# --- People and datasets ----------------------------------------------------------------------


def read_people_json(spark: SparkSession, folder: str, kind: str, language: str) -> DataFrame:
    """Agents or clients from a JSON array file, or a folder of JSON lines; fields that it lacks read as NULL."""
    path = f"{folder}/{language}_{kind}.json"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    lines = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(hadoop_path).isDirectory()
    return spark.read.schema(PEOPLE[kind]).json(path, multiLine=not lines)


def read_dataset(spark: SparkSession, folder: str, name: str, language: str) -> DataFrame:
    """One of the bundled step outputs (metadata, dataframe, calls_batch, ground_truths)."""
    return with_schema(spark.read.parquet(f"{folder}/{language}_{name}.parquet"), S.DATASETS[name])


def write_people_json(people: DataFrame, folder: str, kind: str, language: str) -> None:
    """Agents or clients as a folder of JSON lines, which ``read_people_json`` reads as it does an array file."""
    with_schema(people, PEOPLE[kind], strict=True).write.mode("overwrite").json(f"{folder}/{language}_{kind}.json")


def write_dataset(df: DataFrame, path: str) -> DataFrame:
    """Write a step's output and return it read back, which also cuts its lineage."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def export_datasets(spark: SparkSession, datasets: Mapping[str, str], folder: str) -> None:
    """Copy named datasets (target name -> source path) below a folder."""
    for target, source in datasets.items():
        spark.read.parquet(source).write.mode("overwrite").parquet(f"{folder}/{target}")


def write_errors(df: DataFrame, keys: list[str], path: str) -> None:
    """Side output of a step: the keys of the failed rows and their message."""
    df.filter(F.col("error").isNotNull()).select(*keys, "error").write.mode("overwrite").parquet(path)


# --- Transcripts and recordings ---------------------------------------------------------------


def read_transcripts(spark: SparkSession, folder: str) -> DataFrame:
    """(text_file, text) of a folder with one text file per call."""
    return (
        spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.txt")
        .select(F.col("_metadata.file_name").alias("text_file"), F.col("value").alias("text"))
    )


def list_audio_files(spark: SparkSession, folder: str, pattern: str | None = None) -> DataFrame:
    """(audio_file, path, length) of all files below ``folder``, or of those whose name matches ``pattern``, a glob.

    No type of file is left out by itself. Contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(folder).select(F.substring_index("path", "/", -1).alias("audio_file"), "path", "length")


def write_transcripts(df: DataFrame, path: str) -> None:
    """Transcripts as parquet, by day when the day is known."""
    columns = [c for c in ("text_file", "text", "date") if c in df.columns]
    out = df.select(*columns)
    if "date" in columns:
        # Rows of a day go together, and AQE splits a day that is too large for one file.
        out.hint("rebalance", "date").write.mode("overwrite").partitionBy("date").parquet(path)
    else:
        out.write.mode("overwrite").parquet(path)


#: From a URI to the file system and the path in it, as pyarrow's ``FileSystem.from_uri``.
Mount = Callable[[str], tuple["pyarrow.fs.FileSystem", str]]


def export_transcript_files(df: DataFrame, folder: str, mount: Mount | None = None) -> None:
    """One text file per transcript, in a folder of any store that pyarrow opens (``file``, ``s3``, ``gs``, ``hdfs``, ...)
    and that every executor reaches.

    ``mount`` opens URIs of other schemes, or with settings of one's own. A file is written under another name and
    moved to its own, so that a task that fails leaves no half of it; its repetition writes the same files again.
    A name that would leave the folder is refused.
    """

    def write(rows: Iterable[Row]) -> None:
        store, path = mount(folder) if mount else pyarrow.fs.FileSystem.from_uri(folder if "://" in folder else os.path.abspath(folder))
        store.create_dir(path, recursive=True)
        for row in rows:
            if "/" in row.text_file or row.text_file in ("", ".", ".."):
                raise ValueError(f"not a file name: {row.text_file!r}")
            aside = f"{path}/.{row.text_file}.{uuid.uuid4().hex}.part"
            with store.open_output_stream(aside) as f:
                f.write(row.text.encode("utf-8"))
            store.move(aside, f"{path}/{row.text_file}")

    df.select("text_file", "text").filter(F.col("text").isNotNull()).foreachPartition(write)


# --- Dashboard file ---------------------------------------------------------------------------

_CSV = {
    "header": True, "quote": '"', "escape": '"', "dateFormat": "yyyy-MM-dd", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def _on_one_line(text: Column) -> Column:
    """Line breaks as ``\\n`` and ``\\r``, backslashes doubled: a row is one line, so a file can be read by many tasks."""
    for char, escape in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(char), F.lit(escape))
    return text


def _on_its_lines(text: Column) -> Column:
    """The inverse. Between two doubled backslashes every other backslash starts an escape."""
    parts = F.split(text, r"\\\\", -1)
    plain = F.transform(parts, lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
    return F.array_join(plain, "\\")


def _texts(schema: T.StructType, change: Callable[[Column], Column]) -> list[Column]:
    return [change(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in schema.fields]


def write_dashboard_csv(frame: DataFrame, path: str) -> None:
    """The frame as CSV, a line a row: line breaks and backslashes in texts are escaped by a backslash."""
    frame.select(*_texts(frame.schema, _on_one_line)).write.mode("overwrite").options(**_CSV).csv(path)


def read_dashboard_csv(spark: SparkSession, path: str, schema: T.StructType = S.DASHBOARD, escaped: bool = True) -> DataFrame:
    """The dashboard frame with its explicit schema, as ``write_dashboard_csv`` writes it; a large file is read in parts.

    ``escaped=False`` reads a file of other origin, whose quoted texts may hold line breaks; one task reads such a file."""
    if not escaped:
        return spark.read.schema(schema).options(**_CSV, multiLine=True).csv(path)
    rows = spark.read.schema(schema).options(**_CSV).csv(path)
    return rows.select(*_texts(schema, _on_its_lines))
