"""Joins between people, calls, texts and recordings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callinsight.functions import scalars as X


def create_batch_for_analysis(conversations: DataFrame, audio_files: DataFrame) -> DataFrame:
    """Calls with their audio file, rows with any NULL dropped; each audio of a text gives a row.

    A call without audio would only be kept to be dropped again, so the join is an inner one.
    """
    return conversations.join(audio_files, "text_file", "inner").drop("text_file").na.drop("any")


def calls_of(people: DataFrame, calls: DataFrame, key: str) -> DataFrame:
    """A person's calls, one row each; people without calls keep one row with a NULL call.

    Rows rather than one list per person: a list would gather all calls of a busy person in a
    single record. An inner join plus the people without calls, rather than an outer join, whose
    calls' side Spark could not split where one person has very many.
    """
    who = people.select(key, "first_name", "last_name")
    called = who.join(calls.select(key, "call_id", "date", "time"), key)
    callers = calls.groupBy(key).agg(F.count("*").alias("_n"))
    return called.unionByName(who.join(callers, key, "left_anti"), allowMissingColumns=True)


def call_totals(people: DataFrame, calls: DataFrame, key: str) -> DataFrame:
    """Number of calls, first and last day per person, folded below the join."""
    totals = calls.groupBy(key).agg(
        F.count("*").alias("calls"), F.min("date").alias("first_day"), F.max("date").alias("last_day")
    )
    return people.select(key).join(totals, key, "left").withColumn("calls", F.coalesce("calls", F.lit(0).cast("bigint")))


def with_speaker_names(calls: DataFrame, clients: DataFrame, agents: DataFrame) -> DataFrame:
    """Add ``names``: full, first and last names of the call's own client and agent.

    Meant for the ids of the calls, before the texts are joined, so that texts are not shuffled
    by client and agent.
    """

    def names(people: DataFrame, key: str) -> DataFrame:
        full = X.full_name(F.col("first_name"), F.col("last_name"))
        return people.select(key, F.array(full, "first_name", "last_name").alias(f"_{key}"))

    none = F.array().cast("array<string>")
    return (
        calls.join(names(clients, "client_id"), "client_id", "left")
        .join(names(agents, "agent_id"), "agent_id", "left")
        .withColumn("names", F.concat(F.coalesce("_client_id", none), F.coalesce("_agent_id", none)))
        .drop("_client_id", "_agent_id")
    )


def calls_without_recording(calls: DataFrame, recordings: DataFrame) -> DataFrame:
    """Calls whose audio file is unknown or not among the recordings."""
    return calls.join(recordings.select("audio_file"), "audio_file", "left_anti")


def transcript_view(grid: DataFrame, transcripts: DataFrame, recordings: DataFrame) -> DataFrame:
    """Formatted text and recording of the selected calls; calls missing either file drop out."""
    texts = transcripts.select("text_file", X.as_markdown(F.col("text")).alias("transcript"))
    audio = recordings.select("audio_file", F.col("path").alias("audio_path"))
    return grid.join(texts, "text_file").join(audio, "audio_file")
