"""Analyze a batch of calls: segment, anonymize, answer questions, and update the call table.

Speech recognition and question answering are the user's models; everything around them is here.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.resource import ResourceProfile
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callinsight import schemas as S
from callinsight.operators import answers, pii, reconcile, relations, spans, turns
from callinsight.sources.files import write_dataset, write_errors
from callinsight.sources.store import CallStore

# Rows with prompt_1, prompt_2, ... in, rows with the columns of raw_answers() out.
Model = answers.Model
POLLS = answers.POLLS


def raw_answers(polls: Sequence[str] = POLLS, blocks: Sequence[answers.Block] | None = None) -> T.StructType:
    """What a model returns: a column of text for each reply, by default one for the first block and one a poll."""
    replies = [c for b in blocks or answers.usual_blocks(polls) for c in b.answers]
    return T.StructType([T.StructField(c, T.StringType()) for c in replies])


@dataclass(frozen=True)
class Analyzed:
    turns: DataFrame
    anonymized: DataFrame
    spans: DataFrame
    pii_report: DataFrame
    highlighted: DataFrame
    answers: DataFrame


def analyze(
    store: CallStore,
    transcripts: DataFrame,
    model: Model | None,
    output: str,
    batch: DataFrame | None = None,
    insert_calls: bool = True,
    show_progress: bool = False,
    batch_size: int = 1,
    entities: Sequence[str] = tuple(pii.ENTITIES),
    operator_map: Mapping = pii.OPERATORS,
    threshold: float = pii.THRESHOLD,
    polls: Sequence[str] = tuple(POLLS),
    blocks: Sequence[answers.Block] | None = None,
    scores: Sequence[str] = tuple(S.SCORE_COLUMNS),
    make_model: Callable[[], Model] | None = None,
    profile: ResourceProfile | None = None,
    recordings: DataFrame | None = None,
    delivery: tuple[str, int] | None = None,
) -> Analyzed:
    """Run all steps on ``transcripts`` (audio_file, transcription_file, text).

    ``blocks`` are the questions, with their columns, templates and replies; columns that the call table lacks are
    kept in the ``answers`` output alone. ``make_model`` and ``profile``: see :func:`callinsight.operators.answers.infer`.
    ``recordings`` (audio_file): the inventory; calls whose recording is not in it are reported.
    ``delivery`` (stream, number): a delivery whose updates the store has already leaves the call table alone.

    Step outputs and errors are written below ``output``. Before any model runs every input is accounted for:
    ``transcription_errors`` has each text that goes no further (its recording is not named or belongs to no
    call, a later text by file name is used, it has no text), ``missing_transcripts`` each call that no text
    belongs to, and ``inputs`` counts both. Where several calls share a
    recording, the names of all their people are masked, the lowest call id stands for it in the turns,
    and the updates by file reach all of them. Personal data is detected once, as spans in ``detected``: the
    anonymized text, the report and the HTML are made from those. The call table gets the four status
    updates as one snapshot at the end, or with ``show_progress`` one snapshot per step so that
    others can follow; the final rows are the same. Only calls a step succeeded for advance.
    """
    asked_blocks = answers.checked_blocks(blocks or answers.usual_blocks(polls))
    if insert_calls:
        store.insert_calls(batch)
    steps: dict[str, DataFrame] = {}

    def report(step: str, updates: DataFrame) -> None:
        steps[step] = updates
        if show_progress:
            apply(store, {step: updates})

    # Inputs meet on narrow rows; texts are moved once, to pick the last one of each recording.
    calls = store.get_calls().select("call_id", "client_id", "agent_id", "audio_file")
    found = write_dataset(reconcile.by_recording(calls, transcripts, recordings), f"{output}/recordings")
    outcomes = write_dataset(reconcile.text_outcomes(transcripts, found), f"{output}/transcripts")
    texts = reconcile.last_texts(outcomes).withColumnRenamed("transcription_file", "text_file")
    reconcile.errors_of_texts(outcomes).write.mode("overwrite").parquet(f"{output}/transcription_errors")
    of_calls = reconcile.call_outcomes(calls.select("call_id", "audio_file"), found, recordings is not None)
    silent = of_calls.withColumn("error", F.when(F.col("outcome") != reconcile.READY, F.col("outcome")))
    write_errors(silent, ["call_id", "audio_file"], f"{output}/missing_transcripts")

    segments = write_dataset(turns.split_turns(texts), f"{output}/turns")
    diarized = segments.filter("speaker is not null").select("call_id").distinct()
    unsplit = texts.join(diarized, "call_id", "left_anti").withColumn("error", F.lit("no speaker turn"))
    write_errors(unsplit, ["call_id"], f"{output}/diarization_errors")
    report("diarized", diarized)
    report(
        "transcribed",
        texts.filter("text is not null").select("audio_file", F.col("text_file").alias("transcription_file")),
    )

    # Names come as rows, however many people share a recording.
    named = relations.with_speaker_names(calls.filter("audio_file is not null"), store.get_clients(), store.get_agents())
    names = named.select("audio_file", F.explode("names").alias("name"))
    looked_for = pii.active(entities, threshold)
    detected = pii.detect_with_names(texts.select("audio_file", "text_file", "text"), names, "audio_file", looked_for, threshold)
    detected = write_dataset(detected, f"{output}/detected")
    masked = write_dataset(pii.anonymized(detected, operator_map, looked_for), f"{output}/anonymized")
    write_errors(masked, ["original_file"], f"{output}/anonymized_errors")
    findings = write_dataset(spans.report(detected), f"{output}/pii_report")
    html = write_dataset(pii.highlighted(detected), f"{output}/highlighted")
    done = masked.filter("error is null")
    report("anonymized", done.select("original_file", "anonymized_file"))

    asked = answers.prompts(done.select(F.col("anonymized_file").alias("text_file"), "text"), blocks=asked_blocks)
    asked = asked.select("text_file", *[f"prompt_{b}" for b in range(1, len(asked_blocks) + 1)])
    replies = answers.infer(asked, model, raw_answers(blocks=asked_blocks), ["text_file"], batch_size, make_model, profile)
    raw = write_dataset(replies, f"{output}/raw_answers")
    parsed = write_dataset(answers.parse_blocks(raw, asked_blocks, scores), f"{output}/parsed_answers")
    write_errors(parsed, ["text_file"], f"{output}/answers_errors")
    good, _ = answers.split_errors(parsed, ["text_file"])
    processed = write_dataset(answers.postprocess_answers(good), f"{output}/answers")
    report("answered", processed.select("text_file", *[c for c in processed.columns if c in S.CALL.fieldNames()]))

    if not show_progress:
        apply(store, steps, delivery)
    return Analyzed(segments, masked, spans.as_rows(detected), findings, html, processed)


def apply(store: CallStore, outputs: dict[str, DataFrame], delivery: tuple[str, int] | None = None) -> None:
    """Write the updates of the given steps, in the order of the chain, as one snapshot."""
    store.apply_chain(outputs, delivery)
