"""Incremental analysis: files that arrive are processed once and update the call table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from callinsight.plans import analysis
from callinsight.sources.store import CallStore


def follow_updates(
    store: CallStore,
    folder: str,
    schema: T.StructType,
    checkpoint: str,
    status: str,
    table_key: str,
    data_key: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    order_by: str | None = None,
) -> StreamingQuery:
    """Apply parquet files of updates as they arrive in ``folder``.

    Each micro-batch is one keyed update, which rewrites the days it reaches. Its number is kept with the
    tables under the checkpoint's name, so a batch repeated after a failure is skipped. The query stops when
    it has caught up.
    """

    def apply(batch: DataFrame, n: int) -> None:
        store.update_calls(status, table_key, data_key, transform(batch), order_by, batch=(checkpoint, n))

    return (
        store.spark.readStream.schema(schema)
        .parquet(folder)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def follow_transcripts(
    store: CallStore,
    folder: str,
    model: analysis.Model,
    output: str,
    checkpoint: str,
    audio_suffix: str = ".wav",
    max_files: int | None = None,
) -> StreamingQuery:
    """Analyze the text files that arrive in ``folder``, one per recording of a stored call.

    Step outputs of micro-batch ``n`` are written below ``output/batch=n``; a repeated batch
    overwrites its own folder and leaves a call table that has its updates alone.
    """

    def run(batch: DataFrame, n: int) -> None:
        analysis.analyze(store, batch, model, f"{output}/batch={n}", insert_calls=False, delivery=(checkpoint, n))

    reader = store.spark.readStream.option("pathGlobFilter", "*.txt")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    name = F.col("_metadata.file_name")
    texts = reader.text(folder, wholetext=True).select(
        F.regexp_replace(name, r"\.txt$", audio_suffix).alias("audio_file"),
        name.alias("transcription_file"),
        F.col("value").alias("text"),
    )
    return (
        texts.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
