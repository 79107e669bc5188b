"""Generate people and a batch of calls, ready for analysis; or export a generated batch and import it elsewhere."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame

from callinsight.operators import relations, synthesis
from callinsight.operators.synthesis import CallSettings
from callinsight.sources import files
from callinsight.sources.files import write_dataset
from callinsight.sources.store import CallStore


@dataclass(frozen=True)
class Generated:
    metadata: DataFrame
    ground_truths: DataFrame
    prompts: DataFrame


def generate_people(store: CallStore, num_clients: int, num_agents: int, language: str = "en") -> None:
    """Synthesize and store clients and agents (which empties the call table)."""
    spark = store.spark
    store.insert_clients(synthesis.synthetic_clients(spark.range(num_clients), language))
    store.insert_agents(synthesis.synthetic_agents(spark.range(num_agents), language))


def generate(
    store: CallStore,
    amount: int,
    num_clients: int,
    num_agents: int,
    output: str,
    settings: CallSettings = CallSettings(),
    generate_clients_and_agents: bool = True,
) -> Generated:
    """People, then calls with ground truth and prompts, written below ``output``.

    The sampled calls are written once and the three datasets are projections of that table.
    """
    if generate_clients_and_agents:
        generate_people(store, num_clients, num_agents, settings.language)
    calls = synthesis.synthetic_calls(
        store.spark.range(amount), store.get_agents(), store.get_clients(), settings
    )
    calls = write_dataset(calls, f"{output}/calls")
    return Generated(
        metadata=write_dataset(synthesis.metadata(calls), f"{output}/metadata"),
        ground_truths=write_dataset(synthesis.ground_truths(calls), f"{output}/ground_truths"),
        prompts=calls.select("text_file", "prompt"),
    )


def create_batch(metadata: DataFrame, audio_files: DataFrame, output: str) -> DataFrame:
    """The calls that have a recording, as the input batch of the analysis."""
    return write_dataset(relations.create_batch_for_analysis(metadata, audio_files), f"{output}/calls_batch")


@dataclass(frozen=True)
class Example:
    """What the analysis starts from. ``conversations`` (text_file, text) and ``recordings`` may be missing."""

    metadata: DataFrame
    ground_truths: DataFrame
    dataframe: DataFrame
    calls_batch: DataFrame
    conversations: DataFrame | None = None
    recordings: DataFrame | None = None


_DATASETS = ["metadata", "ground_truths", "dataframe", "calls_batch"]


def export_example(store: CallStore, example: Example, folder: str, language: str = "en") -> None:
    """The stored people and all datasets of a generated batch below one folder, each named after its language."""
    files.write_people_json(store.get_agents(), folder, "agents", language)
    files.write_people_json(store.get_clients(), folder, "clients", language)
    for name in _DATASETS:
        files.write_dataset(getattr(example, name), f"{folder}/{language}_{name}.parquet")
    if example.conversations is not None:
        files.write_transcripts(example.conversations, f"{folder}/{language}_conversations.parquet")
    if example.recordings is not None:
        files.write_dataset(example.recordings, f"{folder}/{language}_recordings.parquet")


def import_example(store: CallStore, folder: str, language: str = "en") -> Example:
    """Start from exported or bundled data instead of generating some: empties the tables, stores its people, and
    returns its datasets. Details that the people lack stay NULL."""
    spark = store.spark
    agents, clients = (files.read_people_json(spark, folder, kind, language) for kind in ("agents", "clients"))
    store.recreate_tables()
    store.append_people(agents, clients, incomplete=True)

    def if_there(name: str) -> DataFrame | None:
        try:
            return spark.read.parquet(f"{folder}/{language}_{name}.parquet")
        except AnalysisException:
            return None

    datasets = {name: files.read_dataset(spark, folder, name, language) for name in _DATASETS}
    return Example(**datasets, conversations=if_there("conversations"), recordings=if_there("recordings"))
