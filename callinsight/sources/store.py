"""The client, agent and call tables.

Parquet cannot be updated in place, so every change writes a new snapshot folder and then switches the
tables to it with one manifest file (:mod:`callinsight.sources.manifest`), all tables at once. Readers see the old
rows or the new ones; a job that fails, or is retried after losing executors, leaves the tables as they
were; a later session finds them by their folder alone.

Calls lie in one folder per day, or per month where days are small. An update rewrites the days that hold a call it
reaches, and the manifest carries all other days over from the snapshots that hold them.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable
from datetime import date
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callinsight import schemas as S
from callinsight.operators.integrity import column_checks, duplicate_keys, with_schema
from callinsight.operators.updates import UPDATE_CHAIN, apply_hits, chain_hits
from callinsight.sources.manifest import Manifest, Snapshots, Version

#: Folder column of each period, and its value for a date, as text.
PERIODS: dict[str, tuple[str, Callable[[Column], Column]]] = {
    "day": ("date", lambda d: d.cast("string")),
    "month": ("month", lambda d: F.date_format(d, "yyyy-MM")),
}

#: Snapshots of the call table that a reader meets at most before an update rewrites all days.
MAX_SNAPSHOTS = 64


class CallStore:
    """Tables under ``root``, a folder that every executor can reach. ``name`` is for views, see ``register_views``.

    ``period``: whether a new store keeps the calls by "day" or by "month"; an existing one goes on as it began.
    A period should hold some files' worth of calls, since it is what an update rewrites.
    """

    def __init__(self, spark: SparkSession, root: str, name: str = "callinsight", period: str = "day"):
        if period not in PERIODS:
            raise ValueError(f"period must be one of {sorted(PERIODS)}, not {period!r}")
        self.spark, self.root, self.name = spark, root.rstrip("/"), name
        self.manifest = Manifest(spark, self.root, period)

    # --- Definition ---------------------------------------------------------------------------

    def create_tables(self) -> None:
        """Create what is missing; existing tables are kept."""
        now = self.manifest.read()
        if missing := {name: {} for name in S.TABLES if name not in now.tables}:
            self.manifest.commit(now, missing)

    def recreate_tables(self) -> None:
        """Empty tables, all three at once."""
        self.manifest.commit(self.manifest.read(), {name: {} for name in S.TABLES})

    def register_views(self) -> None:
        """Temporary views ``<name>_call``, ``<name>_agent`` and ``<name>_client`` of the present version."""
        for name in S.TABLES:
            self._read(name, self.manifest.read()).createOrReplaceTempView(f"{self.name}_{name}")

    # --- Reading ------------------------------------------------------------------------------

    def _read(self, name: str, version: Version, periods: list[str] | None = None, with_snapshot: bool = False) -> DataFrame:
        """A table as of a version; of calls only ``periods``, if given. Folders that are left out are not read."""
        schema, snapshots = S.TABLES[name], version.tables.get(name, {})
        used = {s: p for s, p in snapshots.items() if p is None or p}
        columns = [*schema.fieldNames(), *(["snapshot"] if with_snapshot else [])]
        if not used:
            return self.spark.createDataFrame([], schema).withColumn("snapshot", F.lit("")).select(columns)
        folder, text = f"{self.root}/{name}", T.StringType()
        column = PERIODS[version.period][0]
        folders = [T.StructField(c, text) for c in ("snapshot", column) if c not in schema.fieldNames()]
        rows = self.spark.read.option("basePath", folder).schema(T.StructType([*schema.fields, *folders])).parquet(*[f"{folder}/{s}" for s in used])
        if name == "call":
            of = lambda values: [date.fromisoformat(v) for v in values] if version.period == "day" else values

            def current(snapshot: str, kept: list[str] | None) -> Column:
                here = F.col("snapshot") == snapshot.partition("=")[2]
                return here if kept is None else here & F.col(column).isin(of(kept))

            if any(p is not None for p in used.values()):
                rows = rows.filter(reduce(Column.__or__, [current(s, p) for s, p in used.items()]))
            if periods is not None:
                rows = rows.filter(F.col(column).isin(of(periods)) if periods else F.lit(False))
        return rows.select(columns)

    def calls_with_snapshot(self) -> DataFrame:
        """The calls with the name of the snapshot that holds them, which tells when their day was last written."""
        return self._read("call", self.manifest.read(), with_snapshot=True)

    def get_calls(self) -> DataFrame:
        return self._read("call", self.manifest.read())

    def get_agents(self) -> DataFrame:
        return self._read("agent", self.manifest.read())

    def get_clients(self) -> DataFrame:
        return self._read("client", self.manifest.read())

    # --- Writing ------------------------------------------------------------------------------

    def _write(self, name: str, df: DataFrame, given: list[str] | None = None, lengths: bool = False) -> str:
        """Write a snapshot; its column rules are counted while it is written, and broken ones refuse it.

        ``given``: the columns whose rules hold, by default all; with ``lengths`` those on length hold for all. Columns that the table does not have are refused
        before anything is written.
        """
        snapshot = f"snapshot={time.strftime('%Y%m%dT%H%M%S')}-{time.time_ns() % 10**9:09d}-{uuid.uuid4().hex[:8]}"
        checks = [c for c in column_checks(S.TABLES[name]) if given is None or c[1] in given or (lengths and c[0] == "length")]
        seen = Observation()
        rows = with_schema(df, S.TABLES[name], strict=True)
        metrics = [F.count_if(broken).alias(f"{rule} of {column}") for rule, column, broken in checks]
        rows = rows.observe(seen, *metrics)
        path = f"{self.root}/{name}/{snapshot}"
        if name == "call":
            # A period stays together; AQE splits one that is too large for one file.
            column, value = PERIODS[self.manifest.read().period]
            rows = rows if column == "date" else rows.withColumn(column, value(F.col("date")))
            rows.hint("rebalance", column).write.partitionBy(column).parquet(path)
        else:
            rows.write.parquet(path)
        try:
            counted = seen.get
        except Py4JJavaError:  # Spark knew the input to be empty and dropped the metrics with it
            counted = self._written(name, snapshot).agg(*metrics).first().asDict()
        broken = {rule: n for rule, n in counted.items() if n}
        if missing := broken.get(f"not null of {S.PRIMARY_KEYS[name]}"):
            raise ValueError(f"{name}.{S.PRIMARY_KEYS[name]} is not a unique key: it is NULL in {missing} rows")
        if broken:
            raise ValueError(f"{name} breaks a rule: {broken}")
        return snapshot

    def _written(self, name: str, snapshot: str) -> DataFrame:
        return self._read(name, Version(tables={name: {snapshot: None}}, period=self.manifest.read().period))

    def _check_key(self, name: str, keys: DataFrame) -> None:
        """One aggregate over the key column; NULLs are refused by the rules of the write."""
        if example := duplicate_keys(keys, S.PRIMARY_KEYS[name]).take(1):
            raise ValueError(f"{name}.{S.PRIMARY_KEYS[name]} is not a unique key: {example[0].asDict()}")

    def _prepare(self, name: str, df: DataFrame) -> str:
        snapshot = self._write(name, df)
        self._check_key(name, self._written(name, snapshot).select(S.PRIMARY_KEYS[name]))
        return snapshot

    def insert_clients(self, clients: DataFrame) -> None:
        """Replace all clients and delete all calls, in one step; nothing changes if the clients are refused."""
        now = self.manifest.read()
        self.manifest.commit(now, {"client": {self._prepare("client", clients): None}, "call": {}})

    def insert_agents(self, agents: DataFrame) -> None:
        """Replace all agents and delete all calls, in one step; nothing changes if the agents are refused."""
        now = self.manifest.read()
        self.manifest.commit(now, {"agent": {self._prepare("agent", agents): None}, "call": {}})

    def insert_calls(self, calls: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Replace all calls; returns the stored batch and its audio files."""
        now = self.manifest.read()
        self.manifest.commit(now, {"call": {self._prepare("call", calls): None}})
        stored = self.get_calls().select(*[c for c in calls.columns if c in S.CALL.fieldNames()])
        return stored, stored.select("audio_file")

    def append_people(self, agents: DataFrame, clients: DataFrame, incomplete: bool = False) -> None:
        """Add agents and clients to those already stored, both in one step.

        Only the new rows are written. Columns that the input lacks stay NULL, for ``integrity_report`` to name;
        the rules hold for the others, or with ``incomplete`` only the key has to be there and lengths to fit.
        A key that is stored already, or comes twice, refuses all.
        """
        now, tables = self.manifest.read(), {}
        for name, people in (("agent", agents), ("client", clients)):
            key = S.PRIMARY_KEYS[name]
            snapshot = self._write(name, people, [key] if incomplete else [*people.columns, key], lengths=True)
            new = self._written(name, snapshot).select(key)
            known = self._read(name, now).select(key).join(new, key, "left_semi")
            self._check_key(name, new.unionByName(known))
            tables[name] = {**now.tables.get(name, {}), snapshot: None}
        self.manifest.commit(now, tables)

    # --- Updates ------------------------------------------------------------------------------

    def update_calls(
        self,
        status: str,
        table_key: str,
        data_key: str,
        data: DataFrame,
        order_by: str | None = None,
        batch: tuple[str, int] | None = None,
    ) -> None:
        """Keyed bulk update; see :func:`callinsight.operators.updates.update_calls`."""
        self.apply_updates([(data, status, table_key, data_key)], order_by, batch)

    def apply_updates(
        self,
        updates: Iterable[tuple[DataFrame, str, str, str]],
        order_by: str | None = None,
        batch: tuple[str, int] | None = None,
    ) -> bool:
        """Several updates in order, as one snapshot of the days that they reach; False if ``batch`` was applied before.

        The updates meet narrow rows of the calls first, which are written: they name the days, and only
        those days' calls are read whole, joined and written anew. ``batch`` is (stream, number): the number is kept
        with the tables, so a batch that is delivered again changes nothing. Call ids stay unique unless
        an update sets them, so they are only rechecked then.
        """
        updates = list(updates)
        now = self.manifest.read()
        if batch and now.batches.get(batch[0], -1) >= batch[1]:
            return False
        aside = f"_work/{uuid.uuid4().hex}"
        try:
            hits = chain_hits(self._read("call", now), updates, order_by)
            hits.write.parquet(f"{self.root}/{aside}")
            hits = self.spark.read.schema(hits.schema).parquet(f"{self.root}/{aside}")
            tables = self._rewritten(now, hits, updates, order_by)
        finally:
            self.manifest.folder.delete(aside)
        self.manifest.commit(now, tables, batch)
        return True

    def _rewritten(self, now: Version, hits: DataFrame, updates: list, order_by: str | None) -> dict[str, Snapshots]:
        set_by = [f"_of_{i}" for i, (data, _, _, key) in enumerate(updates) if "date" in data.columns and key != "date"]
        moved = [F.col(f"{c}.date").cast("date") for c in set_by]
        column, value = PERIODS[now.period]
        # One row per period: at most as many as the calendar has days.
        reached = hits.select(F.explode(F.array(*[value(d) for d in (F.col("date"), *moved)])).alias("p")).filter("p is not null").distinct()
        periods = [r["p"] for r in reached.collect()]
        if not periods:
            return {}
        snapshots = now.tables.get("call", {})
        if sum(p is None or bool(p) for p in snapshots.values()) >= MAX_SNAPSHOTS:
            periods = None  # all of them into one snapshot again
        snapshot = self._write("call", apply_hits(self._read("call", now, periods), hits, updates, order_by))
        kept: Snapshots = {}
        for old, have in snapshots.items():
            if periods is not None and (rest := sorted(set(self._periods(old, column) if have is None else have) - set(periods))):
                kept[old] = rest
        tables = {"call": {**kept, snapshot: None}}
        if any("call_id" in data.columns and key != "call_id" for data, _, _, key in updates):
            self._check_key("call", self._read("call", Version(tables=tables, period=now.period)).select("call_id"))
        return tables

    def _periods(self, snapshot: str, column: str) -> list[str]:
        return [n.partition("=")[2] for n in self.manifest.folder.names(f"call/{snapshot}") if n.startswith(f"{column}=")]

    def apply_chain(self, outputs: dict[str, DataFrame], batch: tuple[str, int] | None = None) -> bool:
        """The status updates of an analysis run as one snapshot of the days they reach."""
        steps = [(outputs[step], status, key, data_key) for step, status, key, data_key in UPDATE_CHAIN if step in outputs]
        return self.apply_updates(steps, batch=batch)

    def forget_old_versions(self, keep: int = 2) -> list[str]:
        """Remove snapshots that the last ``keep`` versions do not name; readers of older ones fail afterwards."""
        return self.manifest.forget(keep)

