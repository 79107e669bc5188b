"""Keyed bulk update of the call table, as a set-based join."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callinsight import schemas as S


def check_status(status: str) -> str:
    if status not in S.CALL_STATUSES:
        raise ValueError(f"{status!r} is not a call status; use one of {S.CALL_STATUSES}")
    return status


def _one_per_key(updates: DataFrame, key: str, order_by: str | None) -> DataFrame:
    """One struct ``_new`` per key: the last by ``order_by``, or an error on duplicates.

    Equal order values are settled by the values themselves (the greater ones win, NULLs are least), so the
    winner never depends on partitioning. One aggregate folds each task's updates of a key before
    the shuffle. It is clustered by a hash of the key, not by the key: so an ordinary exchange
    follows, and Spark can split the calls of a hot key in the join.
    """
    values = [c for c in updates.columns if c not in (key, order_by)]
    # A constant member keeps the struct present even when only the status changes.
    new = F.struct(F.lit(True).alias("_hit"), *values)
    order = F.col(order_by) if order_by else F.lit(0)
    rows = updates.filter(F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.struct(order.alias("order"), new.alias("new")).alias("_row"))
    latest = rows.groupBy(F.xxhash64("_key").alias("_spread"), "_key").agg(F.max("_row").alias("_last"), F.count("*").alias("_times"))
    if order_by is None:
        # A filter stays in the plan whatever columns are read later.
        twice = F.raise_error(F.concat(F.lit(f"several updates for {key} "), F.col("_key").cast("string")))
        latest = latest.filter(F.when(F.col("_times") > 1, twice.cast("boolean")).otherwise(F.lit(True)))
    return latest.select("_key", F.col("_last.new").alias("_new"))


def update_calls(
    calls: DataFrame,
    updates: DataFrame,
    status: str,
    table_key: str,
    data_key: str,
    order_by: str | None = None,
) -> DataFrame:
    """Set ``status`` and every further column of ``updates`` on the calls with a matching key.

    - an update without a call is ignored, and a key shared by several calls updates them all;
    - a NULL in the update overwrites;
    - of several updates for one key the last by ``order_by`` wins, of equal order values the greater
      values; without an order column several updates are an error, raised when the result is computed.

    The updates are reduced to one row per key, so the join cannot multiply calls. Calls whose
    key is NULL get a private join key: they cannot match and must not meet in one task. A key
    shared by very many calls is split by AQE's skew join.
    """
    check_status(status)
    allowed = set(S.CALL.fieldNames())
    extra = set(updates.columns) - allowed - {data_key, order_by}
    if extra:
        raise ValueError(f"not columns of the call table: {sorted(extra)}")
    latest = _one_per_key(updates, data_key, order_by)
    changed = [c for c in updates.columns if c not in (data_key, order_by)]

    key = F.col(table_key)
    spread = F.concat(F.lit("\x00"), F.col("call_id"))
    keyed = calls.withColumn("_join_key", F.coalesce(key, spread))
    matches = (F.col("_join_key") == F.col("_key")) & key.isNotNull()
    joined = keyed.join(latest, matches, "left")
    hit = F.col("_new").isNotNull()

    def column(name: str):
        if name == "status":
            return F.when(hit, F.lit(status)).otherwise(F.col("status")).alias("status")
        if name in changed:
            new = F.col("_new").getField(name).cast(S.CALL[name].dataType)
            return F.when(hit, new).otherwise(F.col(name)).alias(name)
        return F.col(name)

    return joined.select(*[column(c) for c in calls.columns])


# The four updates of an analysis run: (step output, new status, call column, data column).
UPDATE_CHAIN = [
    ("diarized", "Speech diarized", "call_id", "call_id"),
    ("transcribed", "Transcribed", "audio_file", "audio_file"),
    ("anonymized", "Anonymized", "transcription_file", "original_file"),
    ("answered", "Analyzed", "anonymized_file", "text_file"),
]


# (data, status, call column, data column) of one update.
Update = tuple[DataFrame, str, str, str]


def _changed(update: Update, order_by: str | None) -> list[str]:
    """The columns that an update sets besides the status; raises if the call table lacks one."""
    data, status, _, data_key = update
    check_status(status)
    changed = [c for c in data.columns if c not in (data_key, order_by)]
    if extra := set(changed) - set(S.CALL.fieldNames()):
        raise ValueError(f"not columns of the call table: {sorted(extra)}")
    return changed


def chain_hits(calls: DataFrame, updates: Sequence[Update], order_by: str | None = None) -> DataFrame:
    """(call_id, date, ``_of_0``, ``_of_1``, ...): the calls that any of the updates reaches, and what each sets.

    The updates apply one after the other, so each finds its calls by the values that those before it left. They
    meet narrow rows only, of the columns that they look for.
    """
    changed = [_changed(u, order_by) for u in updates]
    links = sorted({table_key for _, _, table_key, _ in updates})
    moved = calls.select("call_id", "date", *[F.col(c).alias(f"_{c}") for c in links])
    for i, (data, _, table_key, data_key) in enumerate(updates):
        latest = _one_per_key(data, data_key, order_by).select("_key", F.col("_new").alias(f"_of_{i}"))
        # Calls whose key is still NULL get a private join key: they must not meet in one task.
        keyed = moved.withColumn("_join", F.coalesce(F.col(f"_{table_key}").cast("string"), F.concat(F.lit("\x00"), "call_id")))
        hit = (F.col("_join") == F.col("_key").cast("string")) & F.col(f"_{table_key}").isNotNull()
        moved = keyed.join(latest, hit, "left").drop("_join", "_key")
        new = F.col(f"_of_{i}")
        for c in set(changed[i]) & set(links):
            moved = moved.withColumn(f"_{c}", F.when(new.isNotNull(), new.getField(c)).otherwise(F.col(f"_{c}")))
    reached = [f"_of_{i}" for i in range(len(updates))]
    any_hit = reduce(Column.__or__, [F.col(c).isNotNull() for c in reached])
    return moved.filter(any_hit).select("call_id", "date", *reached)


def apply_hits(calls: DataFrame, hits: DataFrame, updates: Sequence[Update], order_by: str | None = None) -> DataFrame:
    """The calls with the values of ``hits``, in one join on ``call_id``, which must be unique in both."""
    steps = [(f"_of_{i}", u[1], _changed(u, order_by)) for i, u in enumerate(updates)]
    narrow = hits.select(F.col("call_id").alias("_id"), *[c for c, _, _ in steps])
    joined = calls.join(narrow, F.col("call_id") == F.col("_id"), "left")

    def column(name: str):
        value = F.col(name)
        for step, status, changed in steps:
            new = F.col(step)
            if name == "status":
                value = F.when(new.isNotNull(), F.lit(status)).otherwise(value)
            elif name in changed:
                value = F.when(new.isNotNull(), new.getField(name).cast(S.CALL[name].dataType)).otherwise(value)
        return value.alias(name)

    return joined.select(*[column(c) for c in calls.columns])


def apply_chain(calls: DataFrame, outputs: dict[str, DataFrame]) -> DataFrame:
    """All updates of one analysis run as a single lazy plan, as if applied one after the other.

    The steps find their calls on the file names alone: narrow rows meet the step outputs, and the
    call table itself is joined once, on ``call_id``, which must be unique in it.
    """
    updates = [(outputs[step], status, key, data_key) for step, status, key, data_key in UPDATE_CHAIN if step in outputs]
    return apply_hits(calls, chain_hits(calls, updates), updates) if updates else calls
