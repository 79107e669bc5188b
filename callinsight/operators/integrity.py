"""Integrity checks of the client, agent and call tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callinsight import schemas as S


def with_schema(df: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """The table's columns in order; a missing column reads as NULL. ``strict``: unknown columns are an error."""
    unknown = sorted(set(df.columns) - set(schema.fieldNames()))
    if strict and unknown:
        raise ValueError(f"not columns of the table: {unknown}")
    return df.select(
        *[
            (F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(key).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)


def column_checks(schema: T.StructType) -> list[tuple[str, str, Column]]:
    """(rule, column, condition of a broken row): NOT NULL, length limits and the domain of the status."""
    checks = []
    for f in schema.fields:
        if f.metadata.get("required"):
            checks.append(("not null", f.name, F.col(f.name).isNull()))
        if "max_length" in f.metadata:
            checks.append(("length", f.name, F.char_length(f.name) > f.metadata["max_length"]))
    if "status" in schema.fieldNames():
        checks.append(("domain", "status", ~F.col("status").isin(S.CALL_STATUSES)))
    return checks


def column_violations(df: DataFrame, schema: T.StructType, table: str) -> DataFrame:
    """Rows that break a rule of their column, counted per rule in one pass."""
    df = with_schema(df, schema)
    checks = column_checks(schema)
    counted = df.agg(*[F.count_if(broken).alias(f"_{i}") for i, (_, _, broken) in enumerate(checks)])
    rows = F.array(
        *[
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(rule).alias("rule"),
                F.lit(column).alias("column_name"),
                F.col(f"_{i}").alias("violations"),
            )
            for i, (rule, column, _) in enumerate(checks)
        ]
    )
    return counted.select(F.inline(rows))


def orphans(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose (known) foreign key has no parent."""
    return children.filter(F.col(key).isNotNull()).join(parents.select(key), key, "left_anti")


def _count(df: DataFrame, table: str, rule: str, column: str, number: Column | None = None) -> DataFrame:
    number = F.count("*") if number is None else number
    return df.agg(number.cast("bigint").alias("violations")).select(
        F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), F.lit(column).alias("column_name"), "violations"
    )


def integrity_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Violations per (table, rule, column); zero where a rule holds."""
    parts = []
    for name, df in tables.items():
        key = S.PRIMARY_KEYS[name]
        parts.append(_count(duplicate_keys(df.filter(F.col(key).isNotNull()), key), name, "primary key", key))
        parts.append(column_violations(df, S.TABLES[name], name))
    for child, key, parent in S.FOREIGN_KEYS:
        if child in tables and parent in tables:
            # Folded per key first: a busy client is one row in the join.
            keys = tables[child].groupBy(key).agg(F.count("*").alias("_rows"))
            lost = orphans(keys, tables[parent], key)
            parts.append(_count(lost, child, "foreign key", key, F.coalesce(F.sum("_rows"), F.lit(0))))
    return reduce(DataFrame.unionByName, parts)


def with_known_people(calls: DataFrame, clients: DataFrame, agents: DataFrame) -> DataFrame:
    """The calls with ``known``: whether their client and agent exist."""
    flagged = calls.join(
        clients.select("client_id", F.lit(True).alias("_client")), "client_id", "left"
    ).join(agents.select("agent_id", F.lit(True).alias("_agent")), "agent_id", "left")
    known = F.col("_client").isNotNull() & F.col("_agent").isNotNull()
    return flagged.select(*calls.columns, known.alias("known"))


def quarantine(calls: DataFrame, clients: DataFrame, agents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls whose client and agent exist, and the others: two lazy halves of ``with_known_people``.

    To use both, write ``with_known_people`` once and filter what was written.
    """
    flagged = with_known_people(calls, clients, agents)
    return flagged.filter("known").drop("known"), flagged.filter("not known").drop("known")
