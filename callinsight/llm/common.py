"""Helpers shared by the training-data operators.

Rules that hold for all of them: a NULL text counts as empty, a NULL ``doc_id`` sorts after every other
id and comes back as NULL, an empty table gives an empty result, and columns that an operator does not
name are never read, whatever they are called.
"""

from __future__ import annotations

import gc
import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Functions of this package travel to the workers with their code: nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules["callinsight.llm"])

#: Stands for a NULL id inside a plan, so that joins meet it and orderings put it last.
NO_ID = (1 << 63) - 1


#: Folders made within the ``scratch`` blocks that are open, innermost last.
_scratch: list[list[str]] = []


def shared_folder(spark: SparkSession, name: str, keep: bool = False) -> str:
    """A new folder below ``spark.checkpoint.dir``, which every executor can reach.

    Where the setting is missing a local session is given a temporary folder first; on a cluster, whose machines
    do not share one, that is an error. Within ``scratch`` the folder goes at the end of the block, unless ``keep``.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="callinsight-")
        spark.sparkContext.setCheckpointDir(root)
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _scratch and not keep:
        _scratch[-1].append(path)
    return path


def written(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and no executor is needed to read it again."""
    path = shared_folder(df.sparkSession, name, keep)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Have Spark remove the shuffle files of plans that nothing refers to any more."""
    gc.collect()
    spark._jvm.System.gc()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes the folders made within the block at its end; what is to outlive it is written with ``keep``."""
    _scratch.append([])
    try:
        yield
    finally:
        conf = spark._jsc.hadoopConfiguration()
        for path in _scratch.pop():
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)
        release(spark)


def fresh(name: str, df: DataFrame) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def columns(df: DataFrame) -> list[Column]:
    """All columns of ``df``, whatever characters their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def least_row(rows: DataFrame, keys: list[str], user: DataFrame) -> DataFrame:
    """One of the rows of each combination of ``keys``, with the columns of ``user`` alone: the least by all its columns.

    Folded inside the tasks first, so rows that repeat by the million are one row a task."""
    mine = columns(user)
    order = F.to_json(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(mine)])) if mine else F.lit("")
    picked = rows.groupBy(*keys).agg(F.min_by(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(mine)]), order).alias("_row"))
    return picked.select(*[F.col(f"_row.c{i}").alias(c) for i, c in enumerate(user.columns)])


def internal_id(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


def external_id(column: str) -> Column:
    return F.when(F.col(column) != NO_ID, F.col(column))


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def per_worker(key: str, make: Callable[[], Any]) -> Any:
    """What ``make`` returns, made once in each Python worker process and kept between its tasks."""
    kept = sys.modules.setdefault("callinsight_worker", types.ModuleType("callinsight_worker")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]
