"""Which snapshots make up the stored tables: one small file per version, switched in one step.

A version is ``_versions/<number>.json`` below the store's folder. It is written under another name and then renamed
to the next number, which fails if that number exists: readers see the version before or the whole new
one, and of two writers that started from the same version one is refused. All file system calls go through
Hadoop's, so any folder that Spark can write to will do.

A version holds, per table, its snapshots (newest last), each with the days or months of it that are current (None: the
whole snapshot), which of the two periods the calls are kept by, and the last batch that each stream has applied.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.sql import SparkSession

Snapshots = dict[str, list[str] | None]


class ConcurrentChange(RuntimeError):
    """Another writer has switched the tables since this change began."""


@dataclass(frozen=True)
class Version:
    number: int = 0
    tables: dict[str, Snapshots] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)
    period: str = "day"

    def to_json(self) -> str:
        return json.dumps(asdict(self), indent=1)


class Folder:
    """Hadoop's view of a folder, from the driver: single small files and directory listings only."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway
        self.root = root.rstrip("/")
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str) -> Any:
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, name: str) -> list[str]:
        """What lies in a folder; nothing if it does not exist."""
        path = self._path(name)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """Make a file that must not exist yet, whole or not at all."""
        aside = f"{name.rpartition('/')[0]}/.{uuid.uuid4().hex}.part"
        stream = self._fs.create(self._path(aside), False)
        stream.write(bytearray(text.encode("utf-8")))
        stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self._gateway.new_array(rename, 1)
        options[0] = rename.NONE  # do not replace
        qualified = self._fs.makeQualified
        try:
            context.rename(qualified(self._path(aside)), qualified(self._path(name)), options)
        except Exception:
            self._fs.delete(self._path(aside), False)
            raise

    def delete(self, name: str) -> None:
        """Remove a folder of this store with all it holds."""
        self._fs.delete(self._path(name), True)


class Manifest:
    """The versions of the tables below ``root``."""

    def __init__(self, spark: SparkSession, root: str, period: str = "day"):
        self.folder, self.period = Folder(spark, root), period

    def _numbers(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.folder.names("_versions") if n.endswith(".json") and n[:-5].isdigit())

    def read(self) -> Version:
        """The current version; number 0 before the first."""
        numbers = self._numbers()
        return self.at(numbers[-1]) if numbers else Version(period=self.period)

    def at(self, number: int) -> Version:
        return Version(**json.loads(self.folder.read(f"_versions/{number:012d}.json")))

    def commit(self, base: Version, tables: dict[str, Snapshots], batch: tuple[str, int] | None = None) -> Version:
        """Switch the given tables, in one step, from ``base`` on; the others stay as they are."""
        batches = base.batches | ({batch[0]: batch[1]} if batch else {})
        new = Version(base.number + 1, base.tables | tables, batches, base.period)
        try:
            self.folder.create(f"_versions/{new.number:012d}.json", new.to_json())
        except Exception as e:
            if new.number in self._numbers():
                raise ConcurrentChange(f"version {new.number} of {self.folder.root} exists already; read again and repeat") from e
            raise
        return new

    def forget(self, keep: int = 2) -> list[str]:
        """Remove all but the last ``keep`` versions and the snapshot folders that none of those names."""
        numbers = self._numbers()
        if keep < 1 or not numbers:
            raise ValueError("keep a version or more")
        kept = [self.at(n) for n in numbers[-keep:]]
        gone = []
        for table in {t for v in kept for t in v.tables}:
            used = {s for v in kept for s in v.tables.get(table, {})}
            oldest = min(used, default=None)
            for name in self.folder.names(table):
                # Newer folders may belong to a writer that has not switched yet.
                if name not in used and oldest is not None and name < oldest:
                    self.folder.delete(f"{table}/{name}")
                    gone.append(f"{table}/{name}")
        for n in numbers[:-keep]:
            self.folder.delete(f"_versions/{n:012d}.json")
        return gone
