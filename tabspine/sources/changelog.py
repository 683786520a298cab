"""Append-only log of the row changes of a keyed table, one folder for each version fed to it.

Changes are staged before the version they lead to is published, and join the log by a rename afterwards. A crash in between
leaves them staged: whoever comes next lets the changes of a published version join. So the log misses no version, and shows
none that was never published.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabspine.operators.upsert import change_feed
from tabspine.sources.tables import VersionedTable

VERSION = "_commit_version"


@dataclass(frozen=True)
class ChangeLog:
    """Changes of version n lie in ``<path>/log/_commit_version=n``; those not yet of the log in ``<path>/staged/n-from``."""

    spark: SparkSession
    path: str
    key: str

    def _hadoop(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._hadoop(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str, pattern: str) -> list[re.Match]:
        fs, root = self._fs(), self._hadoop(f"{self.path}/{folder}")
        names = [status.getPath().getName() for status in fs.listStatus(root)] if fs.exists(root) else []
        return sorted(filter(None, (re.fullmatch(pattern, n) for n in names)), key=lambda m: int(m[1]))

    def exists(self) -> bool:
        """Whether any changes were logged."""
        return bool(self._names("log", rf"{VERSION}=(\d+)"))

    @property
    def fed(self) -> int:
        """The last version that the log leads to, 0 before the first; changes are told from the version it started at."""
        return max((int(m[1]) for folder, p in (("log", rf"{VERSION}=(\d+)"), ("start", r"(\d+)")) for m in self._names(folder, p)), default=0)

    def start(self, version: int) -> None:
        """Tell changes from this version on."""
        self._fs().mkdirs(self._hadoop(f"{self.path}/start/{version}"))

    def stage(self, before: DataFrame, after: DataFrame, version: int) -> None:
        """Write the changes that lead from the version fed last to ``version``, which is about to be published."""
        self._write(before, after, f"{version:09d}-{self.fed:09d}")

    def _write(self, before: DataFrame, after: DataFrame, name: str) -> None:
        change_feed(before, after, self.key).write.mode("overwrite").parquet(f"{self.path}/staged/{name}")

    def settle(self, table: VersionedTable) -> None:
        """Staged changes of published versions join the log, in order of the versions.

        Changes staged before another writer published a version in between are told anew from that one.
        """
        fs, published = self._fs(), table.versions()
        for m in self._names("staged", r"(\d{9})-(\d{9})"):
            version, before = int(m[1]), int(m[2])
            staged = self._hadoop(f"{self.path}/staged/{m[0]}")
            if version <= self.fed:
                fs.delete(staged, True)
                continue
            if version not in published:
                continue
            if before != self.fed or not fs.exists(self._hadoop(f"{self.path}/staged/{m[0]}/_SUCCESS")):
                self._write(table.read(self.fed), table.read(version), m[0])
            self._fs().mkdirs(self._hadoop(f"{self.path}/log"))
            fs.rename(staged, self._hadoop(f"{self.path}/log/{VERSION}={version}"))

    def catch_up(self, table: VersionedTable) -> None:
        """Settle, and log what other writers have published since the version fed last."""
        self.settle(table)
        if not table.exists():
            return
        if not self.fed:
            self.start(table.version)
        elif table.version > self.fed:
            self.stage(table.read(self.fed), table.read(), table.version)
            self.settle(table)

    def read(self, after: int = 0) -> DataFrame:
        """All logged changes of versions beyond ``after``, with the version each leads to; a column that some versions lack is null there."""
        rows = self.spark.read.option("mergeSchema", "true").parquet(f"{self.path}/log")
        return rows.withColumn(VERSION, F.col(VERSION).cast("long")).filter(F.col(VERSION) > after)

    def stream(self, files_per_batch: int | None = None) -> DataFrame:
        """The log as a stream: each version's changes arrive when they are logged."""
        schema = T.StructType([f for f in self.read().schema if f.name != VERSION]).add(VERSION, "long")
        reader = self.spark.readStream.schema(schema)
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        return reader.parquet(f"{self.path}/log")
