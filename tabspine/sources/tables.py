"""Tables: guarded reads, full replacement, appends, and keyed tables kept as versioned folders.

A :class:`VersionedTable` never overwrites the files it reads. Each write goes to a new numbered folder that
counts only once the write has committed its ``_SUCCESS`` marker, so readers see the old or the new version whole.
"""

from __future__ import annotations

import hashlib
import json
import re
import time
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabspine.operators.fingerprint import Fingerprint, fingerprint_of
from tabspine.operators.status import latest_rows
from tabspine.operators.upsert import newer_rows, overlay_rows, refuse_new_columns


def require_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table; an error if it does not exist."""
    if not spark.catalog.tableExists(name):
        raise LookupError(f"missing table {name}")
    return spark.table(name)


def table_or_none(spark: SparkSession, name: str) -> DataFrame | None:
    return spark.table(name) if spark.catalog.tableExists(name) else None


def replace_table(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] = (),
    path: str | None = None,
    bucket_by: tuple[int, str] | None = None,
) -> None:
    """Replace a catalog table, schema included; with ``path`` its files lie there.

    Tables bucketed alike by key, as ``(buckets, key)``, join on it without a shuffle: worth it for spine and features.
    """
    # Rows of a bucket meet in one task first, so that each bucket becomes one file.
    rows = df.repartition(*bucket_by) if bucket_by else df
    writer = rows.write.mode("overwrite").format("parquet").option("overwriteSchema", "true")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(*bucket_by).sortBy(bucket_by[1])
    writer.saveAsTable(name)


def append_log(df: DataFrame, path: str) -> None:
    """Append rows to a log folder; later rows may carry new columns."""
    df.write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a log folder over the union of their columns."""
    return spark.read.option("mergeSchema", "true").parquet(path)


@dataclass(frozen=True)
class _Part:
    """One committed write: a full version, or a delta over the versions before it."""

    number: int
    is_delta: bool
    tag: str
    path: str


@dataclass(frozen=True)
class VersionedTable:
    """A table stored as ``<path>/v000000001[-tag]`` folders, read at the highest committed number.

    An upsert writes only the changed rows, as a delta folder ``v000000002d[-tag]`` with a ``_deleted`` flag, and reading
    lays the newest deltas over the last full version. Once deltas are many or large, they are folded into a new
    full version, so neither writes nor reads grow with the wrong thing.

    Writers claim a number before they write and may commit in any order; the table is what the writes give in order of their
    numbers. So a fold names the numbers before it that were not committed when it read. If one of them commits later,
    the fold no longer counts, and readers go back to the full version before it and all its deltas, until the next fold.

    With ``buckets``, full versions are bucketed and sorted by the key. The layout is noted with the version and used on reads, so
    tables of as many buckets join by their keys without a shuffle, as long as no deltas lie over them.
    """

    spark: SparkSession
    path: str
    key: str | None = None
    max_deltas: int = 8
    max_delta_share: float = 0.2
    patience: float = 24 * 3600.0
    buckets: int = 0

    def _hadoop(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._hadoop(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _folders(self) -> list[_Part]:
        """Folders of all writes, committed or not, oldest first."""
        fs, root = self._fs(), self._hadoop(self.path)
        names = [status.getPath().getName() for status in fs.listStatus(root)] if fs.exists(root) else []
        found = [m for n in sorted(names) if (m := re.fullmatch(r"v(\d{9})(d?)(?:-(.*))?", n))]
        return [_Part(int(m[1]), m[2] == "d", m[3] or "", f"{self.path}/{m[0]}") for m in found]

    def _committed(self) -> list[_Part]:
        fs = self._fs()
        return [p for p in self._folders() if fs.exists(self._hadoop(f"{p.path}/_SUCCESS"))]

    def _current(self, version: int | None = None) -> list[_Part]:
        """The full version in force and the deltas over it."""
        parts = self._committed()
        if version is not None:
            parts = [p for p in parts if p.number <= version]
        base = self._base(parts)
        if base is None or version not in (None, parts[-1].number):
            raise LookupError(f"missing table {self.path}" + (f" version {version}" if version else ""))
        return [base, *(p for p in parts if p.is_delta and p.number > base.number)]

    def _base(self, parts: Sequence[_Part]) -> _Part | None:
        """The newest full version that holds every committed write before it."""
        numbers = {p.number for p in parts}
        return next((p for p in reversed(parts) if not p.is_delta and not self._missed(p) & numbers), None)

    def _missed(self, part: _Part) -> set[int]:
        """Numbers before a fold that it does not hold; none for a version that replaced the table."""
        return {int(n) for n in (self._read_note(f"_folds/{part.number:09d}") or "").split()}

    def _read_note(self, name: str) -> str | None:
        path, fs = self._hadoop(f"{self.path}/{name}"), self._fs()
        if not fs.exists(path):
            return None
        source = fs.open(path)
        try:
            return bytes(source.readAllBytes()).decode()
        finally:
            source.close()

    def _write_note(self, name: str, text: str, overwrite: bool = False) -> None:
        out = self._fs().create(self._hadoop(f"{self.path}/{name}"), overwrite)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def _bytes(self, parts: Sequence[_Part]) -> int:
        return sum(self._fs().getContentSummary(self._hadoop(p.path)).getLength() for p in parts)

    def _claim(self, number: int):
        return self._hadoop(f"{self.path}/_claims/{number:09d}")

    def reserve(self) -> int:
        """Claim the next version number for a write."""
        number = max((p.number for p in self._folders()), default=0) + 1
        while not self._fs().createNewFile(self._claim(number)):
            number += 1  # another writer has it
        return number

    def _write(self, df: DataFrame, is_delta: bool, tag: str | None, partition_by: Sequence[str] = (), number: int | None = None) -> int:
        number = number or self.reserve()
        name = f"v{number:09d}{'d' if is_delta else ''}" + (f"-{tag}" if tag else "")
        bucketed = bool(self.buckets and self.key and not is_delta)
        inner = [f for f in df.schema.fields if f.name not in partition_by]
        schema = T.StructType([*inner, *(df.schema[c] for c in partition_by)])
        about = {"schema": schema.jsonValue(), "partition_by": list(partition_by), "buckets": self.buckets if bucketed else 0, "key": self.key}
        self._write_note(f"_about/{number:09d}", json.dumps(about))
        if bucketed:
            # Rows of a bucket meet in one task, so that each bucket becomes one file.
            writer = df.repartition(self.buckets, self.key).write.bucketBy(self.buckets, self.key).sortBy(self.key)
            writer = writer.partitionBy(*partition_by) if partition_by else writer
            writer.format("parquet").option("path", f"{self.path}/{name}").saveAsTable(self._catalog_name(name))
        else:
            (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(f"{self.path}/{name}")
        if not self._fs().exists(self._claim(number)):
            self._fs().delete(self._hadoop(f"{self.path}/{name}"), True)
            raise RuntimeError(f"write {number} of {self.path} took longer than {self.patience:g} seconds and was given up")
        return number

    def _fold(self) -> int:
        """Write a full version of what is committed now."""
        number = self.reserve()
        parts = self._current()
        held = {p.number for p in self._committed()}
        missed = {n for n in range(parts[0].number + 1, number) if n not in held} | (self._missed(parts[0]) - held)
        self._write_note(f"_folds/{number:09d}", " ".join(map(str, sorted(missed))))
        known = self._read_note(self._print_of(parts))
        if known is not None:
            self._write_note(f"_prints/{number}", known, overwrite=True)
        partition_by = json.loads(self._read_note(f"_about/{parts[0].number:09d}") or '{"partition_by": []}')["partition_by"]
        return self._write(self._laid(parts), False, None, partition_by, number)

    @property
    def version(self) -> int:
        """Current version number, 0 before the first write."""
        return max((p.number for p in self._committed()), default=0)

    def versions(self) -> set[int]:
        """Numbers of all committed writes that are still there."""
        return {p.number for p in self._committed()}

    def exists(self) -> bool:
        return self.version > 0

    def has_tag(self, tag: str) -> bool:
        """Whether some committed write carries this tag."""
        return any(p.tag == tag for p in self._committed())

    def owner(self, name: str, candidate: str) -> str:
        """Who was first to write under this name; the candidate if nobody was before."""
        if self._read_note(f"_streams/{name}") is None:
            self._write_note(f"_streams/{name}", candidate)
        return self._read_note(f"_streams/{name}")

    def read(self, version: int | None = None) -> DataFrame:
        """The current version, or a given one."""
        return self._laid(self._current(version))

    def _laid(self, parts: Sequence[_Part]) -> DataFrame:
        """Deltas laid over a full version."""
        base, *deltas = parts
        return overlay_rows(self._rows(base), self._changes(deltas), self.key) if deltas else self._rows(base)

    def _changes(self, deltas: Sequence[_Part]) -> DataFrame:
        """The last change of each key."""
        read = [self._rows(p).withColumn("_number", F.lit(p.number)) for p in deltas]
        return latest_rows(reduce(DataFrame.unionByName, read), [self.key], ["_number"]) if len(read) > 1 else read[0]

    def _rows(self, part: _Part) -> DataFrame:
        """What one write has written."""
        note = self._read_note(f"_about/{part.number:09d}")
        if note is None:
            return self.spark.read.parquet(part.path)
        about = json.loads(note)
        schema = T.StructType.fromJson(about["schema"])
        if not about["buckets"]:
            return self.spark.read.schema(schema).parquet(part.path)
        name, key = self._catalog_name(part.path.rsplit("/", 1)[-1]), about["key"]
        if not self.spark.catalog.tableExists(name):
            parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in about['partition_by'])})" if about["partition_by"] else ""
            place = part.path.replace("'", "\\'")
            self.spark.sql(
                f"CREATE TABLE {name} ({schema.toDDL()}) USING parquet {parts} "
                f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {about['buckets']} BUCKETS LOCATION '{place}'"
            )
            if parts:
                self.spark.catalog.recoverPartitions(name)
        return self.spark.table(name)

    def _catalog_name(self, folder: str) -> str:
        """Name under which a session's catalog knows a bucketed folder."""
        return "tabspine_" + hashlib.md5(f"{self.path}/{folder}".encode()).hexdigest()

    def fingerprint(self) -> Fingerprint:
        """Fingerprint of the current rows: that of the last state that has one, updated by the rows that deltas since then changed.

        It is noted for the state, so only rows that a delta touched are hashed again, not the table.
        """
        parts = self._current()
        for n in range(len(parts), 0, -1):
            note = self._read_note(self._print_of(parts[:n]))
            if note is not None:
                known = Fingerprint.parse(note)
                break
        else:
            n, known = 1, fingerprint_of(self._laid(parts[:1]))
        if n < len(parts):
            before, changes = self._laid(parts[:n]), self._changes(parts[n:])
            columns = before.columns
            known -= fingerprint_of(before.join(changes.select(self.key), self.key, "left_semi").select(*columns))
            known += fingerprint_of(changes.filter(~F.col("_deleted")).select(*columns))
        self._write_note(self._print_of(parts), str(known), overwrite=True)
        return known

    def _print_of(self, parts: Sequence[_Part]) -> str:
        return "_prints/" + "-".join(str(p.number) for p in parts)

    def replace(self, df: DataFrame, tag: str | None = None, partition_by: Sequence[str] = (), number: int | None = None) -> int:
        """Write a whole new version, under a reserved number if one is given, and return its number."""
        return self._write(df, False, tag, partition_by, number)

    def apply(self, df: DataFrame, tag: str | None = None, unique: bool = False) -> int:
        """Write changed rows, unique by key and flagged ``_deleted`` or not; a tag already committed is left alone.

        A caller that made the keys ``unique`` spares the look for repeated ones.
        """
        if self.key is None:
            raise ValueError(f"table {self.path} has no key")
        if tag and self.has_tag(tag):
            return self.version
        known = self.read()
        refuse_new_columns(known, df)
        self._require_keys(df, unique)
        number = self._write(df.select(*known.columns, "_deleted"), True, tag)
        base, *deltas = self._current()
        if len(deltas) > self.max_deltas or self._bytes(deltas) > self.max_delta_share * self._bytes([base]):
            number = self._fold()
        return number

    def _require_keys(self, df: DataFrame, unique: bool = False) -> None:
        """An error if a key is null or has several rows."""
        null = F.col(self.key).isNull()
        bad = df.filter(null) if unique else df.groupBy(self.key).agg(F.count("*").alias("n")).filter((F.col("n") > 1) | null)
        if not bad.isEmpty():
            raise ValueError(f"null or repeated {self.key} in the rows for {self.path}")

    def upsert(self, df: DataFrame, tag: str | None = None, newer_by: Sequence[str] = (), unique: bool = False) -> int:
        """Insert new keys and update known ones; with ``newer_by``, only by rows that are not older than the known one."""
        if tag and self.has_tag(tag):
            return self.version
        if not self.exists():
            self._require_keys(df, unique)
            return self.replace(df, tag)
        if newer_by:
            known = self.read()
            refuse_new_columns(known, df)
            df = newer_rows(known, df, self.key, newer_by)
        return self.apply(df.withColumn("_deleted", F.lit(False)), tag, unique)

    def vacuum(self, keep: int = 2) -> int:
        """Delete what lies before the newest ``keep`` full versions; returns how many folders went.

        What a fold has missed may still be on its way. Such a claim keeps all that readers need if it commits, until it is
        older than ``patience`` seconds; then it is taken back, and its writer is told so.
        """
        parts = self._committed()
        full = [p for p in parts if not p.is_delta][-max(keep, 1) :]
        base = self._base(parts)
        if base is None:
            return 0
        first = min(base.number, full[0].number)
        if any([self._may_commit(n) for p in parts if not p.is_delta and p.number >= first for n in self._missed(p)]):
            return 0
        old = [p for p in parts if p.number < first]
        for part in old:
            self._fs().delete(self._hadoop(part.path), True)
            self.spark.sql(f"DROP TABLE IF EXISTS {self._catalog_name(part.path.rsplit('/', 1)[-1])}")
        return len(old)

    def _may_commit(self, number: int) -> bool:
        claim, fs = self._claim(number), self._fs()
        if not fs.exists(claim):
            return False
        if time.time() - fs.getFileStatus(claim).getModificationTime() / 1000 <= self.patience:
            return True
        fs.delete(claim, False)
        return False
