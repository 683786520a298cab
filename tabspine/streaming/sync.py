"""Triggered incremental sync of changed rows into keyed tables.

Each trigger takes whatever arrived since the last one (``availableNow``) and stops. A batch is applied under a tag made
of the stream's name, the identity of its checkpoint and the batch number, so a batch that is replayed after a failure is not
applied twice, and a new checkpoint's batches are applied anew.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tabspine.config import Config
from tabspine.operators.engineer import feature_frame
from tabspine.operators.scoring import prediction_rows
from tabspine.operators.status import latest_rows
from tabspine.operators.upsert import changed_rows, final_changes, newer_rows
from tabspine.sources.tables import VersionedTable


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """Stream of the files in a folder."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def run_available(stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Apply everything that has arrived, batch by batch, then stop."""
    query = (
        stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def _checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """Identity of a stream's checkpoint: a new one numbers its batches anew, over other files."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/metadata")
    source = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        return json.loads(source.readLine())["id"][:13]
    finally:
        source.close()


def _tag(table: VersionedTable, name: str, checkpoint: str, number: int) -> str:
    """Tag of a batch: name and number for the first checkpoint that fed the table, its identity between them for any other."""
    own = _checkpoint_id(table.spark, checkpoint)
    return f"{name}-{number}" if table.owner(name, own) == own else f"{name}-{own}-{number}"


def sync_rows(
    stream: DataFrame, table: VersionedTable, sequence: Sequence[str], checkpoint: str, name: str = "sync"
) -> None:
    """Keep the newest row of each key, by ``sequence``, whatever order the files arrive in."""

    def apply(batch: DataFrame, number: int) -> None:
        tag = _tag(table, name, checkpoint, number)
        if table.has_tag(tag):
            return
        newest = latest_rows(batch, [table.key], sequence)
        if not table.exists():
            table.upsert(newest, tag, unique=True)
            return
        # A new checkpoint brings known rows again: what would change nothing is not written.
        changed = changed_rows(table.read(), newest, table.key, sequence).persist()
        try:
            if not changed.isEmpty():
                table.upsert(changed, tag, unique=True)
        finally:
            changed.unpersist()

    run_available(stream, apply, checkpoint)


def sync_changes(
    stream: DataFrame, table: VersionedTable, sequence: Sequence[str], checkpoint: str, name: str = "changes"
) -> None:
    """Apply a change feed, deletes included, to a table that exists. Batches must come in order."""

    def apply(batch: DataFrame, number: int) -> None:
        tag = _tag(table, name, checkpoint, number)
        if table.has_tag(tag):
            return
        known = table.read().columns
        final = final_changes(batch, table.key, sequence)
        table.apply(final.drop(*(c for c in sequence if c not in known)), tag, unique=bool(sequence))

    run_available(stream, apply, checkpoint)


def refresh_features(
    stream: DataFrame,
    features: VersionedTable,
    predictions: VersionedTable,
    scorer: Callable[[DataFrame], DataFrame],
    model_version: str,
    sequence: Sequence[str],
    checkpoint: str,
    as_of: datetime | str | None = None,
    config: Config = Config(),
    name: str = "refresh",
) -> None:
    """Daily refresh: new raw rows, the newest by ``sequence`` per key, become features and renew the predictions.

    The sequence that each key was last refreshed at is kept beside the feature table, so a row that arrives late, in whatever
    batch, changes neither features nor predictions; one of equal sequence does.
    """
    key = config.roles.id_col
    applied = refreshed_at(features)

    def apply(batch: DataFrame, number: int) -> None:
        tag = _tag(features, name, checkpoint, number)
        if applied.has_tag(tag):
            return
        newest = latest_rows(batch, [key], sequence)
        if applied.exists():
            newest = newer_rows(applied.read(), newest, key, sequence)
        newest = newest.persist()
        try:
            fresh = feature_frame(newest, config.roles)
            features.upsert(fresh, tag, unique=True)
            predictions.upsert(prediction_rows(scorer(fresh), key, model_version, as_of), tag)
            # Last: a batch that fails before is taken again, and finds the same rows newer.
            applied.upsert(newest.select(*dict.fromkeys([key, *sequence])), tag, unique=True)
        finally:
            newest.unpersist()

    run_available(stream, apply, checkpoint)


def refreshed_at(features: VersionedTable) -> VersionedTable:
    """Keys of a feature table with the sequence they were last refreshed at."""
    return VersionedTable(features.spark, f"{features.path}/_sequences", features.key)
