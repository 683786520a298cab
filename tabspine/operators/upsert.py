"""Keyed upsert and change feed between snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabspine.operators.status import latest_rows


def newer_rows(target: DataFrame, source: DataFrame, key: str, newer_by: Sequence[str]) -> DataFrame:
    """Source rows whose key is new or whose ``newer_by`` values are not less than the target's.

    Only target rows with a source key are compared; a small source is broadcast by size to find them.
    """
    touched = target.select(key, *newer_by).join(source.select(key), key, "left_semi")
    known = touched.select(F.col(key).alias("_key"), F.struct(*newer_by).alias("_known"))
    return (
        source.join(known, F.col(key) == F.col("_key"), "left")
        .filter(F.col("_known").isNull() | (F.struct(*newer_by) >= F.col("_known")))
        .select(*source.columns)
    )


def changed_rows(target: DataFrame, source: DataFrame, key: str, newer_by: Sequence[str]) -> DataFrame:
    """Source rows that are not older than the target's row with the same key, and differ from it."""
    touched = target.join(source.select(key), key, "left_semi")
    known = touched.select(F.col(key).alias("_key"), F.struct(*newer_by).alias("_known"), F.struct(*target.columns).alias("_row"))
    newer = (F.struct(*newer_by) >= F.col("_known")) & ~F.struct(*target.columns).eqNullSafe(F.col("_row"))
    joined = source.select(*target.columns).join(known, F.col(key) == F.col("_key"), "left")
    return joined.filter(F.col("_known").isNull() | newer).select(*target.columns)


def overlay_rows(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Target with changed rows, unique by key, in place of the rows with the same key; ``_deleted`` ones remove it.

    Small changes are broadcast by size, and then the target is not shuffled.
    """
    kept = target.join(changes.select(key), key, "left_anti").select(*target.columns)
    return kept.unionByName(changes.filter(~F.col("_deleted")).select(*target.columns))


def refuse_new_columns(target: DataFrame, source: DataFrame) -> None:
    """An error if the source has columns that the target would lose; names that begin with ``_`` are bookkeeping."""
    lost = [c for c in source.columns if c not in target.columns and not c.startswith("_")]
    if lost:
        raise ValueError(f"columns that the table does not have: {', '.join(lost)}")


def upsert_rows(target: DataFrame, source: DataFrame, key: str, newer_by: Sequence[str] = ()) -> DataFrame:
    """Target with source rows inserted or put in place of the row with the same key. Source keys must be unique.

    With ``newer_by`` a source row only replaces a target row whose ``newer_by`` values are not greater.
    """
    refuse_new_columns(target, source)
    rows = source.select(*target.columns)
    if newer_by:
        rows = newer_rows(target, rows, key, newer_by)
    return overlay_rows(target, rows.withColumn("_deleted", F.lit(False)), key)


def change_feed(before: DataFrame, after: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Row changes between two snapshots: insert, delete, and both images of an update.

    One full outer join on the unique key; unchanged rows leave before the images are exploded. A column that only one
    snapshot has is null in the other. A null key is an error, as in upserts.
    """
    columns = list(columns or dict.fromkeys(c for c in [*after.columns, *before.columns] if c != key))
    kinds = {**dict(before.dtypes), **dict(after.dtypes)}
    before, after = (
        frame.withColumns({c: F.lit(None).cast(kinds[c]) for c in columns if c not in frame.columns}) for frame in (before, after)
    )
    image = F.struct(*columns)
    old = before.select(F.col(key), image.alias("_old"))
    new = after.select(F.col(key), image.alias("_new"))
    both = old.join(new, key, "full_outer").filter(~F.col("_old").eqNullSafe(F.col("_new")))

    def entry(kind: str, side: str):
        return F.struct(F.lit(kind).alias("change"), F.col(side).alias("image"))

    images = (
        F.when(F.col("_old").isNull(), F.array(entry("insert", "_new")))
        .when(F.col("_new").isNull(), F.array(entry("delete", "_old")))
        .otherwise(F.array(entry("update_preimage", "_old"), entry("update_postimage", "_new")))
    )
    named = F.coalesce(F.col(key), F.raise_error(F.lit(f"null {key} in a snapshot")).cast(kinds[key])).alias(key)
    return both.select(named, F.inline(images)).select(key, F.col("change").alias("_change_type"), "image.*")


def final_changes(changes: DataFrame, key: str, sequence: Sequence[str] = ()) -> DataFrame:
    """One row per key of a change feed, its last change, flagged ``_deleted`` where that is a delete."""
    effective = changes.filter(F.col("_change_type") != "update_preimage")
    if sequence:
        effective = latest_rows(effective, [key], list(sequence))
    return effective.withColumn("_deleted", F.col("_change_type") == "delete")


def apply_changes(target: DataFrame, changes: DataFrame, key: str, sequence: Sequence[str] = ()) -> DataFrame:
    """Target after a change feed: the last change per key decides, a delete removes the key."""
    return overlay_rows(target, final_changes(changes, key, sequence), key)
