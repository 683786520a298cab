"""Leaving out rows by id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabspine.sources.scratch import materialize

#: Ids up to which they are sent to the rows, at 8 bytes each; more are joined by a shuffle.
FEW_IDS = 250_000


def without(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows whose key is not among ``ids``; rows with a null key stay. Rows that repeat a key go or stay together."""
    ids = materialize(ids.select(key).where(F.col(key).isNotNull()).distinct(), "left-out")
    return rows.join(F.broadcast(ids) if ids.count() <= FEW_IDS else ids, key, "left_anti")
