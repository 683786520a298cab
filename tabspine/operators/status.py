"""Latest-row operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_rows(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` values in each group.

    The row number limit is applied before the shuffle as well, so each task sends one row per group and a group
    that holds a third of the table stays cheap.
    """
    newest_first = Window.partitionBy(*by).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("_nth", F.row_number().over(newest_first)).filter("_nth = 1").drop("_nth")


def latest_row(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The single row with the greatest ``order`` values; no row for an empty table."""
    return df.orderBy(*[F.col(c).desc_nulls_last() for c in order]).limit(1)


def latest_version(df: DataFrame, by: Sequence[str], version_col: str) -> DataFrame:
    """Per group, the version text with the greatest integer value."""
    newest = F.max_by(version_col, F.col(version_col).try_cast("long")).alias(version_col)
    return df.groupBy(*by).agg(newest) if by else df.agg(newest)
