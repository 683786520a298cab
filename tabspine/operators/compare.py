"""Challenger against champion on metric rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compare_decision(
    challenger: Column, champion: Column, champion_exists: Column, higher_is_better: bool = True, margin: float = 0.0
) -> Column:
    """``go``, ``no-go``, or ``error`` for a missing metric; a first version always goes."""
    better = challenger >= champion + margin if higher_is_better else challenger <= champion - margin
    return (
        F.when(~champion_exists, "go")
        .when(challenger.isNull() | champion.isNull() | F.isnan(challenger) | F.isnan(champion), "error")
        .when(better, "go")
        .otherwise("no-go")
    )


def compare_versions(
    challenger: DataFrame,
    champion: DataFrame | None,
    metric: str = "roc_auc",
    by: Sequence[str] = (),
    higher_is_better: bool = True,
    margin: float = 0.0,
) -> DataFrame:
    """One decision per segment from two long metric tables; ``champion=None`` means there is none yet.

    A champion table that lacks the metric is an error, never a pass. Without segments there is always one row.
    """
    keys = [*by, "metric"]
    new = challenger.filter(F.col("metric") == metric).select(*keys, F.col("value").alias("challenger"))
    if champion is None:
        pairs = new.withColumn("champion", F.lit(None).cast("double"))
    else:
        old = champion.filter(F.col("metric") == metric).select(*keys, F.col("value").alias("champion"))
        pairs = new.join(old, keys, "full_outer")
    if not by:
        named = challenger.sparkSession.range(1).select(F.lit(metric).alias("metric"))
        pairs = named.join(pairs, "metric", "left")
    exists = F.lit(champion is not None)
    decision = compare_decision(F.col("challenger"), F.col("champion"), exists, higher_is_better, margin)
    return pairs.select(
        *keys, "challenger", "champion", decision.alias("result"), (~exists).alias("first_version")
    )
