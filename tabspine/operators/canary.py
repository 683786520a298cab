"""Splitting rows between two model versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabspine.functions.keys import hash_bucket
from tabspine.operators.metrics import classification_metrics


def canary_arm(key: Column, version: str, previous: str | None, percent: int) -> Column:
    """``version`` for ``percent`` of the keys, else ``previous``; all keys when there is no previous version."""
    if previous is None or percent >= 100:
        return F.lit(version)
    return F.when(hash_bucket(key, 100) < percent, version).otherwise(previous)


def canary_metrics(
    df: DataFrame, key: str, label: str, scores: dict[str, str], version: str, previous: str | None, percent: int
) -> DataFrame:
    """Metrics by arm; ``scores`` names the score column of each version."""
    arm = F.col("model_version")
    routed = df.withColumn("model_version", canary_arm(F.col(key), version, previous, percent))
    pairs = [F.when(arm == v, F.col(c)) for v, c in scores.items()]
    chosen = routed.select("model_version", label, F.coalesce(*pairs).alias("_score"))
    return classification_metrics(chosen, label, "_score", ["model_version"])
