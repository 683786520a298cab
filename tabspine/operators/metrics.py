"""Classification metrics, exact and distributed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabspine.operators.ordering import range_buckets

METRICS = ("roc_auc", "f1", "accuracy", "eval_rows", "positive_rate")


def classification_metrics(
    df: DataFrame,
    label: str,
    score: str,
    by: Sequence[str] = (),
    threshold: float = 0.5,
    rows_per_bucket: int = 1_000_000,
) -> DataFrame:
    """One row per group: roc_auc, f1, accuracy, eval_rows, positive_rate, and rows lost: without a score, or with a label other than 0 and 1.

    Rows collapse to one per distinct score before anything is ordered. AUC is the tie-averaged rank sum: pairs are
    counted inside score ranges by a window, and between ranges from one total per range.
    """
    by = list(by)
    usable = F.col(score).isNotNull() & F.coalesce(F.col(label).isin(0, 1), F.lit(False)) & ~F.isnan(F.col(score).cast("double"))
    bucket = range_buckets(df.filter(usable), score, rows_per_bucket)
    histogram = (
        df.groupBy(*by, F.when(usable, F.col(score).cast("double")).alias(score))
        .agg(
            F.count_if(usable & (F.col(label) == 1)).alias("_pos"),
            F.count_if(usable & (F.col(label) == 0)).alias("_neg"),
            F.count_if(~usable).alias("_lost"),
        )
        .withColumn("_range", bucket)
    )
    lower = Window.partitionBy(*by, "_range").orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("_neg").over(lower), F.lit(0))
    called = F.col(score) >= threshold
    ranges = (
        histogram.withColumn("_wins", F.col("_pos").cast("double") * (below + F.col("_neg") / 2))
        .groupBy(*by, "_range")
        .agg(
            F.sum("_wins").alias("_wins"),
            F.sum("_pos").alias("_pos"),
            F.sum("_neg").alias("_neg"),
            F.sum("_lost").alias("_lost"),
            F.coalesce(F.sum(F.when(called, F.col("_pos"))), F.lit(0)).alias("_tp"),
            F.coalesce(F.sum(F.when(called, F.col("_neg"))), F.lit(0)).alias("_fp"),
        )
    )
    lower_ranges = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_neg").over(lower_ranges), F.lit(0))
    totals = (
        ranges.withColumn("_wins", F.col("_wins") + F.col("_pos").cast("double") * offset)
        .groupBy(*by)
        .agg(*[F.sum(c).alias(c) for c in ("_wins", "_pos", "_neg", "_lost", "_tp", "_fp")])
    )
    pos, neg, tp, fp = (F.col(c).cast("double") for c in ("_pos", "_neg", "_tp", "_fp"))
    rows = pos + neg
    wrong = fp + (pos - tp)
    return totals.select(
        *by,
        F.when((pos > 0) & (neg > 0), F.col("_wins") / (pos * neg)).alias("roc_auc"),
        F.when(rows > 0, F.when(2 * tp + wrong > 0, 2 * tp / (2 * tp + wrong)).otherwise(0.0)).alias("f1"),
        F.when(rows > 0, (rows - wrong) / rows).alias("accuracy"),
        (F.col("_pos") + F.col("_neg")).alias("eval_rows"),
        F.when(rows > 0, pos / rows).alias("positive_rate"),
        F.col("_lost").alias("lost_rows"),
    )


def long_metrics(wide: DataFrame, by: Sequence[str], names: Sequence[str] = METRICS) -> DataFrame:
    """Metric rows (group..., metric, value) from one wide row per group."""
    doubles = wide.select(*by, *[F.col(n).cast("double").alias(n) for n in names])
    return doubles.unpivot(list(by), list(names), "metric", "value")


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """rows, positives, negatives, positive_rate (null if empty) and class weight (1.0 without positives)."""
    counts = df.agg(F.count("*").alias("rows"), F.count_if(F.col(label) == 1).alias("positives"))
    rows, positives = F.col("rows"), F.col("positives")
    return counts.select(
        rows,
        positives,
        (rows - positives).alias("negatives"),
        F.when(rows > 0, positives / rows).alias("positive_rate"),
        F.when(positives > 0, (rows - positives) / positives).otherwise(1.0).alias("class_weight"),
    )
