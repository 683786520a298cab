"""Permutation importance over a whole holdout."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def permuted_rows(
    df: DataFrame, key: str, features: Sequence[str], repeats: int = 3, seed: int = 42, block_rows: int = 100_000,
    rows: int | None = None,
) -> DataFrame:
    """Each row ``repeats`` times with ``_donor``, the features of another row drawn without replacement.

    Rows stand in a ring ordered by a seeded hash, and the donor is the next row. Blocks are ranges of the hash, even because keys
    are unique, so this is one balanced shuffle; a block's last row takes the first of the next block from a table with one
    row per block. So the result is the same for every number of blocks.
    """
    total = df.count() if rows is None else rows
    blocks = max(1, math.ceil(total / block_rows))
    repeat = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("_repeat")
    place = F.md5(F.concat_ws("|", F.col("_repeat").cast("string"), F.lit(str(seed)), F.col(key).cast("string")))
    block = F.floor(F.conv(F.substring("_order", 1, 8), 16, 10).cast("long") * blocks / (1 << 32))
    spread = df.select("*", repeat).withColumn("_order", place).withColumn("_block", block)
    ring = Window.partitionBy("_repeat", "_block").orderBy("_order", key)
    own = F.struct(*features)
    firsts = spread.groupBy("_repeat", "_block").agg(F.min_by(own, F.struct("_order", key)).alias("_first"))
    around = Window.partitionBy("_repeat").orderBy("_block")
    start = F.first("_first").over(around.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    following = firsts.select("_repeat", "_block", F.coalesce(F.lead("_first").over(around), start).alias("_following"))
    paired = spread.withColumn("_next", F.lead(own).over(ring)).join(following, ["_repeat", "_block"])
    return paired.withColumn("_donor", F.coalesce("_next", "_following")).drop("_block", "_order", "_next", "_following")


def permutation_importance(
    df: DataFrame,
    key: str,
    label: str,
    features: Sequence[str],
    score: Callable[[DataFrame], DataFrame],
    repeats: int = 3,
    seed: int = 42,
    threshold: float = 0.5,
) -> DataFrame:
    """(feature, repeat, importance): accuracy lost when one feature comes from the donor row.

    ``score`` adds a ``score`` column to a frame with the features. Every row is exploded into its unchanged form and one
    form per feature where it stands, scored in one pass, and only the counts per (feature, repeat) are shuffled.
    """
    features = list(features)
    permuted = permuted_rows(df.select(key, label, *features), key, features, repeats, seed)
    forms = permuted.select("*", F.explode(F.sequence(F.lit(-1), F.lit(len(features) - 1))).alias("_changed"))
    variants = forms.select(
        key,
        label,
        F.col("_repeat").alias("repeat"),
        "_changed",
        *[F.when(F.col("_changed") == i, F.col("_donor")[c]).otherwise(F.col(c)).alias(c) for i, c in enumerate(features)],
    )
    right = F.avg(((F.col("score") >= threshold).cast("int") == F.col(label)).cast("double"))
    accuracy = score(variants).groupBy("_changed", "repeat").agg(right.alias("accuracy"))
    base = F.max(F.when(F.col("_changed") == -1, F.col("accuracy"))).over(Window.partitionBy("repeat"))
    names = F.array(*[F.lit(c) for c in features])
    return accuracy.withColumn("importance", base - F.col("accuracy")).filter("_changed >= 0").select(
        F.get(names, F.col("_changed")).alias("feature"), "repeat", "importance"
    )


def mean_importance(repeats: DataFrame) -> DataFrame:
    """Mean over the repeats of each feature."""
    return repeats.groupBy("feature").agg(F.avg("importance").alias("importance"))


def importance_table(repeats: DataFrame, model_version: str) -> DataFrame:
    """(model_version, feature, importance, method)."""
    return mean_importance(repeats).select(
        F.lit(model_version).alias("model_version"), "feature", "importance", F.lit("permutation").alias("method")
    )
