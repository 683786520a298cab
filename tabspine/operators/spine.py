"""Joins between the label spine, the feature table and scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabspine.config import Roles
from tabspine.operators.ordering import range_buckets


def label_spine(raw: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Key, split and label."""
    return raw.select(roles.id_col, roles.split_col, roles.label_col)


def lookup_features(
    keys: DataFrame, features: DataFrame, key: str, columns: Sequence[str], keep_key: bool = True
) -> DataFrame:
    """Every row of ``keys`` with the chosen feature columns, null where the key has none."""
    joined = keys.join(features.select(key, *columns), key, "left")
    return joined if keep_key else joined.drop(key)


def training_frame(
    spine: DataFrame,
    features: DataFrame,
    split: str,
    roles: Roles = Roles(),
    columns: Sequence[str] | None = None,
    keep_key: bool = False,
) -> DataFrame:
    """Label and looked-up features of one split."""
    rows = spine.filter(F.col(roles.split_col) == split).select(roles.id_col, roles.label_col)
    return lookup_features(rows, features, roles.id_col, columns or roles.model_features, keep_key)


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).dropDuplicates()


def prediction_inputs(raw: DataFrame, features: DataFrame, key: str) -> DataFrame:
    """Features of the distinct raw keys that have any."""
    return distinct_keys(raw, key).join(features, key, "inner")


def missing_keys(keys: DataFrame, features: DataFrame, key: str) -> DataFrame:
    """Keys without a row in the feature table."""
    return keys.select(key).join(features.select(key), key, "left_anti")


def labelled_scores(labels: DataFrame, scored: DataFrame, key: str) -> DataFrame:
    """Labels with their scores, as a left join: a label whose score got lost stays, with a null score."""
    return labels.join(scored, key, "left")


def alignment_counts(raw: DataFrame, features: DataFrame, spine: DataFrame, split: str, roles: Roles = Roles()) -> DataFrame:
    """One row of counts that say whether raw, feature table and spine line up for a split.

    The three key columns are tagged, stacked and grouped once: one shuffle of keys, pre-aggregated per task.
    """
    key, in_split = roles.id_col, F.col(roles.split_col) == split

    def tagged(df: DataFrame, raw_n: int, feature_n: int, spine_n: int) -> DataFrame:
        return df.select(key, F.lit(raw_n).alias("r"), F.lit(feature_n).alias("f"), F.lit(spine_n).alias("s"))

    stacked = (
        tagged(raw.filter(in_split), 1, 0, 0)
        .unionByName(tagged(features, 0, 1, 0))
        .unionByName(tagged(spine.filter(in_split), 0, 0, 1))
    )
    per_key = stacked.groupBy(key).agg(F.sum("r").alias("r"), F.sum("f").alias("f"), F.sum("s").alias("s"))
    return per_key.agg(
        F.coalesce(F.sum("r"), F.lit(0)).alias("raw_rows"),
        F.coalesce(F.sum("s"), F.lit(0)).alias("spine_rows"),
        F.coalesce(F.sum(F.when(F.col("f") != 1, F.col("r"))), F.lit(0)).alias("raw_without_features"),
        F.count_if((F.col("r") > 0) & (F.col("s") == 0)).alias("raw_without_spine"),
        F.count_if((F.col("s") > 0) & (F.col("r") == 0)).alias("spine_without_raw"),
    )


def as_of_lookup(
    spine: DataFrame,
    features: DataFrame,
    key: str,
    spine_time: str,
    feature_time: str,
    columns: Sequence[str],
    rows_per_bucket: int = 1_000_000,
) -> DataFrame:
    """Each spine row with the feature values known at its time: the latest feature row not after it.

    (key, time) must be unique among the features. Time is cut into buckets, so even one key with most of the rows spreads over
    many tasks. Spine rows go through one shuffle, by (key, bucket), together with the feature rows: a window carries the
    last value inside a bucket. Across buckets one value per (key, bucket) is carried; these come from rows combined in their
    tasks, and join where the spine rows already lie. Rows of one key and one instant stay in one bucket. Rows without a key or
    a time have no values.
    """
    value, key_col = F.struct(*columns), F.col(key)
    known = features.filter(key_col.isNotNull() & F.col(feature_time).isNotNull()).select(
        key_col, F.col(feature_time).alias("_at"), F.lit(0).alias("_side"), value.alias("_value")
    )
    kind = known.schema["_value"].dataType
    times = known.select("_at").unionByName(spine.select(F.col(spine_time).alias("_at")))
    bucket = range_buckets(times, "_at", rows_per_bucket).alias("_bucket")
    known = known.select("*", bucket)
    placed = key_col.isNotNull() & F.col(spine_time).isNotNull()
    asked = spine.filter(placed).select(key, F.col(spine_time).alias("_at"), F.struct(*spine.columns).alias("_row")).select("*", bucket)
    merged = known.withColumn("_row", F.lit(None).cast(asked.schema["_row"].dataType)).unionByName(
        asked.withColumns({"_side": F.lit(1), "_value": F.lit(None).cast(kind)})
    )
    in_bucket = (
        Window.partitionBy(key, "_bucket").orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    walked = merged.withColumn("_here", F.last("_value", ignorenulls=True).over(in_bucket)).filter("_side = 1")
    ends = known.select(key, "_bucket", "_at", "_value", F.lit(0).alias("_asked")).unionByName(
        asked.select(key, "_bucket", F.lit(None).cast(known.schema["_at"].dataType).alias("_at"), F.lit(None).cast(kind).alias("_value"), F.lit(1).alias("_asked"))
    )
    ends = ends.groupBy(key, "_bucket").agg(F.max_by("_value", "_at").alias("_newest"), F.max("_asked").alias("_asked"))
    earlier = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_carried", F.last("_newest", ignorenulls=True).over(earlier)).filter("_asked = 1 AND _carried IS NOT NULL")
    found = walked.join(carried.select(key, "_bucket", "_carried"), [key, "_bucket"], "left")
    value = F.coalesce("_here", "_carried")
    answers = found.select("_row.*", *[value[c].alias(c) for c in columns])
    rest = spine.filter(~placed).select("*", *[F.lit(None).cast(kind[c].dataType).alias(c) for c in columns])
    return answers.unionByName(rest)
