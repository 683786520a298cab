"""One-pass table profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabspine.config import Roles
from tabspine.functions.jsonvals import json_value
from tabspine.operators.checks import duplicate_keys


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, mean, min, max) as doubles, all columns in one pass."""
    stats = df.agg(
        *[
            F.struct(
                F.avg(F.col(c).cast("double")).alias("mean"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    named = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("s")) for c in columns]
    return stats.select(F.inline(F.array(*named))).select("column_name", "s.*")


def column_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value, rows): distinct values with counts, combined in each task before the shuffle."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return texts.unpivot([], list(columns), "column_name", "value").groupBy("column_name", "value").agg(
        F.count("*").alias("rows")
    )


def cardinality(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """(column_name, n_distinct); null counts as one value. Exact by default, sketched on request."""
    if approximate:
        counts = df.agg(
            *[(F.approx_count_distinct(c) + F.max(F.col(c).isNull().cast("int"))).alias(c) for c in columns]
        )
        return counts.unpivot([], list(columns), "column_name", "n_distinct")
    return column_values(df, columns).groupBy("column_name").agg(F.count("*").alias("n_distinct"))


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value): most frequent non-null value, the smallest on ties."""
    counted = column_values(df, columns).filter(F.col("value").isNotNull())
    return counted.groupBy("column_name").agg(F.min_by("value", F.struct(-F.col("rows"), "value")).alias("value"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a low-cardinality column, null kept."""
    return df.select(column).distinct()


def table_profile(df: DataFrame, roles: Roles = Roles(), approximate: bool = False) -> DataFrame:
    """(metric, value as JSON) rows describing a raw table.

    Three scans, each of only the columns it needs: one for all counts, rates and summaries, one for the
    distinct categories, one for the keys.
    """
    numeric = [c for c in roles.numeric if c in df.columns]
    categorical = [c for c in roles.categorical if c in df.columns]
    leak = roles.label_col in roles.features
    if leak:
        raise ValueError("label among the features")
    positives = F.count_if(F.col(roles.label_col) == 1)
    rows = F.count("*")
    summary = F.struct(
        *[
            F.struct(
                F.avg(c).cast("double").alias("mean"), F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in numeric
        ]
    )
    missing = F.struct(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns])
    main = df.agg(
        rows.alias("rows"), positives.alias("positives"), (rows - positives).alias("negatives"),
        F.when(rows > 0, positives / rows).alias("positive_rate"), summary.alias("numeric_summary"),
        missing.alias("missingness"),
    )
    types = F.struct(*[F.lit(f.dataType.simpleString()).alias(f.name) for f in df.schema.fields])
    fixed = {
        "dtypes": types,
        "numeric": F.array(*[F.lit(c) for c in numeric]),
        "categorical": F.array(*[F.lit(c) for c in categorical]),
        "feature_cols": F.array(*[F.lit(c) for c in roles.features]),
        "id_col": F.lit(roles.id_col),
        "label_col": F.lit(roles.label_col),
        "leakage_label_in_features": F.lit(leak),
        "dataset": F.lit(roles.dataset),
        "target_definition": F.lit(roles.target_definition),
        "positive_class": F.lit(roles.positive_class),
        "negative_class": F.lit(roles.negative_class),
    }
    names = [*main.columns, *fixed]
    values = [F.col(c) for c in main.columns] + list(fixed.values())
    pairs = F.array(*[F.struct(F.lit(n).alias("metric"), json_value(v).alias("value")) for n, v in zip(names, values)])
    described = main.select(F.inline(pairs))
    counts = cardinality(df, categorical, approximate).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("column_name", "n_distinct")))).alias("v")
    )
    keys = duplicate_keys(df, roles.id_col).agg(F.count("*").alias("v"))
    return described.unionByName(
        counts.select(F.lit("categorical_cardinality").alias("metric"), json_value(F.col("v")).alias("value"))
    ).unionByName(keys.select(F.lit("dup_keys").alias("metric"), json_value(F.col("v")).alias("value")))
