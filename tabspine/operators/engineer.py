"""Engineered features, the feature frame, and its typed contract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabspine.config import Roles
from tabspine.operators.clean import require_columns


def with_engineered_features(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Adds net capital, overtime flag, log of the weight, and squared education years."""
    require_columns(df, roles.features, "raw table")
    years = F.col("education_num").cast("double")
    return df.withColumns(
        {
            "capital_net": F.col("capital_gain") - F.col("capital_loss"),
            "hours_over_40": F.coalesce(F.col("hours_per_week") > 40, F.lit(False)).cast("long"),
            "log_fnlwgt": F.log1p(F.col("fnlwgt").cast("double")),
            "education_num_sq": years * years,
        }
    )


def feature_frame(raw: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Key and model features in contract order; the label is not among them."""
    return with_engineered_features(raw, roles).select(roles.id_col, *roles.model_features)


def contract_violations(df: DataFrame, roles: Roles = Roles()) -> list[str]:
    """Differences between the frame's schema and the contract, names and types; reads no data."""
    found = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for name, kind in roles.contract.items():
        expected = T.NumericType if kind == "double" else T.StringType
        if name not in found:
            problems.append(f"{name}: missing")
        elif not isinstance(found[name], expected):
            problems.append(f"{name}: {found[name].simpleString()} is not {kind}")
    if roles.label_col in found:
        problems.append(f"{roles.label_col}: label among the features")
    return problems
