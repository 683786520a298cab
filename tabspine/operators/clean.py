"""Normalising raw records: names, missing tokens, numbers, labels, splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabspine.config import Roles
from tabspine.functions.keys import normal_split
from tabspine.functions.numbers import to_number
from tabspine.functions.text import encode_label, label_text, null_if_missing, snake_name

# Other names under which a column may arrive.
ALIASES = {"income": "class", "education_num": "educationnum"}


class LabelError(ValueError):
    """A label text is neither of the two class names."""


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required columns the frame lacks, in the order required; reads no data."""
    return [c for c in required if c not in df.columns]


def require_columns(df: DataFrame, required: Sequence[str], what: str = "table") -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise LookupError(f"{what} is missing columns {missing}")
    return df


def snake_columns(df: DataFrame) -> DataFrame:
    """All column names in snake case."""
    return df.toDF(*[snake_name(c) for c in df.columns])


def resolve_aliases(df: DataFrame, aliases: dict[str, str] = ALIASES) -> DataFrame:
    """Fill an absent column from its other name."""
    found = {name: F.col(other) for name, other in aliases.items() if name not in df.columns and other in df.columns}
    return df.withColumns(found) if found else df


def unknown_labels(df: DataFrame, text_col: str, n: int = 8) -> DataFrame:
    """The first ``n`` label texts, sorted, that are neither class name."""
    text = label_text(F.col(text_col)).alias("label_text")
    return (
        df.filter(encode_label(F.col(text_col)).isNull()).select(text).distinct().orderBy("label_text").limit(n)
    )


def require_known_labels(df: DataFrame, text_col: str) -> DataFrame:
    bad = [r[0] for r in unknown_labels(df, text_col).collect()]
    if bad:
        raise LabelError(f"unexpected labels {bad}")
    return df


def normalize_records(
    raw: DataFrame,
    roles: Roles = Roles(),
    split: str | None = None,
    extra: Sequence[str] = (),
    strict: bool = True,
) -> DataFrame:
    """Raw text records as typed features, optional constant split, and 0/1 label.

    ``strict`` reads the label column once to refuse unknown class names; otherwise such rows carry a null label and
    can be quarantined by a filter. ``extra`` columns (a key, say) pass through in front.
    """
    df = resolve_aliases(snake_columns(raw))
    if "income" not in df.columns:
        raise LookupError("records have no income / class column")
    if strict:
        require_known_labels(df, "income")
    columns = [F.col(c) for c in extra]
    for c in roles.features:
        if c in df.columns:
            clean = to_number(F.col(c)) if c in roles.numeric else null_if_missing(F.col(c))
            columns.append(clean.alias(c))
    if split is not None:
        columns.append(F.lit(split).alias(roles.split_col))
    elif roles.split_col in df.columns:
        columns.append(F.col(roles.split_col))
    columns.append(encode_label(F.col("income")).alias(roles.label_col))
    return df.select(*columns)


def normalize_split(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    return df.withColumn(roles.split_col, normal_split(F.col(roles.split_col)))


def raw_columns(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Key, features, split and label in their fixed order."""
    return df.select(roles.id_col, *roles.features, roles.split_col, roles.label_col)
