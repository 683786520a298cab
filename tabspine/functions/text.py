"""Text expressions: cleaning, label text, truthy text, comma lists, dotted names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabspine.config import MISSING_TOKENS, NEGATIVE_CLASS, POSITIVE_CLASS

# Texts read as true.
TRUTHY = ("1", "true", "yes", "y")


def snake_name(name: str) -> str:
    """Column name in snake case."""
    return name.strip().lower().translate(str.maketrans("- ", "__"))


def snake_value(col: Column) -> Column:
    """The same rule as :func:`snake_name` on a string column."""
    return F.regexp_replace(F.lower(F.trim(col)), "[- ]", "_")


def null_if_missing(col: Column, tokens: Sequence[str] = MISSING_TOKENS) -> Column:
    """Trimmed text, null where it is one of the missing tokens."""
    text = F.trim(col.cast("string"))
    return F.when(~text.isin(*tokens), text)


def label_text(col: Column) -> Column:
    """Class name with surrounding blanks and every dot removed; null reads as ``nan``."""
    return F.coalesce(F.translate(F.trim(col.cast("string")), ".", ""), F.lit("nan"))


def encode_label(col: Column, positive: str = POSITIVE_CLASS, negative: str = NEGATIVE_CLASS) -> Column:
    """1 / 0 for the two class names, each as spelled or all lower case; null for any other text."""
    text = label_text(col)
    return (
        F.when(text.isin(positive, positive.lower()), 1)
        .when(text.isin(negative, negative.lower()), 0)
        .cast("int")
    )


def is_truthy(col: Column) -> Column:
    """True for 1/true/yes/y in any case; false for everything else, null included."""
    return F.coalesce(F.lower(F.trim(col.cast("string"))).isin(*TRUTHY), F.lit(False))


def split_list(col: Column, separator: str = ",") -> Column:
    """Array of the non-blank trimmed members of a separated list."""
    parts = F.transform(F.split(F.coalesce(col, F.lit("")), separator), lambda part: F.trim(part))
    return F.filter(parts, lambda part: part != "")


def in_list(value: Column, members: Column) -> Column:
    """Whether a trimmed non-blank value is a member of a comma list."""
    wanted = F.trim(F.coalesce(value, F.lit("")))
    return (wanted != "") & F.array_contains(split_list(members), wanted)


def last_segment(col: Column) -> Column:
    """Part of a dotted name after the last dot."""
    return F.substring_index(col, ".", -1)


def dotted(*cols: Column) -> Column:
    """Parts joined with dots."""
    return F.concat_ws(".", *cols)


def served_name(model_name: Column, version: Column) -> Column:
    """Short model name and version joined with a hyphen."""
    return F.concat_ws("-", last_segment(model_name), version.cast("string"))
