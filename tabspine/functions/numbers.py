"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_number(col: Column) -> Column:
    """Double value of a plain decimal text, an exponent allowed; null for anything else, ``nan``, ``inf`` and ``12d`` included."""
    text = F.trim(col.cast("string"))
    value = text.try_cast("double")
    # Of digits, signs and points alone, the cast takes plain numbers only; the pattern is for the few others it takes.
    plain = F.translate(text, "0123456789.+-", "") == ""
    return F.when(value.isNotNull() & (plain | text.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)[eE][+-]?[0-9]+$")), value)


def threshold(score: Column, cut: float = 0.5) -> Column:
    """Class 1 when the score reaches the cut."""
    return (score >= cut).cast("int")


def positive_score(vector: Column) -> Column:
    """P(positive) out of a two-class probability array."""
    return F.element_at(vector, -1)


def widen_integers(df: DataFrame) -> DataFrame:
    """Byte, short and int columns as long; other columns unchanged."""
    small = (T.ByteType, T.ShortType, T.IntegerType)
    return df.select(
        *[F.col(f.name).cast("long").alias(f.name) if isinstance(f.dataType, small) else F.col(f.name)
          for f in df.schema.fields]
    )
