"""Portable key hashing: the same numbers come out of any engine that has md5."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_int(*cols: Column) -> Column:
    """First 32 bits of md5 of the key text, as a non-negative long."""
    text = F.concat_ws("|", *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def hash_bucket(col: Column, buckets: int) -> Column:
    """Bucket 0..buckets-1 of a key."""
    return F.pmod(md5_int(col), F.lit(buckets)).cast("int")


def sample_order(col: Column, salt: int | str | None = None) -> Column:
    """Pseudo-random but repeatable order of keys; another salt gives another order."""
    text = col.cast("string")
    return F.md5(text if salt is None else F.concat_ws("|", text, F.lit(str(salt))))


def hash_split(col: Column, train_parts: int = 8, parts: int = 10) -> Column:
    """``train`` for train_parts of parts buckets, else ``holdout``."""
    return F.when(hash_bucket(col, parts) < train_parts, "train").otherwise("holdout")


def normal_split(col: Column, names: Sequence[str] = ("train", "holdout")) -> Column:
    """Known split names are kept; anything else, null included, is ``holdout``."""
    return F.when(col.isin(*names), col).otherwise("holdout")
