"""Order-free fingerprint of a table's content, which adds up over parts of the table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabspine.functions.keys import md5_int


@dataclass(frozen=True)
class Fingerprint:
    """Rows, and the exclusive or and the sum of their hashes."""

    rows: int
    hash_xor: int
    hash_sum: int

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.rows + other.rows, self.hash_xor ^ other.hash_xor, self.hash_sum + other.hash_sum)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.rows - other.rows, self.hash_xor ^ other.hash_xor, self.hash_sum - other.hash_sum)

    def __str__(self) -> str:
        return f"{self.rows}:{self.hash_xor}:{self.hash_sum}"

    @staticmethod
    def parse(text: str) -> Fingerprint:
        return Fingerprint(*map(int, text.split(":")))


def table_fingerprint(df: DataFrame, columns: Sequence[str] | None = None, portable: bool = False) -> DataFrame:
    """(rows, hash_xor, hash_sum) over whole rows, the same however the rows are ordered or split into files.

    Null columns are told apart. The xor alone would miss a pair of equal rows, so the sum of the hashes goes with it. ``portable`` hashes the
    text of the columns with md5, which other engines can repeat: each is its length, a colon and itself, or a minus sign if it is null.
    """
    columns = list(columns or df.columns)
    if portable:
        texts = [F.col(c).cast("string") for c in columns]
        row_hash = md5_int(F.concat(*[F.coalesce(F.concat(F.char_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))
    else:
        row_hash = F.xxhash64(*[x for c in columns for x in (F.col(c).isNull(), F.col(c))])
    return df.select(row_hash.alias("h")).agg(
        F.count("*").alias("rows"),
        F.coalesce(F.bit_xor("h"), F.lit(0)).cast("long").alias("hash_xor"),
        F.coalesce(F.sum(F.col("h").cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias("hash_sum"),
    )


def fingerprint_of(df: DataFrame, columns: Sequence[str] | None = None) -> Fingerprint:
    """The fingerprint of all rows of a frame, as a value that can be added and subtracted."""
    rows, hash_xor, hash_sum = table_fingerprint(df, columns).first()
    return Fingerprint(rows, hash_xor, int(hash_sum))
