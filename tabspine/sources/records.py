"""Reading census-style records from headerless CSV files, numbered in the order of their lines."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabspine.config import CSV_COLUMNS
from tabspine.sources.scratch import materialize

_BLOCK = ["_part", "_file", "_block"]
#: Blocks of files up to which their counts are sent to the lines, some 200 bytes each; more are joined by a shuffle.
_FEW_BLOCKS = 250_000


@dataclass(frozen=True)
class Records:
    """``rows`` of the right number of fields, numbered 1..N by ``_number``, and ``malformed`` lines as ``_file`` and ``line``."""

    rows: DataFrame
    malformed: DataFrame


def _lines(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], part: int) -> DataFrame:
    """Every line that is not blank, parsed. ``_line`` grows with the place in a block; ``_malformed`` is the text of a line with too
    few or too many fields."""
    schema = ", ".join(f"`{c}` string" for c in [*columns, "_malformed"])
    options = {
        "nullValue": "?", "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true",
        "columnNameOfCorruptRecord": "_malformed",
    }
    text = spark.read.text(paths if isinstance(paths, str) else list(paths)).filter(F.trim("value") != "")
    return text.select(
        F.from_csv("value", schema, options).alias("_fields"), F.lit(part).alias("_part"),
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"), F.ltrim("value").startswith("|").alias("_piped"),
    ).select("_fields.*", *_BLOCK, "_line", "_piped")


def load_records(
    spark: SparkSession, parts: Sequence[str | Sequence[str]], columns: Sequence[str] = CSV_COLUMNS,
    parse: Callable[[DataFrame, int], DataFrame] = lambda lines, part: lines,
) -> Records:
    """Headerless CSV files as text fields: blanks around fields dropped, ``?`` null, blank lines skipped, and the first line of a file
    if it begins with a pipe.

    Rows are numbered in the order of parts, files and lines, where they lie: each line is read and parsed once, by ``parse`` as well,
    and written; counts of each block of a file give the number before its first line. Only rows of a block with malformed
    lines are numbered by a window over that block. ``parse`` gets the lines of a part and its place, and keeps columns that begin
    with ``_``.
    """
    lines = [parse(_lines(spark, paths, columns, part), part) for part, paths in enumerate(parts)]
    stored = lines[0]
    for more in lines[1:]:
        stored = stored.unionByName(more)
    stored = materialize(stored, "lines")
    malformed = F.col("_malformed").isNotNull()
    # The first line of a file is the first of its block at 0; it is no data if it begins with a pipe.
    blocks = stored.groupBy(*_BLOCK).agg(
        F.count("*").alias("_n"), F.count_if(malformed).alias("_bad"), F.min("_line").alias("_first"), F.min_by("_piped", "_line").alias("_head"),
        F.min_by(malformed, "_line").alias("_bad_head"),
    )
    head = (F.col("_block") == 0) & F.col("_head")
    rest = F.col("_bad") - (head & F.col("_bad_head")).cast("int")
    blocks = blocks.select(*_BLOCK, "_first", head.cast("int").alias("_skip"), rest.alias("_holes"), (F.col("_n") - head.cast("int") - rest).alias("_kept"))
    before = F.coalesce(F.sum("_kept").over(Window.orderBy(*_BLOCK).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = materialize(blocks.withColumn("_before", before), "blocks")
    n, holes = blocks.agg(F.count("*"), F.coalesce(F.sum("_holes"), F.lit(0))).first()
    placed = stored.join(F.broadcast(blocks) if n <= _FEW_BLOCKS else blocks, _BLOCK)
    placed = placed.filter((F.col("_skip") == 0) | (F.col("_line") > F.col("_first")))
    number = F.col("_before") + F.col("_line") - F.col("_first") - F.col("_skip") + 1
    rows = placed.filter("_holes = 0").withColumn("_number", number)
    if holes:
        order = Window.partitionBy(*_BLOCK).orderBy("_line")
        broken = placed.filter("_holes > 0").filter(~malformed)
        rows = rows.unionByName(broken.withColumn("_number", F.col("_before") + F.row_number().over(order)))
    drop = [*_BLOCK, "_line", "_piped", "_malformed", "_first", "_skip", "_holes", "_kept", "_before"]
    return Records(rows.drop(*drop), placed.filter(malformed).select("_file", F.col("_malformed").alias("line")))


def require_few_malformed(malformed: DataFrame, most: int) -> None:
    """An error that shows some of the malformed lines if there are more than ``most``."""
    if malformed.limit(most + 1).count() > most:
        shown = "; ".join(f"{r['_file'].rsplit('/', 1)[-1]}: {r['line'][:80]}" for r in malformed.limit(3).collect())
        raise ValueError(f"more than {most} lines with too few or too many fields, such as {shown}")


def read_records(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] = CSV_COLUMNS) -> DataFrame:
    """The rows of :func:`load_records`, without their numbers."""
    return load_records(spark, [paths], columns).rows.select(*[f"`{c}`" for c in columns])


def read_first_available(
    spark: SparkSession, candidates: Sequence[str], read: Callable[[str], DataFrame] | None = None
) -> DataFrame:
    """The first candidate path that can be opened; an error naming the last failure if none can.

    ``read`` opens one path, as Parquet by default.
    """
    last = "no candidates"
    for path in candidates:
        try:
            return read(path) if read else spark.read.parquet(path)
        except PySparkException as failure:
            last = f"{path}: {failure.getCondition() or failure}"
    raise FileNotFoundError(f"no source could be opened, last tried {last}")
