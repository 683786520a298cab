"""Packing documents into token sequences by cutting stock.

Documents are tokenized once, where they lie, and cut: whole sequences first, then the rest into a multiple of a quarter and a
remainder, so that few lengths occur and short ones fill gaps. Only the histogram of lengths, one row per length, goes to the
driver; column generation turns it into patterns. Pieces are ranked within their length, and a rank says which sequence of
which pattern holds the piece. Ranks are counted in buckets of pieces, so a length that most pieces share is split too.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabspine.llm.blocks import blocks
from tabspine.llm.cutting_stock import plan
from tabspine.llm.tokens import encoder
from tabspine.llm.workers import tidy
from tabspine.sources.scratch import materialize


@dataclass(frozen=True)
class Settings:
    """``capacity``: tokens of a sequence. ``parts``: a document's rest is cut at multiples of ``capacity / parts``. ``end_id``: id after each
    document. ``bucket_rows``: pieces of a bucket in which ranks are counted. ``vocabulary`` and ``pattern``: see ``tokens``."""

    vocabulary: str
    pattern: str
    capacity: int = 1024
    parts: int = 4
    end_id: int = 0
    bucket_rows: int = 50_000


def pieces(docs: DataFrame, id: str, text: str, s: Settings) -> DataFrame:
    """``(id, start, length, ids_crc32, doc_tokens)``, each token of each document in one piece of at most ``capacity``."""
    part = s.capacity // s.parts

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(s.vocabulary, s.pattern), np.array([s.end_id], "<u4").tobytes()
        for batch in batches:
            for block in blocks(batch.column(1)):
                ids, at = encode.block(block)
                ids = ids.astype("<u4", copy=False)
                row, start, length, crc, total = [], [], [], [], []
                for i in range(len(block)):
                    raw = ids[at[i] : at[i + 1]].tobytes() + end
                    n = len(raw) // 4
                    whole = n - n % s.capacity
                    edges = [*range(0, whole, s.capacity), whole, whole + (n - whole) // part * part, n]
                    for low, high in zip(edges[:-1], edges[1:]):
                        if high > low:
                            row.append(block.first + i), start.append(low), length.append(high - low)
                            crc.append(zlib.crc32(raw[4 * low : 4 * high])), total.append(n)
                numbers = [pa.array(x, pa.int64()) for x in (start, length, crc, total)]
                names = ["id", "start", "length", "ids_crc32", "doc_tokens"]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), *numbers], names)

    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    cut = tidy(cut, holds=True, after=lambda: encoder(s.vocabulary, s.pattern).forget())
    return rows.mapInArrow(cut, "id long, start long, length long, ids_crc32 long, doc_tokens long")


def _slots(planned: list[tuple[Counter, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """``(length, first, last, each, sequence, offset)``: ranks ``first`` to ``last`` of a length fill a pattern, ``each`` of them per sequence."""
    found, ranked, sequence = [], Counter(), 0
    for pattern, times in planned:
        offset = 0
        for length, each in sorted(pattern.items(), reverse=True):
            found.append((length, ranked[length], ranked[length] + each * times - 1, each, sequence, offset))
            ranked[length] += each * times
            offset += each * length
        sequence += times
    return found


def pack(docs: DataFrame, s: Settings, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, start, length, ids_crc32, doc_tokens, sequence_id, offset)`` of every piece.

    Null and empty texts are the end id alone. Rows that repeat an id are packed each. A null id stays null. Other columns are not
    read. An empty table gives no rows. The driver gets one row per length, at most ``capacity``; the slots sent to the tasks
    are at most ``capacity`` per pattern, and patterns are no more than twice the lengths.
    """
    spark = docs.sparkSession
    cut = materialize(pieces(docs, id, text, s), "pieces")
    demand = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = _slots(plan(demand, s.capacity))
    names = "slot_length long, first long, last long, each long, sequence long, place long"
    slots = spark.createDataFrame(slots, names)
    # Buckets only spread the ranking; identical pieces share one and are interchangeable.
    buckets = max(1, -(-sum(demand.values()) // s.bucket_rows))
    order = ["id", "start", "ids_crc32", "doc_tokens"]
    cut = cut.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    counts = cut.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")
    counts = counts.select("length", "bucket", before.alias("before"))
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy(*order)) - 1
    ranked = cut.withColumn("inside", inside).join(counts, ["length", "bucket"])
    rank = F.col("inside") + F.col("before")
    placed = ranked.withColumn("rank", rank).join(
        F.broadcast(slots), (F.col("length") == F.col("slot_length")) & F.col("rank").between(F.col("first"), F.col("last"))
    )
    nth = F.col("rank") - F.col("first")
    return placed.select(
        F.col("id").alias(id), "start", "length", "ids_crc32", "doc_tokens",
        (F.col("sequence") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("place") + nth % F.col("each") * F.col("length")).cast("long").alias("offset"),
    )
