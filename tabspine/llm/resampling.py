"""Documents drawn to resemble a target collection: importance weights of hashed n-grams, then an exact cut by selection.

Every run of one to ``run`` consecutive words falls into one of ``buckets`` buckets by its CRC-32. Tasks count buckets in an
array, the arrays are summed, and the log ratio of target and source frequencies becomes an array of gains that scores
whole blocks of text. A hash of the id adds Gumbel noise, so that taking the highest scores draws without replacement in
proportion to the weights.

The cut is found without sorting all documents: each chunk of keys names its median, the median of these, weighted by
chunk size, splits the keys, and at least a quarter of them is known to lie on the wrong side. Only winners are sorted.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabspine.llm.blocks import LOWER, MARK, Block, blocks, places
from tabspine.operators.ordering import global_row_number
from tabspine.sources.scratch import materialize

_BLOCK = 1 << 20
#: Bytes of a word up to which all words advance together; what is longer goes on by itself.
_SHORT = 48
_ONES = np.uint32(0xFFFFFFFF)


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


_CRC = _crc_table()


@dataclass(frozen=True)
class Settings:
    """``run``: words of the longest feature. ``share``: percent of the eligible documents drawn, those of at least ``least_words`` words.

    ``chunk``: keys that name one median. ``few``: survivors that are sorted at once to end the selection.
    """

    run: int = 2
    buckets: int = 10_000
    share: int = 25
    least_words: int = 20
    salt: str = "7"
    chunk: int = 1 << 20
    few: int = 4096


def _advance(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, state: np.ndarray) -> np.ndarray:
    """CRC registers after each word, from those before it. Words go byte by byte together, longest first."""
    order = np.argsort(-lengths, kind="stable")
    at, falling, now = starts[order], -lengths[order], state[order]
    for i in range(min(int(lengths.max(initial=0)), _SHORT)):
        n = int(np.searchsorted(falling, -i, "left"))
        now[:n] = _CRC[(now[:n] ^ data[at[:n] + i]) & np.uint32(255)] ^ (now[:n] >> np.uint32(8))
    for k in range(int(np.searchsorted(falling, -_SHORT, "left"))):
        rest = data[at[k] + _SHORT : at[k] - falling[k]].tobytes()
        now[k] = zlib.crc32(rest, int(now[k] ^ _ONES)) ^ 0xFFFFFFFF
    out = np.empty_like(now)
    out[order] = now
    return out


def features(block: Block, run: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and row of every feature of a block, and the words of each row."""
    starts, ends, row = places(block, MARK)
    data, lengths = LOWER[block.data], ends - starts
    state, found, rows = np.full(len(starts), _ONES), [], []
    for k in range(run):
        if k:  # every run of k words that another word of its row follows
            go_on = row[k:] == row[: len(row) - k] if len(row) > k else np.zeros(0, bool)
            first = np.flatnonzero(go_on)
            state = _CRC[(state[first] ^ np.uint32(32)) & np.uint32(255)] ^ (state[first] >> np.uint32(8))
            widened = np.full(len(starts), _ONES)
            widened[first] = _advance(data, starts[first + k], lengths[first + k], state)
            state = widened
        else:
            first = np.arange(len(starts))
            state = _advance(data, starts, lengths, state)
        found.append((state[first] ^ _ONES) % np.uint32(buckets))
        rows.append(row[first])
    return np.concatenate(found).astype(np.int64), np.concatenate(rows), np.bincount(row, minlength=len(block))


def bucket_counts(texts: DataFrame, text: str, s: Settings) -> np.ndarray:
    """How many features fall into each bucket; what reaches the driver is one number a bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(s.buckets, np.int64)
        for batch in batches:
            for block in blocks(batch.column(0), _BLOCK):
                total += np.bincount(features(block, s.run, s.buckets)[0], minlength=s.buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["bucket", "n"])

    rows = texts.select(F.col(text).cast("string")).mapInArrow(count, "bucket long, n long")
    counts = np.zeros(s.buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[r["bucket"]] = r["n"]
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature of each bucket adds: a thousand times the log of its smoothed frequency in the target over that in the source."""
    of_source, of_target = float(source.sum() + len(source)), float(target.sum() + len(target))
    pairs = zip(source.tolist(), target.tolist())
    ratios = [(float(t + 1) * of_source) / (float(s + 1) * of_target) for s, t in pairs]
    return np.array([math.floor(1000 * math.log(x)) for x in ratios], np.int64)


def _weights(gain: np.ndarray, s: Settings):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1), _BLOCK):
                bucket, row, n_words = features(block, s.run, s.buckets)
                n = np.bincount(row, minlength=len(block))
                total = np.zeros(len(block), np.int64)
                np.add.at(total, row, gain[bucket])
                ids = batch.column(0).slice(block.first, len(block))
                arrays = [ids, *(pa.array(x) for x in (n_words, n, total // np.maximum(n, 1)))]
                yield pa.RecordBatch.from_arrays(arrays, ["id", "n_words", "n_features", "weight"])

    return score


def _noise(id: Column, salt: str) -> Column:
    """Gumbel noise in thousandths, from a hash of the id."""
    text = F.concat(F.lit(f"{salt}:"), F.coalesce(id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resampled(
    docs: DataFrame, target: DataFrame, id: str = "doc_id", text: str = "text", target_text: str = "text",
    settings: Settings | None = None,
) -> DataFrame:
    """``(id, n_words, n_features, weight, score, rank)`` of every row of ``docs``; rank is null unless it is drawn.

    Ties go to the smaller id, rows that repeat an id are documents of their own, and among those of equal score the one with
    fewer features comes first. Rows with a null id share the noise of an empty id and come after all others of their
    score. Null and empty texts have no features and weight 0, and are drawn only if ``least_words`` is 0. Very long texts are
    read whole, a block of their own. An empty target or table is a collection without features. Other columns are not read.
    """
    s = settings or Settings()
    gain = gains(bucket_counts(docs, text, s), bucket_counts(target, target_text, s))
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    rows = rows.mapInArrow(_weights(gain, s), "id long, n_words long, n_features long, weight long")
    rows = rows.withColumn("score", F.col("weight") + _noise(F.col("id"), s.salt))
    rows = materialize(rows.withColumn("place", F.monotonically_increasing_id()), "scored")
    fits = F.col("n_words") >= s.least_words
    keys = rows.where(fits).select(
        (-F.col("score")).alias("a"), F.coalesce("id", F.lit((1 << 63) - 1)).alias("b"), F.col("n_features").alias("c"), F.col("place").alias("d")
    )
    last = cutoff(keys, keys.count() * s.share // 100, s)
    own = F.struct((-F.col("score")).alias("a"), F.coalesce("id", F.lit((1 << 63) - 1)).alias("b"), F.col("n_features").alias("c"), F.col("place").alias("d"))
    drawn = (fits & (own <= _literal(last))) if last else F.lit(False)
    columns = ["id", "n_words", "n_features", "weight", "score"]
    order = own.alias("order")
    winners = rows.where(drawn).select(*columns, order) if last else None
    rest = rows.where(~drawn).select(*columns, F.lit(None).cast("long").alias("rank"))
    if winners is not None:
        rest = rest.unionByName(global_row_number(winners, ["order"], "rank").select(*columns, "rank"))
    return rest.withColumnRenamed("id", id)


_Key = tuple[int, int, int, int]
_NAMES = ["a", "b", "c", "d"]


def _literal(key: _Key) -> Column:
    return F.struct(*[F.lit(x).cast("long").alias(n) for n, x in zip(_NAMES, key)])


def cutoff(keys: DataFrame, rank: int, settings: Settings | None = None) -> _Key | None:
    """The key at ``rank`` (from 1) of distinct keys ``(a, b, c, d)`` of longs, in ascending order; None if there is none.

    Each round makes one pass over the keys left: chunks count their keys on both sides of the pivot and name the median of
    either side, so that the side to go on with has its medians already. Keys are written anew once a quarter is left, so that all
    passes together read a bounded multiple of the first.
    """
    s = settings or Settings()
    if rank < 1:
        return None
    stored = written = materialize(keys.select(*_NAMES), "keys")
    left = size = stored.count()
    if rank > left:
        return None
    low = high = pivot = None
    while left > s.few:
        sides = _sides(stored, pivot, s.chunk)
        if pivot is not None:
            below = sum(n for side, n, *_ in sides if side == 0)
            if rank == below + 1:
                return pivot
            side, low, high = (0, low, pivot) if rank <= below else (1, pivot, high)
            rank -= 0 if side == 0 else below + 1
            sides = [x for x in sides if x[0] == side]
            left = sum(n for _, n, *_ in sides)
            stored = _between(written, low, high)
            if 4 * left <= size:
                stored = written = materialize(stored, "keys")
                size, low, high = left, None, None
        pivot = _weighted_median([(tuple(key), n) for _, n, *key in sides])
    return sorted(tuple(r) for r in stored.collect())[rank - 1]


def _between(keys: DataFrame, low: _Key | None, high: _Key | None) -> DataFrame:
    own = F.struct(*_NAMES)
    for bound, holds in ((low, lambda b: own > b), (high, lambda b: own < b)):
        if bound is not None:
            keys = keys.where(holds(_literal(bound)))
    return keys


def _weighted_median(medians: list[tuple[_Key, int]]) -> _Key:
    medians, half, seen = sorted(medians), sum(n for _, n in medians) / 2, 0
    for key, n in medians:
        seen += n
        if seen >= half:
            return key
    raise ValueError("no keys")


def _sides(keys: DataFrame, pivot: _Key | None, chunk: int) -> list[tuple]:
    """For each chunk of keys and side of the pivot, 0 below and 1 above: side, number of keys, median."""

    def medians(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        rows: list[tuple] = []

        def name() -> None:
            part = np.concatenate(held, axis=1)
            order = np.lexsort(part[::-1])
            cut = 0
            if pivot is not None:  # places of the pivot in the sorted chunk
                below = np.zeros(part.shape[1], bool)
                equal = np.ones(part.shape[1], bool)
                for column, value in zip(part, pivot):
                    below |= equal & (column < value)
                    equal &= column == value
                cut = int(below.sum())
                order = order[~equal[order]]
            for side, own in ((0, order[:cut]), (1, order[cut:])):
                if len(own):
                    rows.append((side, len(own), *part[:, own[(len(own) - 1) // 2]].tolist()))
            held.clear()

        for batch in batches:
            held.append(np.array([c.to_numpy() for c in batch.columns]))
            if sum(x.shape[1] for x in held) >= chunk:
                name()
        if held:
            name()
        columns = list(zip(*rows)) or [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["side", "n", *_NAMES])

    return [tuple(r) for r in keys.mapInArrow(medians, "side long, n long, a long, b long, c long, d long").collect()]
