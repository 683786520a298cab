"""Token counts that follow edits.

A document is cut into segments of whole words, at spaces that no token spans, and a segment tree holds the token count of every
segment and the sums above them. An edit is re-encoded only where it is: the segments it touches, and one more on either side
where it reaches a segment's edge. The new counts replace the old ones, and the sums on the way to the root change by the difference.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabspine.llm.blocks import Block, blocks
from tabspine.llm.tokens import Encoder, cuts, encoder
from tabspine.llm.workers import tidy


@dataclass(frozen=True)
class Settings:
    """``segment_bytes``: bytes from which a segment ends at the next cut. ``vocabulary`` and ``pattern``: see ``tokens``."""

    vocabulary: str
    pattern: str
    segment_bytes: int = 256


def _starts(data: np.ndarray, least: int) -> np.ndarray:
    """Where segments begin: the first cut of each stretch of ``least`` bytes."""
    at = cuts(data)
    if not len(at):
        return np.zeros(min(1, len(data)), np.int64)
    stretch = at // least
    return np.r_[0, at[np.r_[True, stretch[1:] != stretch[:-1]]]]


def sums(counts: np.ndarray) -> np.ndarray:
    """A segment tree as an array: the root at 1, the children of ``i`` at ``2 i`` and ``2 i + 1``, the segments at the end."""
    width = 1 << max(0, len(counts) - 1).bit_length()
    tree = np.zeros(2 * width, np.int64)
    tree[width : width + len(counts)] = counts
    level = width
    while level > 1:
        tree[level // 2 : level] = tree[level : 2 * level : 2] + tree[level + 1 : 2 * level : 2]
        level //= 2
    return tree


def replace(tree: np.ndarray, segment: int, count: int) -> None:
    """Set one segment's count and update the sums above it."""
    i = len(tree) // 2 + segment
    change = count - tree[i]
    while i:
        tree[i] += change
        i //= 2


def edited(
    data: np.ndarray, starts: np.ndarray, tree: np.ndarray, edits: list[tuple[int, int, bytes]], encode: Encoder, segment_bytes: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Text, segment starts and tree after the edits, and how many segments of the old ones were encoded again.

    Edits are ``(start, end, replacement)`` in bytes, in order and not overlapping. Touched segments that follow each other are encoded
    together. One that stays small keeps its place, and the sums above it change; others are cut anew, and the sums are
    added up from the counts, of which those of untouched segments are the old ones.
    """
    ends = np.r_[starts[1:], len(data)]
    spans: list[list] = []  # first and last touched segment, edits
    # A cut needs both characters around it: an edit next to a cut touches the segment beyond as well.
    firsts = np.maximum(np.searchsorted(starts, np.array([e[0] for e in edits]) - 1, "right") - 1, 0)
    lasts = np.maximum(np.searchsorted(starts, np.array([e[1] for e in edits]) + 1, "right") - 1, firsts)
    for (start, end, new), first, last in zip(edits, firsts.tolist(), lasts.tolist()):
        if spans and first <= spans[-1][1] + 1:
            spans[-1][1] = max(spans[-1][1], last)
            spans[-1][2].append((start, end, new))
        else:
            spans.append([first, last, [(start, end, new)]])
    counts = tree[len(tree) // 2 :][: len(starts)]
    text, placed, counted, again = [], [], [], 0
    at_byte = at_segment = moved = 0
    same = True
    for first, last, own in spans:
        low, high = (int(starts[first]), int(ends[last])) if len(starts) else (0, 0)
        parts, at = [], low
        for start, end, new in own:
            parts += [data[at:start].tobytes(), new]
            at = end
        region = np.frombuffer(b"".join([*parts, data[at:high].tobytes()]), np.uint8)
        keeps = first == last and 0 < len(region) <= 4 * segment_bytes
        cut = np.zeros(1, np.int64) if keeps else _starts(region, segment_bytes)
        found = np.diff(encode.block(Block(0, region, np.r_[cut, len(region)]))[1]) if len(cut) else np.zeros(0, np.int64)
        text += [data[at_byte:low], region]
        placed += [starts[at_segment:first] + moved, cut + low + moved]
        counted += [counts[at_segment:first], found]
        same = same and keeps
        moved += len(region) - (high - low)
        at_byte, at_segment = high, last + 1
        again += last - first + 1 if len(starts) else 0
    new_starts = np.concatenate([*placed, starts[at_segment:] + moved])
    new_counts = np.concatenate([*counted, counts[at_segment:]])
    if same and len(starts):
        tree = tree.copy()
        for first, _, _ in spans:
            replace(tree, first, int(new_counts[first]))
    else:
        tree = sums(new_counts)
    return np.concatenate([*text, data[at_byte:]]), new_starts, tree, again


EDITS = T.ArrayType(
    T.StructType().add("start", T.IntegerType()).add("end", T.IntegerType()).add("replacement", T.StringType())
)


def masked(docs: DataFrame, pattern: str, replacement: str, text: str = "text", edits: str = "edits") -> DataFrame:
    """``docs`` with the edits that put ``replacement`` where ``pattern`` matches; none in null and empty texts."""
    kept = [c for c in docs.columns if c != edits]
    place = kept.index(text)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matches = re.compile(pattern).finditer
        kind = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("replacement", pa.string())])
        for batch in batches:
            spans = [[m.span() for m in matches(x)] if x else [] for x in batch.column(place).to_pylist()]
            bounds = np.cumsum([0, *map(len, spans)])
            flat = np.array([p for own in spans for p in own], np.int32).reshape(-1, 2)
            values = pa.StructArray.from_arrays(
                [pa.array(flat[:, 0]), pa.array(flat[:, 1]), pa.array([replacement] * len(flat), pa.string())], fields=list(kind)
            )
            found = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*kept, edits])

    rows = docs.select(kept)
    return rows.mapInArrow(find, docs.select(kept).schema.add(edits, EDITS))


KEPT = "id long, text string, starts array<int>, tree array<long>"


def build(docs: DataFrame, s: Settings, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, text, starts, tree)`` of every row: where its segments begin in bytes of UTF-8, and the tree of their token counts.

    The table is what later edits start from. ``tree[1]`` is the count of the whole text. A null text is kept as an empty one, which has
    no segments; very long texts are encoded whole; rows are handled each by itself, so repeated ids and rows don't matter. Other columns are not
    read. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(s.vocabulary, s.pattern)
        for batch in batches:
            for block in blocks(batch.column(1)):
                starts, counts = _segments(block, s, encode)
                texts = batch.column(1).slice(block.first, len(block)).fill_null("")
                yield _kept(batch.column(0).slice(block.first, len(block)), texts, starts, [sums(c) for c in counts], [])

    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    run = tidy(run, holds=True, after=lambda: encoder(s.vocabulary, s.pattern).forget())
    return rows.mapInArrow(run, KEPT).withColumnsRenamed({"id": id, "text": text})


def _kept(ids, texts, starts, trees, numbers) -> pa.RecordBatch:
    columns = [ids, texts, pa.array([x.astype(np.int32) for x in starts], pa.list_(pa.int32())), pa.array(trees, pa.list_(pa.int64()))]
    names = ["id", "text", "starts", "tree", *NUMBERS][: 4 + len(numbers)]
    return pa.RecordBatch.from_arrays([*columns, *(pa.array(x, pa.int64()) for x in numbers)], names)


#: What ``apply`` tells of each row besides the kept columns.
NUMBERS = ("n_tokens", "n_tokens_edited", "n_edits", "n_segments", "n_encoded_again")


def apply(kept: DataFrame, s: Settings, id: str = "doc_id", text: str = "text", edits: str = "edits") -> DataFrame:
    """Rows of :func:`build` after their edits, in the same form, with ``n_tokens`` before and ``n_tokens_edited`` after the edits,
    ``n_edits``, and of ``n_segments`` how many were encoded again.

    ``edits`` is an array of structs ``start``, ``end``, ``replacement`` in characters of the text, in order and not overlapping; null is
    none. Rows without edits are not encoded at all. The result can be kept and edited again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(s.vocabulary, s.pattern)
        for batch in batches:
            texts, starts, trees, numbers = [], [], [], []
            for own, at, tree, changes in zip(*(batch.column(c) for c in range(1, 5))):
                data = np.frombuffer(own.as_py().encode(), np.uint8)
                at, tree = (x.values.to_numpy().astype(np.int64) for x in (at, tree))
                places = _in_bytes(data, changes.as_py() or [])
                new, new_at, new_tree, again = edited(data, at, tree, places, encode, s.segment_bytes) if places else (data, at, tree, 0)
                texts.append(new.tobytes().decode()), starts.append(new_at), trees.append(new_tree)
                numbers.append((int(tree[1]), int(new_tree[1]), len(places), len(at), again))
            yield _kept(batch.column(0), pa.array(texts, pa.string()), starts, trees, list(zip(*numbers)) or [()] * len(NUMBERS))

    rows = kept.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"), "starts", "tree", F.col(edits).alias("edits"))
    run = tidy(run, holds=True, after=lambda: encoder(s.vocabulary, s.pattern).forget())
    schema = KEPT + "".join(f", {n} long" for n in NUMBERS)
    return rows.mapInArrow(run, schema).withColumnsRenamed({"id": id, "text": text})


def with_edits(kept: DataFrame, edits: DataFrame, id: str = "doc_id", column: str = "edits") -> DataFrame:
    """Kept rows with the edits that a table ``(id, start, end, replacement)`` has for them, in order of their places, insertions at one place
    in order of their texts. All rows that repeat an id get its edits; edits of an id that has no row, or of a null id, change nothing. One document's edits are gathered in one row."""
    place = F.struct(F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"), F.col("replacement"))
    gathered = edits.where(F.col(id).isNotNull()).groupBy(id).agg(F.array_sort(F.collect_list(place)).alias(column))
    return kept.drop(column).join(gathered, id, "left")


def _segments(block: Block, s: Settings, encode: Encoder) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Of each row, where its segments begin and how many tokens each has; the whole block is encoded at once."""
    starts = [_starts(block.data[a:b], s.segment_bytes) for a, b in zip(block.offsets[:-1], block.offsets[1:])]
    at = np.concatenate([x + o for x, o in zip(starts, block.offsets)]).astype(np.int64)
    ids, begins = encode.block(Block(0, block.data, np.r_[at, len(block.data)]))
    del ids
    counts = np.diff(begins)
    edges = np.cumsum([0, *map(len, starts)])
    return starts, [counts[a:b] for a, b in zip(edges[:-1], edges[1:])]


def _in_bytes(data: np.ndarray, edits: list[dict]) -> list[tuple[int, int, bytes]]:
    """Edits with places in bytes of the text's UTF-8."""
    if not edits:
        return []
    first_bytes = np.r_[np.flatnonzero((data & 0xC0) != 0x80), len(data)]
    return [(int(first_bytes[e["start"]]), int(first_bytes[e["end"]]), (e["replacement"] or "").encode()) for e in edits]
