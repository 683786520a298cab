"""Benchmark passages in documents: one automaton over all questions and answers, each text scanned once.

Texts are normalised by bytes: A-Z in lower case, every mark a space, runs of spaces one. A window is a fixed number of
consecutive words of an item, or a shorter item whole. All windows form one Aho-Corasick automaton per worker, over words as numbers, which
finds them in a single scan of a document's words; these map back to characters of the original text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabspine.llm.blocks import LOWER, MARK, blocks
from tabspine.llm.workers import held, tidy
from tabspine.sources.scratch import materialize

_NORMAL = bytes(np.where(MARK, 32, LOWER).astype(np.uint8))
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


@dataclass(frozen=True)
class Settings:
    """``window``: words of a window. ``shard_bytes``: benchmark text in one automaton, on average; a larger benchmark is searched in as
    many passes as it has shards. ``part_words``: words of an item that go to one shard together."""

    window: int = 10
    shard_bytes: int = 2 << 20
    part_words: int = 20_000


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()


def _parts(items: DataFrame, s: Settings) -> DataFrame:
    """``(item, part, words)``: the words of each item between single spaces, a long item in parts that share a window less one word."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[str, int, bytes]] = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = normal_words(text.as_py().encode())
                for part, low in enumerate(range(0, max(1, len(words) - s.window + 1), s.part_words) if words else ()):
                    rows.append((item, part, b" ".join(words[low : low + s.part_words + s.window - 1])))
            item, part, words = zip(*rows) if rows else ((), (), ())
            arrays = [pa.array(item, pa.string()), pa.array(part, pa.int64()), pa.array(words, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["item", "part", "words"])

    return items.mapInArrow(tidy(cut), "item string, part long, words binary")


@dataclass
class _Windows:
    """An automaton over numbered words; each window has its number of words and the items that have it."""

    numbers: dict[bytes, int] = field(default_factory=dict)
    automaton: ahocorasick.Automaton | None = None
    runs: re.Pattern[bytes] | None = None

    @classmethod
    def of(cls, parts: list[tuple[str, bytes]], size: int) -> _Windows:
        made = cls()
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, words in parts:
            ids = [made.numbers.setdefault(w, len(made.numbers)) for w in words.split()]
            for i in range(max(1, len(ids) - size + 1)):
                owners.setdefault(tuple(ids[i : i + size]), set()).add(item)
        if owners:
            made.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
            made.runs = re.compile(b"\x01{%d,}" % min(map(len, owners)))
            while owners:
                window, items = owners.popitem()
                made.automaton.add_word(window, (len(window), tuple(items)))
            made.automaton.make_automaton()
        return made

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Words inside any window, as a mask; items that have a window here."""
        edges = np.zeros(len(words) + 1, np.int64)
        items: set[str] = set()
        if self.automaton is None:
            return edges[:-1] > 0, items
        # A window lies in a run of words that items have, as long as the shortest window at least.
        for run in self.runs.finditer(bytes(map(self.numbers.__contains__, words))):
            first = run.start()
            for last, (n, owners) in self.automaton.iter(tuple([self.numbers[w] for w in words[first : run.end()]])):
                edges[first + last - n + 1] += 1
                edges[first + last + 1] -= 1
                items.update(owners)
        return np.cumsum(edges[:-1]) > 0, items


def _spans(text: str, turns: list[int]) -> list[dict[str, int]]:
    """Runs of hit words as characters of the original text."""
    places = [m.span() for m in _WORD.finditer(text)]
    return [{"start": places[a][0], "end": places[b - 1][1]} for a, b in zip(turns[::2], turns[1::2])]


def contaminated(
    docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", settings: Settings | None = None,
) -> DataFrame:
    """``(id, n_words, n_hit, items, spans, contaminated)`` of every row of ``docs``.

    ``n_hit`` counts words inside any occurrence of a window, ``items`` lists the items with windows here as sorted strings,
    ``spans`` has the characters ``start`` (included) to ``end`` (not) of each run of hit words in the original text.
    Null and empty texts have no words and no hits, very long ones are scanned whole; items without words or with a null id have no
    windows, those that repeat an id are one; rows that repeat an id are scanned each; other columns are not read. A benchmark beyond ``shard_bytes`` is
    searched shard by shard, each a pass of its own over written rows, so that a worker holds one shard's windows at a time.
    """
    s = settings or Settings()
    spark = docs.sparkSession
    items = items.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).cast("string").alias("words"))
    parts = materialize(_parts(items.where("item is not null and words is not null"), s), "windows")
    total = parts.agg(F.coalesce(F.sum(F.octet_length("words")), F.lit(0)).alias("n")).first()["n"]
    shards = max(1, -(-total // s.shard_bytes))
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))

    def windows(shard: int):
        some = parts.where(F.pmod(F.xxhash64("item", "part"), F.lit(shards)) == shard)
        return spark.sparkContext.broadcast([(r["item"], bytes(r["words"])) for r in some.collect()])

    if shards == 1:
        return rows.mapInArrow(_search(windows(0), s.window, _report), _REPORT).withColumnRenamed("id", id)
    rows = materialize(rows.withColumn("place", F.monotonically_increasing_id()), "texts")
    found = []
    for shard in range(shards):
        sent = windows(shard)
        found.append(materialize(rows.select("place", "text").mapInArrow(_search(sent, s.window, _hits), _HITS), "hits"))
        sent.destroy()
    hits = reduce(DataFrame.unionByName, found).groupBy("place").agg(
        F.flatten(F.collect_list("turns")).alias("turns"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    )
    joined = rows.join(hits, "place", "left").select("id", "text", "turns", "items")
    return joined.mapInArrow(tidy(_joined_report), _REPORT).withColumnRenamed("id", id)


_REPORT = "id long, n_words long, n_hit long, items array<string>, spans array<struct<start: long, end: long>>, contaminated boolean"
_HITS = "place long, turns array<long>, items array<string>"
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _turns(hit: np.ndarray) -> list[int]:
    """The first word of each run of hit words and the first after it."""
    return np.flatnonzero(np.diff(np.r_[0, hit.astype(np.int8), 0])).tolist() if hit.any() else []


def _search(sent, size: int, report):
    """Scans the second column of batches for the windows of a broadcast; ``report`` makes rows of the ids, texts, words and hits of a block."""
    key = ("windows", sent._jbroadcast.id())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = held(key, lambda: _Windows.of(sent.value, size))
        for batch in batches:
            for block in blocks(batch.column(1)):
                n_words, turns, items, texts = [], [], [], []
                for i in range(len(block)):
                    words = normal_words(block.text(i))
                    hit, found = windows.scan(words)
                    n_words.append(len(words)), turns.append(_turns(hit)), items.append(sorted(found))
                    texts.append(block.text(i).decode() if found else "")
                yield report(batch.column(0).slice(block.first, len(block)), texts, n_words, turns, items)

    return tidy(scan, holds=True)


def _report(ids: pa.Array, texts: list[str], n_words: list[int], turns: list[list[int]], items: list[list[str]]) -> pa.RecordBatch:
    n_hit = [sum(t[1::2]) - sum(t[::2]) for t in turns]
    spans = [_spans(x, t) if t else [] for x, t in zip(texts, turns)]
    arrays = [
        ids, pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string())),
        pa.array(spans, _SPAN), pa.array([n > 0 for n in n_hit], pa.bool_()),
    ]
    return pa.RecordBatch.from_arrays(arrays, ["id", "n_words", "n_hit", "items", "spans", "contaminated"])


def _hits(ids: pa.Array, texts: list[str], n_words: list[int], turns: list[list[int]], items: list[list[str]]) -> pa.RecordBatch:
    """Only the rows with hits."""
    hit = [i for i, t in enumerate(turns) if t]
    arrays = [
        ids.take(pa.array(hit, pa.int64())), pa.array([turns[i] for i in hit], pa.list_(pa.int64())),
        pa.array([items[i] for i in hit], pa.list_(pa.string())),
    ]
    return pa.RecordBatch.from_arrays(arrays, ["place", "turns", "items"])


def _joined_report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reports rows with the hits of all shards, whose runs of words may overlap."""
    for batch in batches:
        for block in blocks(batch.column(1)):
            known, items = (batch.column(c).slice(block.first, len(block)).to_pylist() for c in (2, 3))
            n_words, turns, texts = [], [], []
            for i, own in enumerate(known):
                n_words.append(len(normal_words(block.text(i))))
                hit = np.zeros(n_words[-1], bool)
                for low, high in zip((own or [])[::2], (own or [])[1::2]):
                    hit[low:high] = True
                turns.append(_turns(hit))
                texts.append(block.text(i).decode() if own else "")
            yield _report(batch.column(0).slice(block.first, len(block)), texts, n_words, turns, [x or [] for x in items])
