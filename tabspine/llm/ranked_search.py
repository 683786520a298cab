"""Ranked search with hashed max-sketches: bounds on every score from a small index, exact scores only where bounds ask for them.

A term's part in a score grows with its occurrences in a document. So a sketch keeps, for each of ``coordinates`` hash values, the
maximum over the document's terms that fall there, as occurrences; with the document's length these are impacts. The sketches are
written once, without a look at the queries. For a batch of queries each sketch gives upper bounds of all its scores in one
product of matrices.

The documents with the highest bounds are scored exactly, and the last of the best sets a threshold. Then, in descending order of
bounds and in growing helpings, documents whose bound reaches the threshold are scored, which raises it, until none is left. What
is below the threshold by its bound can't be among the best, so the result is exact.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabspine.llm.blocks import LOWER, MARK, blocks, places, run_hashes
from tabspine.llm.decontamination import normal_words
from tabspine.sources.scratch import materialize

_BLOCK = 1 << 20
#: Numbers in the largest matrix of a task.
_CELLS = 1 << 20


@dataclass(frozen=True)
class Settings:
    """``best``: documents returned for an item. ``helping``: documents by item scored in the first round, ``growth`` times as many in each after.

    ``items`` and ``item_bytes``: items looked up together, and their text, on average; a larger collection is searched in batches.
    ``wanted``: pairs of documents and items up to which they are sent to the documents, at most 16 bytes each; more are joined.
    """

    coordinates: int = 1 << 14
    best: int = 10
    helping: int = 40
    growth: int = 8
    items: int = 512
    item_bytes: int = 4 << 20
    wanted: int = 250_000


@dataclass(frozen=True)
class Collection:
    """Documents with a term, all their terms, and the weights of a batch's terms."""

    documents: int
    terms: int
    weights: dict[bytes, int]

    def damping(self, n):
        """What a document's length adds to the occurrences of a term, in eighths of a thousandth."""
        return 100 - 75 + (75 * n * self.documents) // self.terms


def saturation(tf, damping):
    return (1_000_000_000 * tf) // (1000 * tf + 8 * damping)


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def sketches(docs: DataFrame, s: Settings) -> DataFrame:
    """``(id, n, coordinates, tops)`` of each document with a term: its terms with repeats, and the nonzero maxima of its sketch."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1), _BLOCK):
                starts, ends, row = places(block, MARK)
                hashes = run_hashes(LOWER[block.data], starts, ends)
                order = np.lexsort((hashes, row))
                hashes, row = hashes[order], row[order]
                new = np.flatnonzero(np.r_[True, (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])][: len(row)])
                tf = np.diff(np.r_[new, len(row)])
                cell = row[new] * s.coordinates + (hashes[new] % np.uint64(s.coordinates)).astype(np.int64)
                order = np.argsort(cell, kind="stable")
                cell, tf = cell[order], tf[order]
                first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]][: len(cell)])
                tops = np.maximum.reduceat(tf, first) if len(first) else tf
                cell = cell[first]
                kept = np.unique(row)
                ends = np.r_[np.searchsorted(cell, kept * s.coordinates), len(cell)].astype(np.int32)
                arrays = [
                    batch.column(0).take(pa.array(kept + block.first)), pa.array(np.bincount(row, minlength=len(block))[kept]),
                    pa.ListArray.from_arrays(ends, pa.array((cell % s.coordinates).astype(np.int32))),
                    pa.ListArray.from_arrays(ends, pa.array(tops)),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["id", "n", "coordinates", "tops"])

    return docs.mapInArrow(fold, "id long, n long, coordinates array<int>, tops array<long>")


def _frequencies(docs: DataFrame, vocabulary: frozenset[bytes]) -> dict[bytes, int]:
    """In how many documents each term of the batch occurs."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0):
                seen.update(sent.value.intersection(normal_words((text.as_py() or "").encode())))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["term", "df"])

    counted = docs.select("text").mapInArrow(count, "term binary, df long").groupBy("term").agg(F.sum("df").alias("df"))
    found = {bytes(r["term"]): r["df"] for r in counted.collect()}
    sent.unpersist()
    return found


def _coordinates(terms: list[bytes], n: int) -> np.ndarray:
    data = np.frombuffer(b"".join(terms), np.uint8)
    ends = np.cumsum([len(t) for t in terms])
    return (run_hashes(data, np.r_[0, ends[:-1]], ends) % np.uint64(n)).astype(np.int64)


@dataclass(frozen=True)
class _Batch:
    """Queries of a batch: the coordinates of their terms, in order, and a row for each with a column for each query."""

    coordinates: np.ndarray
    factors: np.ndarray

    @classmethod
    def of(cls, queries: list[Counter[bytes]], weights: dict[bytes, int], n: int) -> _Batch:
        terms = sorted({t for q in queries for t in q if weights.get(t)})
        own, place = np.unique(_coordinates(terms, n), return_inverse=True) if terms else (np.zeros(0, np.int64), [])
        at = dict(zip(terms, place))
        factors = np.zeros((len(own), len(queries)))
        for j, q in enumerate(queries):
            for term, times in q.items():
                if term in at:
                    factors[at[term], j] += times * weights[term]
        return cls(own, factors)


def _bounds(batch: pa.RecordBatch, queries: _Batch, all: Collection, n_coordinates: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids of some sketches and the bounds of their scores, a row for each; sums of whole numbers, exact in doubles up to 2^53."""
    width = len(queries.coordinates)
    column = np.full(n_coordinates, -1)
    column[queries.coordinates] = np.arange(width)
    ids, n = (batch.column(c).to_numpy() for c in (0, 1))
    lists, tops = batch.column(2), batch.column(3)
    offsets = lists.offsets.to_numpy()
    at = column[lists.values.to_numpy()]
    known = np.flatnonzero(at >= 0)
    row = np.searchsorted(offsets, known, "right") - 1
    inside = (row >= 0) & (row < len(ids))
    known, row = known[inside], row[inside]
    impact = saturation(tops.values.to_numpy()[known], all.damping(n)[row])
    step = max(1, _CELLS // max(1, width, queries.factors.shape[1]))
    for low in range(0, len(ids), step):
        high = min(len(ids), low + step)
        first, last = np.searchsorted(row, (low, high))
        sketch = np.zeros((high - low, width))
        sketch[row[first:last] - low, at[known[first:last]]] = impact[first:last]
        yield ids[low:high], sketch @ queries.factors


def _highest(index: DataFrame, sent, all: Collection, s: Settings) -> DataFrame:
    """For each query and task, the ``best`` documents by their bounds."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = sent.value
        best = np.zeros((queries.factors.shape[1], s.best))
        names = np.zeros((queries.factors.shape[1], s.best), np.int64)
        for batch in batches:
            for ids, found in _bounds(batch, queries, all, s.coordinates):
                better = np.flatnonzero(found.max(axis=0, initial=0) > best.min(axis=1))
                every = np.concatenate([best[better], found.T[better]], axis=1)
                whose = np.concatenate([names[better], np.broadcast_to(ids, (len(better), len(ids)))], axis=1)
                top = np.argpartition(-every, s.best - 1, axis=1)[:, : s.best]
                best[better], names[better] = np.take_along_axis(every, top, 1), np.take_along_axis(whose, top, 1)
        query, place = np.nonzero(best > 0)
        yield _pairs(query, names[query, place], best[query, place])

    return index.mapInArrow(look, _PAIRS)


def _reaching(index: DataFrame, sent, least: np.ndarray, all: Collection, s: Settings) -> DataFrame:
    """The documents whose bound is above zero and reaches their query's threshold."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, found in _bounds(batch, sent.value, all, s.coordinates):
                place, query = np.nonzero((found >= least) & (found > 0))
                yield _pairs(query, ids[place], found[place, query])

    return index.mapInArrow(look, _PAIRS)


_PAIRS = "query int, id long, bound long"


def _pairs(query: np.ndarray, ids: np.ndarray, bound: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array(query.astype(np.int32)), pa.array(ids), pa.array(bound.astype(np.int64))]
    return pa.RecordBatch.from_arrays(arrays, ["query", "id", "bound"])


def _exact(docs: DataFrame, pairs: DataFrame, queries: list[Counter[bytes]], all: Collection, s: Settings) -> DataFrame:
    """``(query, id, score)`` of all rows with the ids of ``pairs``, from their whole texts."""
    pairs = materialize(pairs.select("query", "id"), "pairs")
    wanted = pairs.groupBy("id").agg(F.collect_set("query").alias("queries"))
    wanted = F.broadcast(wanted) if pairs.count() <= s.wanted else wanted
    sent = docs.sparkSession.sparkContext.broadcast(queries)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[int, int, int]] = []
            for id, text, own in zip(*(batch.column(c) for c in range(3))):
                terms = Counter(normal_words((text.as_py() or "").encode()))
                damping = all.damping(terms.total())
                for q in own.as_py():
                    found = sum(
                        times * all.weights[t] * saturation(terms[t], damping) for t, times in sent.value[q].items() if t in terms
                    )
                    if found > 0:
                        rows.append((q, id.as_py(), found))
            query, ids, scores = zip(*rows) if rows else ((), (), ())
            arrays = [pa.array(query, pa.int32()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["query", "id", "score"])

    joined = docs.join(wanted, "id").select("id", "text", "queries")
    return materialize(joined.mapInArrow(score, "query int, id long, score long"), "scores")


def _first(rows: DataFrame, by: str, n: int, out: str = "rank") -> DataFrame:
    """The ``n`` highest rows of each query, equal ones by smaller id, numbered. Each task sends at most ``n`` a query."""
    order = Window.partitionBy("query").orderBy(F.desc(by), "id")
    return rows.withColumn(out, F.row_number().over(order)).where(F.col(out) <= n)


def _search(spark: SparkSession, docs: DataFrame, index: DataFrame, queries: list[Counter[bytes]], all: Collection, s: Settings) -> DataFrame:
    """``(query, rank, id, score)`` of a batch."""
    batch = _Batch.of(queries, all.weights, s.coordinates)
    sent = spark.sparkContext.broadcast(batch)
    helping = materialize(_first(_highest(index, sent, all, s), "bound", s.helping), "highest")
    scored = _exact(docs, helping, queries, all, s)
    done, open_ = helping.select("query", "id"), None
    n = s.helping * s.growth
    while True:
        best = _first(scored, "score", s.best)
        least = np.zeros(len(queries))
        for r in best.where(F.col("rank") == s.best).collect():
            least[r["query"]] = r["score"]
        if open_ is None:
            open_ = _reaching(index, sent, least, all, s)
        else:
            least_rows = spark.createDataFrame([(q, int(x)) for q, x in enumerate(least)], "query int, least long")
            open_ = open_.join(F.broadcast(least_rows), "query").where("bound >= least").drop("least")
        open_ = materialize(open_.join(done, ["query", "id"], "left_anti"), "open")
        helping = materialize(_first(open_, "bound", n), "helping")
        if helping.isEmpty():
            return best.select("query", "rank", "id", "score")
        scored = materialize(best.select("query", "id", "score").unionByName(_exact(docs, helping, queries, all, s)), "best")
        done, n = helping.select("query", "id"), n * s.growth


def ranked(
    docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    settings: Settings | None = None,
) -> DataFrame:
    """``(item_id, rank, id, score)``: the best documents for each item, the highest score first, equal ones by ascending id.

    Rows that are equal in id and text are one item; rows that share only the id are ranked each. Items without a term, or
    whose terms no document has, have no rows. Documents without a term are in no count; those with a null id are counted but
    can't be ranked, having no name; rows that repeat an id are documents of their own. Very long texts are read whole; their
    sketches are full, so their bounds are loose and they are scored more often. Other columns are not read.
    """
    s = settings or Settings()
    spark = docs.sparkSession
    docs = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    items = materialize(items.select(F.col(item_id).alias("item"), F.col(item_text).cast("string").alias("words")).distinct(), "items")
    schema = items.select(F.lit(0).alias("query"), "item").schema
    index = materialize(sketches(docs, s), "sketches")
    documents, terms = index.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    named = index.where("id is not null")
    n, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("words")), F.lit(0))).first()
    batches = max(1, -(-n // s.items), -(-size // s.item_bytes))
    results = []
    for number in range(batches):
        rows = items.where(F.pmod(F.xxhash64("item", "words"), F.lit(batches)) == number).collect()
        queries = [Counter(normal_words((r["words"] or "").encode())) for r in rows]
        vocabulary = frozenset(t for q in queries for t in q)
        if not vocabulary or not documents:
            continue
        df = _frequencies(docs, vocabulary)
        weights = {t: weight(documents, df.get(t, 0)) for t in vocabulary}
        found = _search(spark, docs.where("id is not null"), named, queries, Collection(documents, terms, weights), s)
        names = spark.createDataFrame([(q, r["item"]) for q, r in enumerate(rows)], schema)
        results.append(materialize(found.join(F.broadcast(names), "query").select("item", "rank", "id", "score"), "ranked"))
    empty = items.select("item", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("id"), F.lit(0).cast("long").alias("score")).limit(0)
    for found in results:
        empty = empty.unionByName(found)
    return empty.select(F.col("item").alias(item_id), "rank", F.col("id").alias(id), "score")
