"""Approximate nearest neighbours: a graph built by NN-descent, searched greedily.

A neighbour of a neighbour is likely a neighbour. Every vector starts with the nearest of a few random-projection cells. Each
round is a join: the members of a vector's neighbourhood, forward and reverse, meet in one group and are compared with each
other; pairs of which both have been together before are left out. What is nearer than the furthest neighbour so far goes to that
vector, which keeps the best. Rounds end when few neighbours change. A query walks the finished graph: the nearest vectors seen so
far are expanded to their neighbours until no nearer ones appear.

Cells that come out too large are halved at the median of further random projections, so a tight cluster of distinct vectors is
dealt anew in each cell. Vectors are compared as they are, never rounded, so neither an outlier nor near copies change what is near. Equal
vectors are one vertex, so a vector that a third of all rows share is as cheap as any other.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from tabspine.sources.scratch import materialize


@dataclass(frozen=True)
class Settings:
    """``degree``: neighbours of a vertex. ``cells`` and ``cell_rows``: how often, and into cells of about how many, vectors are dealt to start. ``sent``: most
    that one group tells one member. ``rounds`` at most, or until under ``stop`` of the neighbours change. ``width``: vertices that a search keeps and expands;
    ``steps`` of a search at most. ``group``: members compared at once; larger cells are split, larger neighbourhoods are compared in parts that
    each vertex and round deals anew. ``hub``: memberships from which the candidates of a vertex are merged in parts first."""

    degree: int = 32
    cells: int = 4
    cell_rows: int = 200
    sent: int = 8
    rounds: int = 9
    stop: float = 0.01
    width: int = 64
    steps: int = 4
    group: int = 512
    hub: int = 4096
    seed: int = 17


def usable(rows: DataFrame, id: str, vector: str) -> DataFrame:
    """``(id, vector)`` as doubles: rows with an id whose vector is neither null nor zero, all finite, and of the commonest length."""
    rows = rows.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where(F.col("id").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
    size = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("vector") == (size["n"] if size else 0))


def _vectors(column, kind: str) -> np.ndarray:
    """A binary column of packed vectors as rows of doubles."""
    data = column.to_pylist()
    return np.frombuffer(b"".join(data), kind).reshape(len(data), -1).astype(np.float64)


def _kind(rows: DataFrame, vector: str) -> str:
    """How components are packed without loss: floats as floats, all else as doubles."""
    return "<f4" if isinstance(getattr(rows.schema[vector].dataType, "elementType", None), FloatType) else "<f8"


def _groups(key: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    edges = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
    for low, high in zip(edges[:-1], edges[1:]):
        for part in range(low, high, most):
            yield part, min(part + most, high)


def _whole_groups(function: Callable[[pa.Table], pa.RecordBatch]):
    """Calls a function with all rows of some groups; rows come sorted by their first column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            rows = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch]).combine_chunks()
            key = rows.column(0).to_numpy()
            cut = int(np.flatnonzero(key != key[-1])[-1]) + 1 if len(key) and key[0] != key[-1] else 0
            rest = rows.slice(cut)
            if cut:
                yield function(rows.slice(0, cut))
        if rest is not None and rest.num_rows:
            yield function(rest)

    return run


def _found(v: list, w: list, d: list) -> pa.RecordBatch:
    """Candidate lists of vertices as packed bytes."""
    arrays = [pa.array(np.concatenate(v) if v else np.zeros(0, np.int64)), pa.array(w, pa.binary()), pa.array(d, pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, ["v", "w", "d"])


def _local_join(sent: int, most: int, all_pairs: bool, kind: str):
    """Compares the members of each group; tells each member its nearest others that are near enough."""

    def compare(rows: pa.Table) -> pa.RecordBatch:
        key, ids = (rows.column(i).to_numpy() for i in range(2))
        q, worst, fresh = _vectors(rows.column(2), kind), rows.column(3).to_numpy(), rows.column(4).to_numpy(zero_copy_only=False)
        out_v, out_w, out_d = [], [], []
        for low, high in _groups(key, most):
            x, own, new = q[low:high], ids[low:high], fresh[low:high]
            if high - low < 2 or not (all_pairs or new.any()):
                continue
            x = x - x[0]  # members are alike: products of what is left of them lose less
            square = (x * x).sum(axis=1)
            d = np.maximum(square[:, None] + square[None, :] - 2 * (x @ x.T), 0)
            bad = (own[:, None] == own[None, :]) | (d >= worst[low:high, None])
            if not all_pairs:
                bad |= ~(new[:, None] | new[None, :])
            d[bad] = np.inf
            take = min(sent, high - low)
            near = np.argpartition(d, take - 1, axis=1)[:, :take]
            ok = np.isfinite(np.take_along_axis(d, near, axis=1))
            some = np.flatnonzero(ok.any(axis=1))
            out_v.append(own[some])
            for i in some:
                found = near[i][ok[i]]
                out_w.append(own[found].astype("<i8").tobytes())
                out_d.append(((q[low + found] - q[low + i]) ** 2).sum(axis=1).astype("<f8").tobytes())
        return _found(out_v, out_w, out_d)

    return _whole_groups(compare)


_GRAPH = "v long, q binary, ids array<long>, dist array<double>, fresh array<boolean>, changed long"


def _merge(degree: int):
    """Keeps the nearest of each vertex's neighbours and candidates; ``fresh`` marks those it did not have."""

    def best(rows: pa.Table) -> pa.RecordBatch:
        key = rows.column(0).to_numpy()
        q, w, d, old = (rows.column(i).to_pylist() for i in range(1, 5))
        out = []
        for low, high in _groups(key, len(key)):
            own = next((x for x in q[low:high] if x is not None), None)
            if own is None:
                continue
            ids = np.frombuffer(b"".join(w[low:high]), "<i8")
            dist = np.frombuffer(b"".join(d[low:high]), "<f8")
            known = np.concatenate([np.full(len(w[k]) // 8, bool(old[k])) for k in range(low, high)])
            order = np.lexsort((~known, ids))  # a known neighbour before its repetition as a candidate
            ids, dist, known = ids[order], dist[order], known[order]
            once = np.r_[True, ids[1:] != ids[:-1]] if len(ids) else np.zeros(0, bool)
            ids, dist, known = ids[once], dist[once], known[once]
            near = np.lexsort((ids, dist))[:degree]
            out.append((int(key[low]), own, ids[near].tolist(), dist[near].tolist(), (~known[near]).tolist(), int((~known[near]).sum())))
        columns = list(zip(*out)) if out else [[]] * 6
        kinds = [pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.bool_()), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kinds)], ["v", "q", "ids", "dist", "fresh", "changed"]
        )

    return _whole_groups(best)


def _packed_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbour lists as packed bytes, like candidates."""
    for batch in batches:
        w = [np.asarray(x, "<i8").tobytes() for x in batch.column(2).to_pylist()]
        d = [np.asarray(x, "<f8").tobytes() for x in batch.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(w, pa.binary()), pa.array(d, pa.binary())], ["v", "q", "w", "d"])


def _updated(graph: DataFrame, candidates: DataFrame, s: Settings) -> DataFrame:
    lists = graph.select("v", "q", "ids", "dist").mapInArrow(_packed_lists, "v long, q binary, w binary, d binary")
    told = candidates.select("v", F.lit(None).cast("binary").alias("q"), "w", "d", F.lit(False).alias("old"))
    both = lists.withColumn("old", F.lit(True)).unionByName(told)
    return both.repartition("v").sortWithinPartitions("v").mapInArrow(_merge(s.degree), _GRAPH)


def neighbourhoods(graph: DataFrame) -> DataFrame:
    """``(u, m, fresh)``: members of each vertex's neighbourhood, by edges in either direction, and the vertex itself."""
    edges = graph.select("v", F.explode(F.arrays_zip("ids", "fresh")).alias("e")).select(
        "v", F.col("e.ids").alias("w"), F.col("e.fresh").alias("fresh")
    )
    forward = edges.select(F.col("v").alias("u"), F.col("w").alias("m"), "fresh")
    reverse = edges.select(F.col("w").alias("u"), F.col("v").alias("m"), "fresh")
    return forward.unionByName(reverse)


def _parts(graph: DataFrame, turn: int, s: Settings) -> tuple[DataFrame, DataFrame]:
    """``(u, m, fresh)`` of the neighbourhoods that have a fresh edge, those of more than ``group`` members in parts under names of their own; and
    ``(u, n)``, the members of each neighbourhood. A vertex that is in every list is so compared in many tasks."""
    members = neighbourhoods(graph)
    sizes = materialize(members.groupBy("u").agg(F.count("*").alias("n"), F.max("fresh").alias("any")), "sizes")
    part = F.pmod(F.xxhash64("m", "u", F.lit(turn)), F.ceil(F.col("n") / s.group))
    name = F.when(F.col("n") <= s.group, F.col("u")).otherwise(F.xxhash64("u", part, F.lit(turn)))
    return members.join(sizes.where("any").select("u", "n"), "u").select(name.alias("u"), "m", "fresh"), sizes.select("u", "n")


def _folded(candidates: DataFrame, hubs: DataFrame, s: Settings) -> DataFrame:
    """Candidates in which those of vertices with very many are merged in parts first, to the nearest of each part."""

    def nearest(rows: pa.Table) -> pa.RecordBatch:
        key, v = (rows.column(i).to_numpy() for i in range(2))
        w, d = (rows.column(i).to_pylist() for i in (2, 3))
        out_v, out_w, out_d = [], [], []
        for low, high in _groups(key, len(key)):
            ids, first = np.unique(np.frombuffer(b"".join(w[low:high]), "<i8"), return_index=True)
            dist = np.frombuffer(b"".join(d[low:high]), "<f8")[first]
            near = np.lexsort((ids, dist))[: s.degree]
            out_v.append(v[low : low + 1]), out_w.append(ids[near].tobytes()), out_d.append(dist[near].tobytes())
        return _found(out_v, out_w, out_d)

    part = F.pmod(F.xxhash64("w"), F.ceil(F.col("n") / s.hub))
    of_hubs = candidates.join(hubs, "v").select(F.xxhash64("v", part).alias("key"), "v", "w", "d")
    folded = of_hubs.repartition("key").sortWithinPartitions("key").mapInArrow(_whole_groups(nearest), "v long, w binary, d binary")
    return candidates.join(hubs, "v", "left_anti").select("v", "w", "d").unionByName(folded)


def _split_cells(start: DataFrame, dealt: DataFrame, dimensions: int, s: Settings, kind: str, most: int) -> DataFrame:
    """``(v, c, u)`` in which cells ``u`` of more than ``group`` vertices are halved until none is left, ``most`` times at most.

    A cell is halved at the median of its members' projections on a random direction, which each of the ``cells`` draws for itself.
    """
    done: list[DataFrame] = []
    for level in range(most):
        directions = np.random.default_rng([s.seed, level]).normal(size=(dimensions, s.cells))

        def project(batches: Iterator[pa.RecordBatch], directions=directions) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                p = _vectors(batch.column(1), kind) @ directions
                columns = [np.repeat(batch.column(0).to_numpy(), s.cells), np.tile(np.arange(s.cells), batch.num_rows), p.ravel()]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["v", "c", "p"])

        large = materialize(dealt.groupBy("u").agg(F.count("*").alias("n")).where(F.col("n") > s.group).select("u"), "large")
        if large.isEmpty():
            break
        # Cells that are small enough stay as they are; only members of the others are projected and written again.
        done.append(dealt.join(large, "u", "left_anti").select("v", "c", "u"))
        members = dealt.join(large, "u", "left_semi")
        vectors = start.select("v", "q").join(members.select("v").distinct(), "v", "left_semi")
        placed = materialize(vectors.mapInArrow(project, "v long, c long, p double").join(members, ["v", "c"]), "placed")
        middle = placed.groupBy("u").agg(F.percentile_approx("p", 0.5).alias("middle"))
        half = F.xxhash64("u", F.col("p") > F.col("middle"))
        dealt = materialize(placed.join(middle, "u").select("v", "c", half.alias("u")), "dealt")
    return reduce(DataFrame.unionByName, [*done, dealt.select("v", "c", "u")])


def build(vectors: DataFrame, s: Settings, kind: str = "<f8") -> DataFrame:
    """The neighbour graph ``(v, q, ids, dist, fresh, changed)`` of distinct vectors ``(id, vector)``; ``q`` is the vector packed as ``kind``."""
    n = vectors.count()
    size = vectors.select(F.size("vector").alias("n")).first()
    dimensions = size["n"] if size else 0
    bits = max(0, math.ceil(math.log2(max(n, 1) / s.cell_rows)))
    planes = np.random.default_rng(s.seed).normal(size=(s.cells, dimensions, bits))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = np.asarray(batch.column(1).flatten(), float).reshape(batch.num_rows, dimensions)
            codes = [((flat @ planes[c] > 0) * (1 << np.arange(bits))).sum(axis=1) + (c << 40) for c in range(s.cells)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([x.tobytes() for x in flat.astype(kind)], pa.binary()),
                    pa.array(np.stack(codes, axis=1).tolist(), pa.list_(pa.int64())),
                ],
                ["v", "q", "cells"],
            )

    start = materialize(vectors.select("id", "vector").mapInArrow(packed, "v long, q binary, cells array<long>"), "vertices")
    cells = start.select("v", F.posexplode("cells").alias("c", "u")).select("v", F.col("c").cast("long").alias("c"), "u")
    cells = _split_cells(start, cells, dimensions, s, kind, bits + 8)
    dealt = cells.join(start.select("v", "q"), "v").select(
        "u", "v", "q", F.lit(float("inf")).alias("worst"), F.lit(True).alias("fresh")
    )
    first = dealt.repartition("u").sortWithinPartitions("u", F.xxhash64("v", "u")).mapInArrow(
        _local_join(s.degree, s.group, True, kind), "v long, w binary, d binary"
    )
    empty = start.select("v", "q", F.array().cast("array<long>").alias("ids"), F.array().cast("array<double>").alias("dist"))
    graph = materialize(_updated(empty, first, s), "graph")
    for turn in range(s.rounds):
        worst = F.when(F.size("ids") < s.degree, float("inf")).otherwise(F.element_at("dist", -1))
        members, sizes = _parts(graph, turn, s)
        members = members.join(graph.select(F.col("v").alias("m"), "q", worst.alias("worst")), "m")
        members = members.select("u", "m", "q", "worst", "fresh").repartition("u")
        members = members.sortWithinPartitions("u", F.xxhash64("m", "u", F.lit(turn)))
        candidates = members.mapInArrow(_local_join(s.sent, s.group, False, kind), "v long, w binary, d binary")
        hubs = materialize(sizes.where(F.col("n") > s.hub).select(F.col("u").alias("v"), "n"), "hubs")
        if not hubs.isEmpty():
            candidates = _folded(materialize(candidates, "candidates"), hubs, s)
        graph = materialize(_updated(graph, candidates, s), "graph")
        changed = graph.agg(F.coalesce(F.sum("changed"), F.lit(0))).first()[0]
        if changed <= s.stop * s.degree * n:
            break
    return graph


def search(graph: DataFrame, queries: DataFrame, s: Settings, kind: str = "<f8") -> DataFrame:
    """``(query, v)``: the ``width`` vertices that a greedy walk from each query's own vertex finds nearest.

    ``queries`` has ``query``, a vertex of the graph. Each step expands, of the nearest seen, those not expanded yet.
    """
    near = materialize(neighbourhoods(graph).select("u", "m").distinct(), "links")
    points = graph.select("v", "q")
    asked = queries.select("query").join(points.select(F.col("v").alias("query"), F.col("q").alias("query_q")), "query")
    seen = asked.select("query", "query_q", F.col("query").alias("v"), F.lit(0.0).alias("d"), F.lit(False).alias("expanded"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = ((_vectors(batch.column(1), kind) - _vectors(batch.column(3), kind)) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(d, pa.float64())], ["query", "query_q", "v", "d"])

    nearest = Window.partitionBy("query").orderBy("d", "v")
    for _ in range(s.steps):
        seen = materialize(seen, "seen")
        ahead = seen.where("not expanded")
        if ahead.isEmpty():
            break
        reached = ahead.select("query", "query_q", F.col("v").alias("u")).join(near, "u").select("query", "query_q", F.col("m").alias("v"))
        reached = reached.dropDuplicates(["query", "v"]).join(seen.select("query", "v"), ["query", "v"], "left_anti")
        reached = reached.join(points, "v").select("query", "query_q", "v", "q").mapInArrow(
            measure, "query long, query_q binary, v long, d double"
        )
        every = seen.withColumn("expanded", F.lit(True)).unionByName(reached.withColumn("expanded", F.lit(False)))
        seen = every.withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= s.width + 1).drop("place")
    return seen.select("query", "v")


def nearest(rows: DataFrame, wanted, id: str = "vec_id", vector: str = "embedding", k: int = 10, settings: Settings | None = None) -> DataFrame:
    """``(query_id, rank, id, score)``: the ``k`` nearest rows found for each row that the condition ``wanted`` on ``id`` selects.

    Nearness is Euclidean distance, ties go to the smaller id, and a row is not its own neighbour. Null and zero vectors, vectors
    with null or non-finite components, of another length than most, or with a null id take no part. Rows that repeat an id and
    vector are one row. Fewer than ``k`` other rows give as many as there are; an empty table gives none.
    """
    s, kind = settings or Settings(), _kind(rows, vector)
    rows = materialize(usable(rows, id, vector).dropDuplicates(["id", "vector"]), "vectors")
    # Equal vectors are one vertex, named by its smallest id; of their ids the k + 1 smallest can be needed.
    vertices = materialize(rows.groupBy("vector").agg(F.min("id").alias("v")), "vertices")
    graph = build(vertices.select(F.col("v").alias("id"), "vector"), s, kind)
    named = rows.join(vertices, "vector")
    queries = materialize(named.where(wanted(F.col("id"))).select(F.col("id").alias("query_id"), F.col("v").alias("query")), "queries")
    found = search(graph, queries.select("query").distinct(), s, kind)
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    members = named.select("v", "id").withColumn("place", place).where(F.col("place") <= k + 1).drop("place")
    point = vertices.select("v", "vector")
    exact = found.join(point, "v").join(point.select(F.col("v").alias("query"), F.col("vector").alias("query_vector")), "query")
    apart = F.aggregate(F.zip_with("vector", "query_vector", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, x: t + x)
    exact = exact.select("query", "v", F.sqrt(apart).alias("score"))
    # The k + 1 nearest vertices, counted with all their members, hold the k nearest rows.
    order = Window.partitionBy("query").orderBy("score", "v")
    exact = exact.withColumn("place", F.row_number().over(order)).where(F.col("place") <= s.width + 1)
    pairs = exact.join(members, "v").join(queries, "query").where("id != query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id), "score")
