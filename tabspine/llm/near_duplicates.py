"""Near-duplicate documents by a chosen-path set similarity join.

Every document is a set of word shingles. Equal sets collapse to one class first, so thousands of exact copies are one
vertex. Classes then walk down several independent trees: a node's members are split by the value of one minwise token, the
token being chosen by the node itself, until few enough remain to be compared with each other. Two sets of similarity ``s`` stay
together on a path of depth ``d`` with probability ``s ** d``, and the trees repeat that independently.

Nodes that stay large on the whole path hold sets that are all alike. They are cut into chunks. What is found in chunks first
becomes components; a second look at every node then takes only pairs whose ends lie in different components. In cut
nodes the members outside the node's main component meet all others block by block, two blocks to a task's group, however many there
are. So a dense group costs a forest, not all its pairs, and no link between components that share a node is lost. Links are confirmed
on full sets. A node is asked which of its members need be compared, not for their pairs, and answers with a forest of links, so that
rows are as many as its members, however many of them look alike.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabspine.llm.blocks import SPACE, blocks, distinct, mix, words
from tabspine.llm.components import components
from tabspine.llm.workers import tidy
from tabspine.sources.scratch import materialize

_HASH_COLUMNS = 4096
#: Numbers of nodes end in their tree. Trees beyond these share an end; their pairs may be looked at more than once.
_TREE_MASK = 1023


@dataclass(frozen=True)
class Settings:
    """What is linked, and how it is searched.

    ``shingle_words`` and ``percent``: a link joins sets of word shingles with 100 * intersection >= percent * union.
    ``recall`` and ``depth``: probability that two sets just similar enough meet in a last node even if all nodes on their ways split
    ``depth`` times, the most; as many trees are grown. ``node_size``: members of a node that are compared with
    each other; the chunks of larger last nodes have that size too. ``tokens``: minwise tokens that nodes
    choose from, which also estimate similarity; an estimate below ``floor`` is not checked on full sets.
    ``few_ids``: ids up to which looking up texts by id is a broadcast; their size is 8 bytes each.
    """

    shingle_words: int = 5
    percent: int = 80
    recall: float = 0.9999
    depth: int = 6
    node_size: int = 128
    tokens: int = 48
    floor: float = 0.5
    few_ids: int = 250_000
    seed: int = 11

    @property
    def trees(self) -> int:
        meet = (self.percent / 100) ** self.depth
        return 1 if meet >= 1 else math.ceil(math.log(1 - self.recall) / math.log(1 - meet))


def _shingles(block, size: int) -> list[np.ndarray]:
    """Each row's distinct shingles, sorted; fewer words than ``size`` make one shingle of all, no words none."""
    found, rows = words(block, SPACE), len(block)
    bounds, hashes = found.bounds(rows), found.hashes
    rolled = np.zeros(0, np.uint64)
    if len(hashes) >= size:
        rolled = hashes[: len(hashes) - size + 1].copy()
        for k in range(1, size):
            rolled = mix(rolled * np.uint64(0x9FB21C651E98DF25) + hashes[k : len(hashes) - size + 1 + k])
    sets = []
    for low, high in zip(bounds[:-1], bounds[1:]):
        if high - low >= size:
            sets.append(distinct(rolled[low : high - size + 1]))
        elif high > low:
            whole = np.uint64(high - low)
            for h in hashes[low:high]:
                whole = mix(np.asarray([whole * np.uint64(0xD6E8FEB86659FD93) + h]))[0]
            sets.append(np.asarray([whole], np.uint64))
        else:
            sets.append(rolled[:0])
    return sets


def _minima(shingles: np.ndarray, odd: np.ndarray, flip: np.ndarray) -> np.ndarray:
    """Minwise token of a set under each hash function."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(odd), 0xFFFFFFFF, np.uint32)
    for low in range(0, len(x), _HASH_COLUMNS):
        part = (x[None, low : low + _HASH_COLUMNS] ^ flip[:, None]) * odd[:, None]
        part ^= part >> np.uint32(15)
        np.minimum(least, part.min(axis=1), out=least)
    return least


def signatures(docs: DataFrame, id: str, text: str, s: Settings) -> DataFrame:
    """``(id, n_shingles, set_key, tokens, roots)``; without shingles the last three are null.

    ``set_key`` is the same for equal sets only. ``tokens`` has a byte of each minwise token, ``roots`` the node of each
    tree after its first two tokens, which ends in the number of the tree.
    """
    draw = np.random.default_rng(s.seed)
    n = s.tokens + 2 * s.trees
    odd, flip = (draw.integers(0, 1 << 32, n, np.uint32) for _ in range(2))
    odd |= np.uint32(1)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = np.arange(s.trees, dtype=np.uint64)
        mask = np.uint64(_TREE_MASK)
        with np.errstate(over="ignore"):
            for batch in batches:
                ids = batch.column(0)
                for block in blocks(batch.column(1)):
                    sizes, keys, tokens, roots = [], [], [], []
                    for found in _shingles(block, s.shingle_words):
                        sizes.append(len(found))
                        if not len(found):
                            keys.append(None), tokens.append(None), roots.append(None)
                            continue
                        keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                        least = _minima(found, odd, flip)
                        tokens.append((least[: s.tokens] & np.uint32(255)).astype(np.uint8).tobytes())
                        pairs = least[s.tokens :].reshape(s.trees, 2).astype(np.uint64)
                        node = mix(mix(pairs[:, 0] + (tree << np.uint64(32))) + pairs[:, 1])
                        roots.append((node & ~mask | tree & mask).astype(np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.slice(block.first, len(block)), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                            pa.array(tokens, pa.binary()), pa.array(roots, pa.list_(pa.int64())),
                        ],
                        ["id", "n_shingles", "set_key", "tokens", "roots"],
                    )

    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(tidy(sign), "id long, n_shingles long, set_key binary, tokens binary, roots array<long>")


def _part(set_key: str = "set_key"):
    """Tells the classes of a repeated id apart; two that it does not tell apart are compared in each other's nodes as well."""
    return F.hash(set_key).alias("part")


def _paths(classes: DataFrame, s: Settings) -> DataFrame:
    """``(node, id, part, path)``: the node of each tree after two tokens, and the tokens of all later ones, a byte each."""
    at = classes.select(F.explode("roots").alias("node"), "id", _part(), "tokens").withColumn("last", F.col("node"))
    path = [F.lit(bytearray())]
    for level in range(2, s.depth):
        chosen = F.pmod(F.xxhash64("last", F.lit(s.seed)), F.lit(s.tokens)).cast("int") + 1
        at = at.withColumn(f"token_{level}", F.substring(F.col("tokens"), chosen, F.lit(1)))
        at = at.withColumn("last", F.xxhash64("last", f"token_{level}", F.lit(level)))
        path.append(F.col(f"token_{level}"))
    return at.select("node", "id", "part", F.concat(*path).alias("path"))


def _child(*parts):
    """The node under ``node`` that the parts name, of the same tree."""
    tree = F.col("node").bitwiseAND(F.lit(_TREE_MASK))
    return F.xxhash64("node", *parts).bitwiseAND(F.lit(~_TREE_MASK)).bitwiseOR(tree)


def _nodes(classes: DataFrame, s: Settings) -> DataFrame:
    """``(node, id, part, whole)``: members of last nodes with more than one, large ones cut into chunks.

    ``whole`` is the node before it was cut, null for nodes that were small enough. What is shuffled for each tree and level is a
    class and the few tokens of its way; those that estimate similarity are looked up for members of last nodes only.
    """
    at = _paths(classes, s)
    ended = None
    for level in range(2, s.depth + 1):
        sizes = at.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
        sized = materialize(at.join(sizes, "node"), "nodes")
        small = sized.where(F.col("size") <= s.node_size).select("node", "id", "part", F.lit(None).cast("long").alias("whole"))
        ended = small if ended is None else ended.unionByName(small)
        large = sized.where(F.col("size") > s.node_size)
        if level == s.depth:
            chunks = F.ceil(F.col("size") / s.node_size).cast("long")
            chunk = F.pmod(F.xxhash64("node", "id"), chunks)
            return ended.unionByName(large.select(F.xxhash64("node", chunk).alias("node"), "id", "part", F.col("node").alias("whole")))
        token = F.substring("path", level - 1, 1)
        at = large.select(_child(token, F.lit(level)).alias("node"), "id", "part", "path")
    raise ValueError("depth must be at least 2")


def _close(nodes: DataFrame, classes: DataFrame, s: Settings, across: bool) -> DataFrame:
    """Pairs ``(a, b)`` of a node that may be links: each member names one partner, the smallest of those that surely look
    alike, else the likeliest.

    With ``across``, a pair that may be a link of its ends' different ``label``s, these beside it, for each member that has one, with
    the ``node`` and how many such pairs ``n`` it has: every member that need be compared is an end, but not every pair is there. Members of
    the same ``side`` are compared elsewhere, unless it is -1. If members bring all their ``others`` (see ``_with_others``), so are those that
    also meet in a last node of larger number.
    """
    aware = across and "others" in nodes.columns
    columns = ["node", "id", "n_shingles", "tokens", *(["label", "side"] if across else []), *(["last", "others"] if aware else [])]
    sure = (1 + s.percent / 100) / 2 - 0.1

    def compare(rows: pa.Table) -> pa.RecordBatch:
        node, ids, sizes = (rows.column(i).to_numpy() for i in range(3))
        tokens = np.frombuffer(b"".join(rows.column(3).to_pylist()), np.uint8).reshape(len(ids), s.tokens)
        label, side = (rows.column(i).to_numpy() for i in (4, 5)) if across else (None, None)
        if aware:
            last, others = rows.column(6).to_numpy(), _by_tree(rows.column(7).combine_chunks(), s)
        left, right, alike = [], [], []
        for k in range(1, len(ids)):
            i = np.flatnonzero(node[:-k] == node[k:])
            if not len(i):
                break
            j = i + k
            keep = 100 * np.minimum(sizes[i], sizes[j]) >= s.percent * np.maximum(sizes[i], sizes[j])
            if across:
                keep &= (label[i] != label[j]) & ((side[i] != side[j]) | (side[i] == -1))
            i, j = i[keep], j[keep]
            same = (tokens[i] == tokens[j]).mean(axis=1)
            keep = same >= s.floor
            i, j, same = i[keep], j[keep], same[keep]
            if aware:
                here = ~((others[i] == others[j]) & (others[i] > last[i, None])).any(axis=1)
                i, j, same = i[here], j[here], same[here]
            left.append(i), right.append(j), alike.append(same)
        i, j, same = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right, alike))
        if across:
            _, which, many = np.unique(node[i], return_inverse=True, return_counts=True)
            first = np.unique(np.concatenate([i, j]), return_index=True)[1] % max(1, len(i))
            first = np.unique(first)  # a pair for each end
            i, j, many = i[first], j[first], many[which[first]]
            i, j = np.where(ids[i] < ids[j], i, j), np.where(ids[i] < ids[j], j, i)
            found = (ids[i], ids[j], label[i], label[j], node[i], many)
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], ["a", "b", "label_a", "label_b", "node", "n"])
        if len(i):
            i, j, same = np.concatenate([i, j]), np.concatenate([j, i]), np.concatenate([same, same])
            order = np.lexsort((ids[j], np.where(same >= sure, 0, 1 - same), i))
            i, j = i[order], j[order]
            first = np.r_[True, i[1:] != i[:-1]]
            i, j = i[first], j[first]
        a, b = np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])
        pairs = np.unique(np.stack([a, b]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0], pa.int64()), pa.array(pairs[1], pa.int64())], ["a", "b"])

    members = nodes.join(classes.select("id", _part(), "n_shingles", "tokens"), ["id", "part"])
    sorted_nodes = members.select(*columns).repartition("node").sortWithinPartitions("node", "n_shingles", "id")
    if across:
        return sorted_nodes.mapInArrow(_by_node(compare), "a long, b long, label_a long, label_b long, node long, n long")
    return sorted_nodes.mapInArrow(_by_node(compare), "a long, b long").distinct()


def _with_others(second: DataFrame) -> DataFrame:
    """Adds to each member of the second look all its last nodes there as ``others``. Two members meet in those that both have.

    Alike sets meet in many trees, but need be compared in one: that of the largest number.
    """
    others = second.groupBy("id", "part").agg(F.collect_set("last").alias("others"))
    return second.join(others, ["id", "part"])


def _by_tree(others: pa.ListArray, s: Settings) -> np.ndarray:
    """A row for each list, with the node of each tree in the tree's column; the smallest number stands for none."""
    known = others.flatten().to_numpy()
    rows = np.repeat(np.arange(len(others)), others.value_lengths().to_numpy())
    matrix = np.full((len(others), min(s.trees, _TREE_MASK + 1)), np.iinfo(np.int64).min)
    matrix[rows, known & _TREE_MASK] = known
    return matrix


def _meeting(pairs: DataFrame) -> DataFrame:
    """``(node, id, label)``: the ends of all pairs. A pair that is the only one of its node stays in one of the nodes where it is
    found, that with the most pairs."""
    labels = [F.first(c).alias(c) for c in ("label_a", "label_b")]
    more = F.collect_set(F.when(F.col("n") > 1, F.col("node")))
    met = pairs.groupBy("a", "b").agg(F.array_union(more, F.array(F.max(F.struct("n", "node"))["node"])).alias("nodes"), *labels)
    ends = [F.struct(F.col(c).alias("id"), F.col(f"label_{c}").alias("label")) for c in ("a", "b")]
    return met.select(F.explode("nodes").alias("node"), F.array(*ends).alias("ends")).select("node", F.inline("ends")).distinct()


def _by_node(function):
    """Calls a function with the rows of whole nodes; rows come sorted by their first column, the node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # the last node so far may go on in the next batch
        for batch in batches:
            rows = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch]).combine_chunks()
            node = rows.column(0).to_numpy()
            cut = int(np.flatnonzero(node != node[-1])[-1]) + 1 if len(node) and node[0] != node[-1] else 0
            rest = rows.slice(cut)
            if cut:
                yield function(rows.slice(0, cut))
        if rest is not None and rest.num_rows:
            yield function(rest)

    return run


def _sets(docs: DataFrame, id: str, text: str, wanted: DataFrame, s: Settings) -> DataFrame:
    """``(id, set)``, the sorted shingles of the rows whose id is wanted, as bytes.

    Few wanted ids are sent to the texts; above ``few_ids`` the texts are shuffled by id instead.
    """
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    wanted = materialize(wanted, "wanted")
    wanted = F.broadcast(wanted) if wanted.count() <= s.few_ids else wanted

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for block in blocks(batch.column(1)):
                    sets = [x.tobytes() for x in _shingles(block, s.shingle_words)]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(block.first, len(block)), pa.array(sets, pa.binary())], ["id", "set"]
                    )

    return materialize(rows.join(wanted, "id", "left_semi").mapInArrow(shingled, "id long, set binary"), "sets")


def confirmed(docs: DataFrame, id: str, text: str, pairs: DataFrame, s: Settings) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets are similar enough. Of rows that repeat an id, any may make the link."""
    ends = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                both = np.concatenate([x, y])
                both.sort()
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(len(both) > 0 and 100 * shared >= s.percent * (len(both) - shared))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    sets = _sets(docs, id, text, ends, s)
    with_a = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("set_a")), "a")
    with_b = with_a.join(sets.select(F.col("id").alias("b"), F.col("set").alias("set_b")), "b")
    return with_b.select("a", "b", "set_a", "set_b").mapInArrow(similar, "a long, b long").distinct()


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two sets share, as products of a membership matrix; shingles of one set alone are left out."""
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    new = np.r_[True, every[1:] != every[:-1]]
    which = np.cumsum(new) - 1
    common = np.bincount(which) > 1
    keep = common[which]
    column, owner = (np.cumsum(common) - 1)[which[keep]], owner[keep]
    shared = np.zeros((len(sets), len(sets)), np.float64)
    for low in range(0, int(common.sum()), _HASH_COLUMNS):
        some = (column >= low) & (column < low + _HASH_COLUMNS)
        member = np.zeros((len(sets), _HASH_COLUMNS), np.float32)
        member[owner[some], column[some] - low] = 1
        shared += member @ member.T
    return shared


def _forest(x: np.ndarray, y: np.ndarray) -> list[int]:
    """Which of the links between labels join what those before have not joined."""
    above: dict[int, int] = {}
    joining = []
    for k, ends in enumerate(zip(x.tolist(), y.tolist())):
        a, b = ends
        while a in above:
            a = above[a]
        while b in above:
            b = above[b]
        if a != b:
            above[max(a, b)] = min(a, b)
            joining.append(k)
    return joining


def _confirmed_in_nodes(docs: DataFrame, id: str, text: str, nodes: DataFrame, classes: DataFrame, s: Settings) -> DataFrame:
    """Links ``(a, b)`` between members of a node that have different labels, of those whose estimate allows one.

    Every such pair is looked at in one node. All sets that a node was given are compared at once where they are, so it gives a forest
    of its links, which holds the same labels together, and not its pairs.
    """
    ends = materialize(_meeting(_close(_with_others(nodes), classes, s, True)), "ends")

    def link(rows: pa.Table) -> pa.RecordBatch:
        node, ids, label = (rows.column(i).to_numpy() for i in range(3))
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows.column(3)]
        size = np.array([len(x) for x in sets])
        a, b = [], []
        edges = np.flatnonzero(np.r_[True, node[1:] != node[:-1], True])
        for low, high in zip(edges[:-1], edges[1:]):
            if (label[low:high] == label[low]).all():
                continue
            shared = _shared(sets[low:high])
            n = size[low:high]
            alike = 100 * shared >= s.percent * (n[:, None] + n[None, :] - shared)
            i, j = np.nonzero(np.triu(alike & (label[low:high, None] != label[None, low:high]), 1))
            joining = _forest(label[low:high][i], label[low:high][j])
            i, j = i[joining], j[joining]
            a.append(ids[low:high][i]), b.append(ids[low:high][j])
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
        arrays = [pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, ["a", "b"])

    rows = ends.join(_sets(docs, id, text, ends.select("id").distinct(), s), "id")
    rows = rows.select("node", "id", "label", "set").repartition("node").sortWithinPartitions("node", "id")
    return rows.mapInArrow(_by_node(link), "a long, b long").distinct()


def _labelled(frame: DataFrame, found: DataFrame) -> DataFrame:
    known = found.select(F.col("node").alias("id"), F.col("component").alias("label"))
    return frame.join(known, "id", "left").withColumn("label", F.coalesce("label", "id"))


def _second_look(nodes: DataFrame, found: DataFrame, s: Settings) -> DataFrame:
    """``(node, id, part, label, last, side)``: members of nodes that are in different components so far.

    ``last`` is the last node, of which ``node`` may be two blocks; members of different blocks have a ``side`` then, 0 or 1, else -1.
    """
    known = materialize(_labelled(nodes, found), "labelled")
    mixed = known.groupBy("node").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x != y").select("node")
    small = known.where("whole is null").join(mixed, "node", "left_semi").withColumns({"last": F.col("node"), "side": F.lit(-1)})
    cut = known.where("whole is not null")
    votes = cut.groupBy("whole", "label").agg(F.count("*").alias("n")).groupBy("whole").agg(
        F.max_by("label", F.struct("n", -F.col("label"))).alias("main"), F.count("*").alias("labels"),
        (F.sum("n") - F.max("n")).alias("n_strays"), F.max("n").alias("n_main"),
    ).where("labels > 1")
    cut = cut.join(votes, "whole")
    # Members outside the main component meet each other and those inside, block against block; those inside have one label.
    stray_blocks, main_blocks = (F.ceil(F.col(n) / s.node_size).cast("long") for n in ("n_strays", "n_main"))
    stray = F.col("label") != F.col("main")
    block = F.pmod(F.xxhash64("whole", "id"), F.when(stray, stray_blocks).otherwise(main_blocks))
    cut = cut.withColumns({"block": block, "stray": stray, "stray_blocks": stray_blocks, "main_blocks": main_blocks})
    other = F.sequence(F.lit(0).cast("long"), F.col("stray_blocks") - 1)
    with_stray = cut.withColumn("other", F.explode(other)).withColumn("node", F.when(
        F.col("stray"), F.xxhash64("whole", F.lit(0), F.least("block", "other"), F.greatest("block", "other"))
    ).otherwise(F.xxhash64("whole", F.lit(1), "other", "block")))
    of_strays = F.when(F.col("block") == F.col("other"), -1).otherwise((F.col("block") > F.col("other")).cast("int"))
    with_stray = with_stray.withColumn("side", F.when(F.col("stray"), of_strays).otherwise(1))
    with_main = cut.where("stray").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("main_blocks") - 1)))
    with_main = with_main.withColumns({"node": F.xxhash64("whole", F.lit(1), "block", "other"), "side": F.lit(0)})
    columns = ["node", "id", "part", "label", "last", "side"]
    blocks_met = with_stray.unionByName(with_main).withColumn("last", F.col("whole"))
    return small.select(columns).unionByName(blocks_met.select(columns))


def _repeated(signed: DataFrame, first: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between an id that has rows of several classes and the first ids of those classes."""
    several = signed.where("id is not null").groupBy("id").agg(F.min("set_key").alias("x"), F.max("set_key").alias("y"))
    rows = signed.join(several.where("x != y").select("id"), "id", "left_semi").join(first, "set_key")
    return rows.where("id != class_id").select(F.col("id").alias("a"), F.col("class_id").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", settings: Settings | None = None) -> DataFrame:
    """``(id, n_shingles, component_id, kept)`` of every row of ``docs``.

    ``component_id`` is the smallest id that can be reached over links, the row's own included; ``kept`` marks the rows that have it.
    Null or empty text, and text without words, has no shingles and is linked with nothing. Rows that repeat an id are one
    document, linked with whatever one of them is linked with. Rows with a null id take no part: they have no component and are
    kept. Other columns are not read. An empty table gives no rows.
    """
    s = settings or Settings()
    signed = materialize(signatures(docs, id, text, s), "signatures")
    classes = signed.where("id is not null and set_key is not null").groupBy("set_key").agg(
        F.min("id").alias("id"), *[F.first(c).alias(c) for c in ("n_shingles", "tokens", "roots")]
    )
    classes = materialize(classes, "classes")
    nodes = materialize(_nodes(classes, s), "last-nodes")
    links = confirmed(docs, id, text, materialize(_close(nodes, classes, s, False), "pairs"), s)
    first = classes.select("set_key", F.col("id").alias("class_id"))
    links = materialize(links.unionByName(_repeated(signed, first)), "confirmed")
    found = materialize(components(links), "components")
    second = materialize(_second_look(nodes, found, s), "second-look")
    more = materialize(_confirmed_in_nodes(docs, id, text, second, classes, s), "confirmed")
    if not more.isEmpty():
        found = components(links.unionByName(more))
    rows = signed.select("id", "n_shingles", "set_key").join(first, "set_key", "left")
    rows = rows.join(found.withColumnRenamed("node", "class_id"), "class_id", "left")
    component = F.coalesce("component", "class_id", "id")
    return rows.select(
        F.col("id").alias(id), "n_shingles", F.when(F.col("id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
