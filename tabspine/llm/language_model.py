"""An interpolated modified Kneser-Ney bigram model, counted in Spark and memory-mapped by the workers that score.

Counting goes through packed arrays: a task sorts the n-grams of its texts, sums repeats, and sends each shard one block of bytes. A
shard is a range of word hashes, or, for a word that would fill shards by itself, of pair hashes, so that no shard grows with
the most frequent word. Shards merge their blocks into sorted arrays of hashes with counts, written as files. A worker maps the
files into memory and looks words and pairs up by binary search; only the pages it touches are read.

Files have names of their own; the rows that tasks return, committed by Spark, say which ones make up the model.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabspine.llm.blocks import SPACE, Block, blocks, mix, words
from tabspine.llm.workers import held, tidy
from tabspine.sources.scratch import materialize, scratch_path

_START, _END = np.uint64(0x5D1F0A2C9B3E4D71), np.uint64(0xA7C3E59D1B2F6048)
_SHORT = np.uint64(16)  # pairs keep 48 bits of each word


@dataclass(frozen=True)
class Settings:
    """``shard_bytes``: training text per shard. ``block_bytes``: text of which n-grams are summed before they are sent."""

    shard_bytes: int = 48 << 20
    block_bytes: int = 24 << 20


@dataclass(frozen=True)
class Model:
    """Where the arrays are, and the numbers that hold for all of them."""

    shards: int
    vocabulary: list[tuple[int, str, int]]  # shard, file, words
    pairs: list[tuple[int, str, int]]  # shard, file, pairs
    heavy: np.ndarray  # short hashes of the words whose pairs are spread over all shards
    tokens: int
    types: int
    pair_types: int
    discounts: tuple[float, float, float]
    unigram_discounts: tuple[float, float, float]
    unigram_rest: float
    columns: tuple[str, ...] = field(default=("count", "total", "ones", "twos", "more", "before"))


def _tokens(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all rows, each row closed by the end, and where rows begin (one more than rows)."""
    found, rows = words(block, SPACE), len(block)
    bounds = found.bounds(rows)
    at = np.arange(len(found.hashes)) + found.row
    tokens = np.full(len(found.hashes) + rows, _END, np.uint64)
    tokens[at] = found.hashes
    return tokens, bounds + np.arange(rows + 1)


def _before(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The word before each token; the start before a row's first."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[bounds[:-1]] = _START
    return before


def _pair_keys(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    """64 bits of a pair of short hashes that sort by the first 24 bits of ``u``."""
    both = mix(mix(u + np.uint64(1)) ^ (w * np.uint64(0x9FB21C651E98DF25)))
    return ((u >> np.uint64(24)) << np.uint64(40)) | (both >> np.uint64(24))


def _pair_shards(u: np.ndarray, keys: np.ndarray, heavy: np.ndarray, shards: int) -> np.ndarray:
    own = (u.astype(np.float64) * (shards / 2.0**48)).astype(np.int64)
    if len(heavy):
        place = np.minimum(np.searchsorted(heavy, u), len(heavy) - 1)
        spread = heavy[place] == u
        own[spread] = (keys[spread] & np.uint64(0xFFFFFFFF)).astype(np.int64) % shards
    return own


def _summed(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, one position of each, and the sum of their weights (1 each if not given)."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    edges = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    if weights is None:
        return keys[edges], order[edges], np.diff(np.r_[edges, len(keys)])
    sums = np.add.reduceat(weights[order], edges, axis=0) if len(edges) else weights[:0]
    return keys[edges], order[edges], sums


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes; bytes of one place stand together, which sorted and small numbers make compressible."""
    parts = [np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(len(a), 8).T).tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def _unpack(data: bytes, columns: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    n = len(raw) // (8 * columns)
    return [np.ascontiguousarray(part.reshape(8, n).T).view("<u8").reshape(n) for part in raw.reshape(columns, 8 * n)]


def _sent(shard: np.ndarray, shards: int, arrays: list[np.ndarray]) -> pa.RecordBatch:
    """A packed block for each shard that has rows."""
    order = np.argsort(shard, kind="stable")
    edges = np.searchsorted(shard[order], np.arange(shards + 1))
    full = [k for k in range(shards) if edges[k] < edges[k + 1]]
    data = [_pack(*(a[order[edges[k] : edges[k + 1]]] for a in arrays)) for k in full]
    return pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), pa.array(data, pa.binary())], ["shard", "data"])


def _counted(texts: DataFrame, count: Callable[[Block], tuple[np.ndarray, list[np.ndarray]]], s: Settings, shards: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for block in blocks(batch.column(0), s.block_bytes):
                    shard, arrays = count(block)
                    yield _sent(shard, shards, arrays)

    return texts.mapInArrow(run, "shard long, data binary")


def _save(folder: str, name: str, arrays: list[np.ndarray]) -> str:
    store, path = pyarrow.fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    file = f"{name}-{uuid.uuid4().hex}.bin"
    with store.open_output_stream(f"{path}/{file}", compression=None) as out:
        for a in arrays:
            out.write(np.ascontiguousarray(a).tobytes())
    return f"{folder}/{file}"


def _merged(packed: DataFrame, shards: int, merge: Callable[[int, list[bytes]], Iterator[dict]], schema: pa.Schema, ddl: str) -> DataFrame:
    """Blocks meet by shard; each shard's are merged by themselves, in order of the shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held = None, []
        with np.errstate(over="ignore"):
            for batch in batches:
                for shard, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                    if held and shard != own:
                        yield pa.RecordBatch.from_pylist(list(merge(own, held)), schema)
                        held = []
                    own = shard
                    held.append(data.as_py())
            if held:
                yield pa.RecordBatch.from_pylist(list(merge(own, held)), schema)

    return packed.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(run, ddl)


_PART = pa.schema([("shard", pa.int64()), ("data", pa.binary()), ("file", pa.string()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])
_PART_DDL = "shard long, data binary, file string, n long, sums array<long>"


def _classes(counts: np.ndarray) -> list[int]:
    """How many counts are 1, 2, 3, 4, and 3 or more."""
    return [*(int((counts == k).sum()) for k in (1, 2, 3, 4)), int((counts >= 3).sum())]


def _discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Chen and Goodman's estimates, held between 0 and the count; 1/2 of the count where classes are empty."""
    if not (n1 and n2):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(min(max(x, 0.0), float(k)) for k, x in enumerate(d, 1))


def train(docs: DataFrame, text: str = "text", settings: Settings | None = None) -> Model:
    """Count the texts of ``docs``; null texts are empty, an empty text is its end alone. Nothing is pruned or sampled.

    The driver gets one row per shard and file, and a bounded number of heavy words per shard.
    """
    s = settings or Settings()
    spark = docs.sparkSession
    texts = docs.select(F.col(text).cast("string").alias("text"))
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = max(1, -(-int(size) // s.shard_bytes))
    folder = scratch_path(spark, "language-model")

    def unigrams(block: Block):
        tokens, _ = _tokens(block)
        own, _, n = _summed(tokens)
        return (own >> np.uint64(40)).astype(np.int64) * shards >> 24, [own, n.astype(np.uint64)]

    def merge_unigrams(shard: int, held: list[bytes]) -> Iterator[dict]:
        own, n = (np.concatenate(x) for x in zip(*(_unpack(d, 2) for d in held)))
        own, _, n = _summed(own, n)
        heavy = own[n * 4 > n.sum()] >> _SHORT
        yield {"shard": shard, "data": _pack(own, n), "n": len(own), "sums": [int(n.sum()), *heavy.astype(np.int64).tolist()]}

    counts = materialize(_merged(_counted(texts, unigrams, s, shards), shards, merge_unigrams, _PART, _PART_DDL), "unigrams")
    rows = counts.select("n", "sums").collect()
    tokens = sum(r["sums"][0] for r in rows)
    heavy = np.array(sorted({x for r in rows for x in r["sums"][1:]} | {int(_START >> _SHORT)}), np.uint64)

    def bigrams(block: Block):
        found, bounds = _tokens(block)
        w, u = found >> _SHORT, _before(found, bounds) >> _SHORT
        keys, at, n = _summed(_pair_keys(u, w))
        return _pair_shards(u[at], keys, heavy, shards), [u[at], w[at], n.astype(np.uint64)]

    def merge_bigrams(shard: int, held: list[bytes]) -> Iterator[dict]:
        u, w, n = (np.concatenate(x) for x in zip(*(_unpack(d, 3) for d in held)))
        keys, at, n = _summed(_pair_keys(u, w), n)
        u, w = u[at], w[at]
        file = _save(folder, f"pairs-{shard}", [keys, n.astype(np.uint32) if int(n.max(initial=0)) < 1 << 32 else n.astype(np.uint64)])
        yield {"shard": shard, "file": file, "n": len(keys), "sums": _classes(n)}
        one, two, more = ((n == 1), (n == 2), (n >= 3))
        context, _, sums = _summed(u, np.stack([n, one, two, more], axis=1).astype(np.uint64))
        after, _, kinds = _summed(w)
        for word, columns in ((context, list(sums.T)), (after, [*[np.zeros(len(after), np.uint64)] * 4, kinds.astype(np.uint64)])):
            columns += [np.zeros(len(word), np.uint64)] * (5 - len(columns))
            sent = _sent((word >> np.uint64(24)).astype(np.int64) * shards >> 24, shards, [word, *columns])
            for to, data in zip(*(c.to_pylist() for c in sent.columns)):
                yield {"shard": -1 - to, "data": data}

    merged = materialize(_merged(_counted(texts, bigrams, s, shards), shards, merge_bigrams, _PART, _PART_DDL), "bigrams")
    pairs = merged.where("shard >= 0").select("shard", "file", "n", "sums").collect()

    def merge_words(shard: int, held: list[bytes]) -> Iterator[dict]:
        own, n, short, columns = None, None, [], []
        for data in held:
            if data[:1] == b"c":
                own, n = _unpack(data[1:], 2)
            else:
                first, *rest = _unpack(data[1:], 6)
                short.append(first), columns.append(np.stack(rest, axis=1))
        known, _, sums = _summed(np.concatenate(short), np.concatenate(columns)) if short else (np.zeros(0, np.uint64), None, np.zeros((0, 5), np.uint64))
        own, n = (own, n) if own is not None else (np.zeros(0, np.uint64), np.zeros(0, np.uint64))
        stats = np.zeros((len(own), 5), np.uint64)
        if len(known):
            place = np.minimum(np.searchsorted(known, own >> _SHORT), len(known) - 1)
            hit = known[place] == own >> _SHORT
            stats[hit] = sums[place[hit]]
        # Contexts that are no words: the start.
        extra = known[~np.isin(known, own >> _SHORT)] if len(known) else known
        own = np.r_[own, extra << _SHORT]
        n = np.r_[n, np.zeros(len(extra), np.uint64)]
        stats = np.r_[stats, sums[np.isin(known, extra)]] if len(extra) else stats
        order = np.argsort(own, kind="stable")
        table = np.c_[n, stats][order].astype(np.float64)
        file = _save(folder, f"words-{shard}", [own[order], *table.T])
        yield {"shard": shard, "file": file, "n": len(own), "sums": [*_classes(stats[:, 4]), int((n > 0).sum())]}

    mark = lambda letter, data: F.concat(F.lit(letter).cast("binary"), data)
    blocks_of_words = counts.select("shard", mark("c", F.col("data")).alias("data")).unionByName(
        merged.where("shard < 0").select((-1 - F.col("shard")).alias("shard"), mark("s", F.col("data")).alias("data"))
    )
    vocabulary = materialize(_merged(blocks_of_words, shards, merge_words, _PART, _PART_DDL), "words")
    found = vocabulary.select("shard", "file", "n", "sums").collect()
    n1, n2, n3, n4, _ = (sum(r["sums"][k] for r in pairs) for k in range(5))
    m1, m2, m3, m4, more = (sum(r["sums"][k] for r in found) for k in range(5))
    types, pair_types = sum(r["sums"][5] for r in found), sum(r["n"] for r in pairs)
    unigram = _discounts(m1, m2, m3, m4)
    rest = (unigram[0] * m1 + unigram[1] * m2 + unigram[2] * more) / pair_types if pair_types else 1.0
    files = lambda rows: [(r["shard"], r["file"], r["n"]) for r in rows]
    return Model(shards, files(found), files(pairs), heavy, tokens, types, pair_types, _discounts(n1, n2, n3, n4), unigram, rest)


def _map(file: str, n: int, kinds: list[str | None]) -> list[np.ndarray]:
    """Arrays of a file, mapped; a kind of None is whole numbers of the width that is left.

    A store that can't be mapped is copied to a local file that goes when the process does.
    """
    store, path = pyarrow.fs.FileSystem.from_uri(file)
    local = path
    if not isinstance(store, pyarrow.fs.LocalFileSystem):
        handle, local = tempfile.mkstemp()
        with os.fdopen(handle, "wb") as out, store.open_input_stream(path, compression=None) as source:
            while piece := source.read(1 << 24):
                out.write(piece)
    arrays, at = [], 0
    width = os.path.getsize(local) // n - sum(np.dtype(kind).itemsize for kind in kinds if kind)
    for kind in kinds:
        kind = kind or f"<u{width}"
        arrays.append(np.memmap(local, kind, "r", at, (n,)))
        at += n * np.dtype(kind).itemsize
    if local != path:
        os.unlink(local)
    return arrays


#: Files of each kind that a worker maps at the same time.
_MAPPED = 4096


class _Tables:
    """The arrays of a model, each mapped when it is first looked into; of many, those used last stay mapped."""

    def __init__(self, model: Model):
        self.model = model
        self.words = self._mapped(model.vocabulary, ["<u8", *["<f8"] * 6])
        self.pairs = self._mapped(model.pairs, ["<u8", None])

    @staticmethod
    def _mapped(files, kinds: list[str | None]) -> Callable[[int], list[np.ndarray] | None]:
        of = {shard: (file, n) for shard, file, n in files if n}
        return lru_cache(_MAPPED)(lambda shard: _map(*of[shard], kinds) if shard in of else None)

    def _find(self, table: Callable[[int], list[np.ndarray] | None], shard: np.ndarray, keys: np.ndarray, shift: int, out: list[np.ndarray]) -> None:
        order = np.lexsort((keys, shard))
        edges = np.flatnonzero(np.r_[True, np.diff(shard[order]) != 0, True]) if len(order) else np.zeros(0, np.int64)
        for low, high in zip(edges[:-1], edges[1:]):
            mine = order[low:high]
            columns = table(int(shard[mine[0]]))
            if columns is None:
                continue
            place = np.searchsorted(columns[0], keys[mine] << np.uint64(shift))
            place[place == len(columns[0])] = 0
            hit = columns[0][place] >> np.uint64(shift) == keys[mine]
            for o, c in zip(out, columns[1:]):
                o[mine[hit]] = c[place[hit]]

    def word_columns(self, hashes: np.ndarray, short: bool) -> list[np.ndarray]:
        """Columns of words given by whole hashes, or by short ones."""
        out = [np.zeros(len(hashes)) for _ in self.model.columns]
        top = hashes >> np.uint64(24 if short else 40)
        self._find(self.words, top.astype(np.int64) * self.model.shards >> 24, hashes, 16 if short else 0, out)
        return out

    def pair_counts(self, u: np.ndarray, w: np.ndarray) -> np.ndarray:
        keys = _pair_keys(u, w)
        count = np.zeros(len(u))
        self._find(self.pairs, _pair_shards(u, keys, self.model.heavy, self.model.shards), keys, 0, [count])
        return count

    def scores(self, tokens: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each row: known tokens, base score, the model's score."""
        m = self.model
        own, first, which = np.unique(tokens, return_index=True, return_inverse=True)
        count, _, _, _, _, before = (c[which] for c in self.word_columns(own, False))
        d = np.array([0.0, *m.unigram_discounts])
        alone = (before - d[np.minimum(before, 3).astype(int)]) / max(m.pair_types, 1) + m.unigram_rest / (m.types + 1)
        u, w = _before(tokens, bounds) >> _SHORT, tokens >> _SHORT
        contexts, which = np.unique(u, return_inverse=True)
        _, total, ones, twos, more, _ = (c[which] for c in self.word_columns(contexts, True))
        d = np.array([0.0, *m.discounts])
        seen = self.pair_counts(u, w)
        safe = np.where(total > 0, total, 1)
        p = (seen - d[np.minimum(seen, 3).astype(int)]) / safe + (d[1] * ones + d[2] * twos + d[3] * more) / safe * alone
        p = np.where(total > 0, p, alone)
        base = np.log10((count + 1) / (m.tokens + m.types + 1))
        sums = [np.add.reduceat(x, bounds[:-1]) for x in (count > 0, base, np.log10(p))] if len(bounds) > 1 else [np.zeros(0)] * 3
        return sums[0], sums[1], sums[2]


def score(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, n_tokens, n_known, base_score, score, perplexity)`` of every row; log10 probabilities of the whole text and its end.

    ``base_score`` sums log10((c + 1) / (N + V + 1)), the add-one unigram model; a model without training text gives every
    token probability 1. Null and empty texts are their end alone. An empty table gives no rows.
    """
    key = ("model", uuid.uuid4().hex)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = held(key, lambda: _Tables(sent.value))
        with np.errstate(over="ignore"):
            for batch in batches:
                for block in blocks(batch.column(1)):
                    tokens, bounds = _tokens(block)
                    known, base, total = tables.scores(tokens, bounds)
                    n = np.diff(bounds)
                    arrays = [
                        batch.column(0).slice(block.first, len(block)), pa.array(n, pa.int64()), pa.array(known.astype(np.int64)),
                        pa.array(base, pa.float64()), pa.array(total, pa.float64()), pa.array(10 ** (-total / n), pa.float64()),
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, ["id", "n_tokens", "n_known", "base_score", "score", "perplexity"])

    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    schema = "id long, n_tokens long, n_known long, base_score double, score double, perplexity double"
    return rows.mapInArrow(tidy(run, holds=True), schema).withColumnRenamed("id", id)
