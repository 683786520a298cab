"""Language of a text by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from the letter itself. Three letters in a row are bound into one vector: each
letter's vector is rotated by its place, and the three are multiplied. A text's profile is the sum of its n-gram vectors; a
language's prototype is the sum over its training texts. A text has the language whose prototype has the largest cosine with its profile.

Since profiles are sums, a block of texts is one product of a count matrix with the vectors of the n-grams that occur in it.
Prototypes are sums of whole numbers, so that they don't depend on how rows are dealt out.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabspine.llm.blocks import Block, blocks, mix
from tabspine.llm.workers import tidy

#: Bytes of a block of texts; entries of a count matrix, and n-grams whose vectors are made, that are held at once.
_BLOCK = 1 << 20
_CELLS = 1 << 20
_GRAMS = 1024


@dataclass(frozen=True)
class Settings:
    """``dimensions`` of the vectors, ``size`` of an n-gram in characters, ``languages``: prototypes that a text is compared with at once."""

    dimensions: int = 1024
    size: int = 3
    languages: int = 1000
    seed: int = 5


def _letter_vectors(letters: np.ndarray, s: Settings) -> np.ndarray:
    """+1 and -1 for each code point, the same in every process."""
    with np.errstate(over="ignore"):
        words = np.arange(s.dimensions // 64, dtype=np.uint64) + np.uint64(s.seed << 32)
        bits = mix(mix(letters.astype(np.uint64))[:, None] + mix(words)[None, :])
    bits = np.unpackbits(bits.astype("<u8").view(np.uint8), axis=1)
    return bits.astype(np.float32) * 2 - 1


def _codes(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters of all rows as code points, every run of other characters one space; rows of these."""
    points, rows = [], []
    for i in range(len(block)):
        text = block.text(i).decode().lower()
        p = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), np.uint32)
        points.append(p), rows.append(np.full(len(p), i, np.int32))
    points, rows = np.concatenate(points), np.concatenate(rows)
    present = np.flatnonzero(np.bincount(points)) if len(points) else points
    letter = np.zeros(int(points.max()) + 1, bool)
    letter[[c for c in present if unicodedata.category(chr(c)).startswith("L")]] = True
    points = np.where(letter[points], points, 32)
    keep = np.r_[True, (points[1:] != 32) | (points[:-1] != 32) | (rows[1:] != rows[:-1])]
    return points[keep], rows[keep]


def _profiles(block: Block, s: Settings) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Some rows at a time: their numbers, their profiles, and whether they have a letter."""
    points, rows = _codes(block)
    letters = np.flatnonzero(np.bincount(points))
    numbers = np.zeros(int(letters.max(initial=0)) + 1, np.int32)
    numbers[letters] = np.arange(len(letters))
    coded = numbers[points]
    n, size = len(points) - s.size + 1, s.size
    if n <= 0:
        yield np.arange(len(block)), np.zeros((len(block), s.dimensions), np.float32), np.zeros(len(block), bool)
        return
    gram = np.zeros(n, np.int32 if len(letters) ** size < 1 << 31 else np.int64)
    for k in range(size):
        gram *= gram.dtype.type(len(letters))
        gram += coded[k : n + k]
    row = rows[:n]
    # A run of spaces is one, so any n-gram within a row has a letter.
    inside = row == rows[size - 1 :]
    if len(letters) ** size <= _CELLS:
        grams = np.flatnonzero(np.bincount(gram[inside], minlength=1))
        index = np.zeros(len(letters) ** size, np.int32)
        index[grams] = np.arange(len(grams))
        which = index[gram]
    else:
        grams, which = np.unique(gram[inside], return_inverse=True)
        spread = np.zeros(n, np.int32)
        spread[inside] = which
        which = spread
    single = _letter_vectors(letters, s)
    bounds = np.searchsorted(row, np.arange(len(block) + 1))
    step = max(1, _CELLS // max(1, len(grams)))
    has_letter = np.bincount(rows[points != 32], minlength=len(block)) > 0
    for low in range(0, len(block), step):
        high = min(low + step, len(block))
        own = slice(bounds[low], bounds[high])
        cells = ((row[own] - low).astype(np.int64) * len(grams) + which[own])[inside[own]]
        sums = np.zeros((high - low, s.dimensions), np.float32)
        counts = np.bincount(cells, minlength=(high - low) * len(grams)).reshape(high - low, -1).astype(np.float32)
        for first in range(0, len(grams), _GRAMS):  # vectors of some n-grams at a time
            rest, vectors = grams[first : first + _GRAMS], None
            for k in range(size - 1, -1, -1):
                rotated = np.roll(single, k, axis=1)[rest % len(letters)]
                vectors = rotated if vectors is None else vectors * rotated
                rest = rest // len(letters)
            sums += counts[:, first : first + _GRAMS] @ vectors
        yield np.arange(low, high), sums, has_letter[low:high]


def train(docs: DataFrame, lang: str = "lang", text: str = "text", settings: Settings | None = None) -> dict[str, np.ndarray]:
    """Prototype of each language of the rows that have one. Texts without letters add nothing.

    Each task sums its texts per language; the sums of the tasks are added in Spark by language and dimension. The
    driver gets one vector per language, of 8 kB.
    """
    s = settings or Settings()

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for block in blocks(batch.column(1), _BLOCK):
                for rows, profiles, _ in _profiles(block, s):
                    own = np.array([langs[block.first + i] for i in rows], object)
                    for name in dict.fromkeys(own):
                        total = profiles[own == name].sum(axis=0, dtype=np.float64)
                        sums[name] = sums.get(name, 0) + np.rint(total).astype(np.int64)
        if sums:
            names = pa.array(sums, pa.string())
            yield pa.RecordBatch.from_arrays([names, pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))], ["lang", "sums"])

    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")).where("lang is not null")
    sums = rows.mapInArrow(tidy(bundle), "lang string, sums array<long>").select("lang", F.posexplode("sums").alias("d", "x"))
    whole = sums.groupBy("lang", "d").agg(F.sum("x").alias("x"))
    whole = whole.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("d", "x"))), lambda p: p["x"]).alias("sums"))
    found = whole.orderBy("lang").collect()
    return {r["lang"]: np.array(r["sums"], np.float64) for r in found if any(r["sums"])}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], text: str = "text", settings: Settings | None = None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the cosine with the best prototype, at least 0.

    However many languages there are, a text is compared with some of them at a time and the best is kept. Very long texts are read whole. Null texts, texts without letters, and all texts when there is no prototype, are ``und`` with score 0. Equal cosines go to the
    smaller name. Columns of the same names are replaced; all others pass through. An empty table gives no rows.
    """
    s = settings or Settings()
    names = sorted(prototypes)
    units = np.array([prototypes[n] / np.linalg.norm(prototypes[n]) for n in names], np.float32).reshape(len(names), s.dimensions)
    sent = docs.sparkSession.sparkContext.broadcast(units)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    place = kept.index(text)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            guess, score = [], []
            for block in blocks(batch.column(place), _BLOCK):
                for rows, profiles, has_letter in _profiles(block, s):
                    if not names:
                        guess += ["und"] * len(rows)
                        score += [0.0] * len(rows)
                        continue
                    size = np.sqrt((profiles**2).sum(axis=1))
                    best, top = np.zeros(len(rows), np.int64), np.full(len(rows), -np.inf, np.float32)
                    for first in range(0, len(names), s.languages):
                        cosine = profiles @ sent.value[first : first + s.languages].T / np.where(size > 0, size, 1)[:, None]
                        own, high = cosine.argmax(axis=1), cosine.max(axis=1)
                        best, top = np.where(high > top, own + first, best), np.maximum(top, high)
                    usable = has_letter & (size > 0)
                    guess += [names[b] if u else "und" for b, u in zip(best, usable)]
                    score += np.where(usable, np.clip(top, 0, 1), 0).astype(float).tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(guess, pa.string()), pa.array(score, pa.float64())], [*kept, "lang_pred", "score"]
            )

    shape = docs.select(kept).schema.add("lang_pred", "string").add("score", "double")
    return docs.select(kept).mapInArrow(tidy(label), shape)
