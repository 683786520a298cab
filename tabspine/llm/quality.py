"""Text quality by a sparse ensemble of rules.

Each text becomes a row of statistics. Shallow trees over labelled rows propose rules: every path from a root is a conjunction of
comparisons. A logistic model with an L1 penalty gives most rules no weight; what is left compiles to one Spark column
expression over the statistics, so scoring is a projection.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabspine.llm.blocks import SPACE, Block, blocks, distinct, words
from tabspine.llm.workers import tidy
from tabspine.sources.scratch import materialize


@dataclass(frozen=True)
class Settings:
    """``trees`` and ``depth`` of the trees that propose rules; ``penalty`` of the L1 term. ``sample_rows``: about so many labelled rows, by
    hash of their id, are fitted at most. ``threshold``: score from which a text is good."""

    trees: int = 24
    depth: int = 3
    penalty: float = 0.001
    sample_rows: int = 40_000
    threshold: float = 0.7
    seed: int = 3


#: Byte classes: white space, line end, lower, upper, digit, sentence mark, other mark, beyond ASCII.
_CLASSES = 8
_CLASS = np.full(256, 6)
_CLASS[[9, 11, 12, 13, 32]] = 0
_CLASS[10] = 1
_CLASS[97:123] = 2
_CLASS[65:91] = 3
_CLASS[48:58] = 4
_CLASS[[ord(c) for c in ".,;:?'-"]] = 5
_CLASS[128:] = 7

STATISTICS = (
    "log_bytes", "log_words", "word_bytes", "longest_word", "lower", "upper", "digit", "sentence_mark", "other_mark", "beyond_ascii",
    "lines", "words_per_line", "distinct_words", "distinct_pairs", "distinct_lines", "commonest_word", "marked_words", "short_words",
)


def _share(x: np.ndarray) -> tuple[float, float]:
    """Distinct values and occurrences of the commonest, as shares."""
    if not len(x):
        return 0.0, 0.0
    x = np.sort(x)
    edges = np.flatnonzero(np.r_[True, x[1:] != x[:-1], True])
    return (len(edges) - 1) / len(x), int(np.diff(edges).max()) / len(x)


def _measure(block: Block) -> np.ndarray:
    rows, n = len(block), np.diff(block.offsets)
    out = np.zeros((rows, len(STATISTICS)))
    kinds = _CLASS[block.data] + np.repeat(np.arange(rows) * _CLASSES, n)
    counts = np.bincount(kinds, minlength=rows * _CLASSES).reshape(rows, _CLASSES)
    found = words(block, SPACE)
    bounds = found.bounds(rows)
    size = found.ends - found.starts
    final = _CLASS[block.data[found.ends - 1]] if len(size) else size
    line_breaks = np.zeros(256, bool)
    line_breaks[10] = True
    lines = words(block, line_breaks)
    line_bounds = lines.bounds(rows)
    with np.errstate(over="ignore"):
        pairs = found.hashes[:-1] * np.uint64(0x9FB21C651E98DF25) + found.hashes[1:]
    for i in range(rows):
        a, b = bounds[i : i + 2]
        if b == a:
            continue
        c, d = line_bounds[i : i + 2]
        ink = n[i] - counts[i, 0] - counts[i, 1]
        one, most = _share(found.hashes[a:b])
        out[i] = (
            np.log1p(n[i]), np.log1p(b - a), ink / (b - a), size[a:b].max(), *(counts[i, k] / ink for k in range(2, 8)),
            d - c, (b - a) / max(1, d - c), one, _share(pairs[a : b - 1])[0] if b - a > 1 else 1.0,
            len(distinct(lines.hashes[c:d])) / max(1, d - c), most, np.mean(final[a:b] == 6), np.mean(size[a:b] <= 2),
        )
    return out


def statistics(docs: DataFrame, id: str = "doc_id", text: str = "text", whole_rows: bool = False) -> DataFrame:
    """``id`` and the statistics of each row's whole text; all are 0 where it is null, empty or blank.

    With ``whole_rows`` all columns pass through before the statistics; columns named like one are replaced.
    """
    kept = [c for c in docs.columns if c not in STATISTICS] if whole_rows else [id]
    place = kept.index(text) if whole_rows else 1

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(place)):
                found = _measure(block)
                own = [batch.column(c).slice(block.first, len(block)) for c in range(len(kept))]
                yield pa.RecordBatch.from_arrays([*own, *(pa.array(x, pa.float64()) for x in found.T)], [*kept, *STATISTICS])

    schema = docs.select(kept).schema
    for name in STATISTICS:
        schema = schema.add(name, "double")
    return docs.select(*kept, *([] if whole_rows else [F.col(text).alias("_text")])).mapInArrow(tidy(measure), schema)


Condition = tuple[str, bool, float]  # statistic, whether it is at most the bound or above, bound


@dataclass(frozen=True)
class Ensemble:
    """Rules with their weights, the intercept, and the threshold."""

    rules: tuple[tuple[tuple[Condition, ...], float], ...]
    intercept: float
    threshold: float

    def score(self) -> Column:
        """Probability of label 1 as an expression over the statistics."""
        terms = [F.when(holds(rule), F.lit(weight)).otherwise(F.lit(0.0)) for rule, weight in self.rules]
        return 1 / (1 + F.exp(-reduce(lambda a, b: a + b, terms, F.lit(self.intercept))))


def holds(rule: tuple[Condition, ...]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c) <= x if at_most else F.col(c) > x for c, at_most, x in rule])


def _paths(node, path: tuple[Condition, ...] = ()) -> Iterator[tuple[Condition, ...]]:
    """Conjunctions along the paths of a fitted tree."""
    if path:
        yield path
    if node.getClass().getSimpleName() == "InternalNode":
        split = node.split()
        name, bound = STATISTICS[split.featureIndex()], float(split.threshold())
        yield from _paths(node.leftChild(), (*path, (name, True, bound)))
        yield from _paths(node.rightChild(), (*path, (name, False, bound)))


def _plain(rule: tuple[Condition, ...]) -> tuple[Condition, ...]:
    """A conjunction without comparisons that another one implies."""
    bounds: dict[tuple[str, bool], float] = {}
    for name, at_most, x in rule:
        known = bounds.get((name, at_most), x)
        bounds[name, at_most] = min(known, x) if at_most else max(known, x)
    return tuple(sorted((name, at_most, x) for (name, at_most), x in bounds.items()))


def fit(rows: DataFrame, label: str = "quality", id: str = "doc_id", settings: Settings | None = None) -> Ensemble:
    """An ensemble from statistics with a 0 or 1 ``label``; other labels, and null ones, are left out.

    Without labels every score is 1, since nothing speaks against a text; with one label only, it is that label's share, smoothed.
    """
    s = settings or Settings()
    usable = rows.where(F.col(label).isin(0, 1))
    n, good = usable.agg(F.count("*"), F.coalesce(F.sum(label), F.lit(0))).first()
    if not n or good in (0, n):
        share = (good + 1) / (n + 2) if n else 1 - 1e-9
        return Ensemble((), float(np.log(share / (1 - share))), s.threshold)
    part = min(1.0, s.sample_rows / n)
    drawn = F.pmod(F.xxhash64(id, F.lit(s.seed)), F.lit(1 << 30)) < F.lit(int(part * (1 << 30)))
    sample = materialize(usable.where(drawn).select(F.col(label).cast("double").alias("label"), *STATISTICS), "labelled")
    sample = sample.coalesce(max(1, min(n, s.sample_rows) // 10_000))
    assembled = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(sample)
    forest = RandomForestClassifier(
        numTrees=s.trees, maxDepth=s.depth, seed=s.seed, minInstancesPerNode=max(1, min(n, s.sample_rows) // 1000)
    ).fit(assembled)
    found = {_plain(path) for tree in forest.trees for path in _paths(tree._call_java("rootNode"))}
    rules = sorted(found)
    if not rules:
        return Ensemble((), float(np.log(good / (n - good))), s.threshold)
    flags = sample.select("label", *[holds(rule).cast("double").alias(f"r{i}") for i, rule in enumerate(rules)])
    vectors = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features").transform(flags)
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=s.penalty, standardization=False, maxIter=60)
    model = lasso.fit(vectors.select("label", "features"))
    kept = [(rule, float(w)) for rule, w in zip(rules, model.coefficients) if w]
    return Ensemble(tuple(kept), float(model.intercept), s.threshold)


def scored(rows: DataFrame, ensemble: Ensemble) -> DataFrame:
    """Statistics with ``score`` and ``predicted``, which is 1 from the threshold on. An empty table gives no rows."""
    return rows.withColumn("score", ensemble.score()).withColumn("predicted", (F.col("score") >= ensemble.threshold).cast("int"))
