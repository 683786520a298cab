"""Secrets in text: assignments and keys by their form, and other strings that a battery of randomness tests takes for random.

A candidate is a run of at least ``least`` letters, digits, ``+ / _ -``. The smallest encoding that has all its characters gives
each a number, and three tests ask whether these numbers look drawn at random: chi-squared uniformity over the alphabet, runs
above and below its middle, serial correlation of neighbours. Fisher's method combines them, and what it rejects is no secret.

Passing is little evidence for a short string. So each candidate also gets the probability that a string of its
length, as uneven as structured text in its encoding, would come out so even. These probabilities, divided by weights that grow
with the power the test has at that length, go through a weighted Benjamini-Hochberg step over all candidates of the
table, which keeps the expected share of structured strings among the reported ones below ``rate``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabspine.sources.scratch import materialize

#: The forms that are secrets by themselves, in the order in which equal starts are listed.
KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile("[0-9a-f]{16,}")
_LEAST = {"assign": 12, "access": 18}
#: In lower case, every assignment holds one of these.
_NEEDED = ("passw", "secret", "token", "api")

_DIGITS, _LOW, _UP = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings from the smallest alphabet up: name, alphabet in order, and how much more often than at random two characters of
#: structured text in it are equal (as a share of the random rate).
ENCODINGS = (
    ("decimal", _DIGITS, 1.0),
    ("hex", _DIGITS + _LOW[:6], 1.5),
    ("hex", _DIGITS + _UP[:6], 1.5),
    ("lower", _LOW, 0.7),
    ("upper", _UP, 0.7),
    ("base32", _UP + _DIGITS[2:8], 1.2),
    ("base36", _DIGITS + _LOW, 1.2),
    ("base36", _DIGITS + _UP, 1.2),
    ("letters", _UP + _LOW, 1.5),
    ("base62", _UP + _LOW + _DIGITS, 2.0),
    ("base64", _UP + _LOW + _DIGITS + "+/", 2.0),
    ("base64url", _UP + _LOW + _DIGITS + "-_", 2.0),
    ("mixed", _UP + _LOW + _DIGITS + "+/-_", 2.0),
)
_PLACES = [(name, {c: i for i, c in enumerate(alphabet)}, excess) for name, alphabet, excess in ENCODINGS]

#: Weighted probabilities are counted by their logarithm, in steps of a fiftieth of a power of ten down to 1e-60.
_STEPS, _LOWEST = 50, -3000


@dataclass(frozen=True)
class Settings:
    """``level``: combined probability below which the battery calls a string not random. ``rate``: share of false reports aimed at."""

    least: int = 16
    level: float = 0.001
    rate: float = 0.05


def _upper(z: float) -> float:
    """Probability that a standard normal value is above ``z``."""
    return 0.5 * math.erfc(z / math.sqrt(2))


def _both(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def infer(text: str) -> tuple[str, list[int], int, float]:
    """The smallest encoding that has every character: name, their numbers, size of the alphabet, excess of structured text."""
    seen = set(text)
    for name, places, excess in _PLACES:
        if seen <= places.keys():
            return name, [places[c] for c in text], len(places), excess
    raise ValueError("characters of no encoding")


def battery(values: list[int], k: int) -> tuple[float, float, float, float]:
    """Probabilities under randomness of uniformity, runs and serial correlation, each two-sided, and the chi-squared statistic."""
    n = len(values)
    squared = k / n * sum(c * c for c in Counter(values).values()) - n
    mean, variance = k - 1, 2 * (k - 1) * (n - 1) / n
    freedom = 2 * mean * mean / variance  # a scaled chi-squared law with the exact mean and variance
    root = (max(squared, 0) / mean) ** (1 / 3)
    uniform = _both((root - (1 - 2 / (9 * freedom))) / math.sqrt(2 / (9 * freedom)))
    x = np.array(values, float)
    above = x >= k / 2
    high = int(above.sum())
    low = n - high
    if high and low:
        runs = 1 + int((above[1:] != above[:-1]).sum())
        product = 2 * high * low
        spread = product * (product - n) / (n * n * (n - 1))
        turns = _both((runs - 1 - product / n) / math.sqrt(spread)) if spread > 0 else 1.0
    else:
        turns = 2.0 ** (1 - n) if n < 1000 else 0.0
    centred = x - x.mean()
    total = float(centred @ centred)
    if total:
        correlation = float(centred[:-1] @ centred[1:]) / total
        serial = _both((correlation + 1 / n) * math.sqrt(n))
    else:
        serial = 0.0
    return uniform, turns, serial, squared


def fisher(ps: tuple[float, ...]) -> float:
    """Combined probability of independent tests: the upper tail of a chi-squared law with two degrees for each."""
    half = -sum(math.log(max(p, 1e-300)) for p in ps)
    term = total = 1.0
    for i in range(1, len(ps)):
        term *= half / i
        total += term
    return math.exp(-half) * total


def evidence(n: int, k: int, excess: float, squared: float) -> tuple[float, float]:
    """Probability that structured text is so even, and the weight that a string of this length has."""
    extra = (n - 1) * excess
    spread = math.sqrt(2 * (k - 1) + 4 * extra)
    p = _upper((k - 1 + extra - squared) / spread)
    return p, _upper(2 - extra / spread)


def _step(p: float) -> int:
    return max(_LOWEST, math.ceil(_STEPS * math.log10(p))) if p > 0 else _LOWEST


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the forms in code points."""
    found = []
    low = text.lower()
    if any(x in low for x in _NEEDED):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= _LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= _LEAST["access"]]
    return found + [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]


def _scan(s: Settings):
    candidate = re.compile(f"[A-Za-z0-9+/_-]{{{s.least},}}")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms, tested = [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                forms.append([{"start": a, "kind": k, "end": b} for a, k, b in base_spans(text)])
                own = []
                for m in candidate.finditer(text):
                    name, values, k, excess = infer(m[0])
                    *ps, squared = battery(values, k)
                    p, weight = evidence(len(values), k, excess, squared)
                    own.append({
                        "start": m.start(), "end": m.end(), "encoding": name, "random": fisher(tuple(ps)), "weight": weight,
                        "step": _step(p / weight),
                    })
                tested.append(own)
            arrays = [batch.column(0), pa.array(forms, _FORMS), pa.array(tested, _TESTED)]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "forms", "tested"])

    return scan


_FORMS = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
_TESTED = pa.list_(pa.struct([
    ("start", pa.int64()), ("end", pa.int64()), ("encoding", pa.string()), ("random", pa.float64()), ("weight", pa.float64()), ("step", pa.int32()),
]))
_SCANNED = (
    "id long, forms array<struct<start: long, kind: int, end: long>>, "
    "tested array<struct<start: long, end: long, encoding: string, random: double, weight: double, step: int>>"
)


def discoveries(counts: list[tuple[int, int]], weight: float, rate: float) -> float:
    """The largest step to report. ``counts``: candidates by step; ``weight``: the mean weight, by which steps are off.

    Steps are rounded up, so that no candidate counts as better than it is.
    """
    total, seen, last = sum(n for _, n in counts), 0, -math.inf
    for step, n in sorted(counts):
        seen += n
        if 10 ** (step / _STEPS) * weight <= rate * seen / total:
            last = step
    return last


def secret_spans(docs: DataFrame, id: str = "doc_id", text: str = "text", settings: Settings | None = None) -> DataFrame:
    """``(id, n_assign, n_access, n_hex, n_random, base, spans)`` of every row of ``docs``.

    ``base`` and ``spans`` are arrays of ``(start, kind, end)`` in code points, in order, the latter with the strings found
    random; a string may have several kinds. Null and empty texts have none; rows that repeat an id are read each, null ids too; very
    long texts and strings are read whole; equal probabilities are reported together. Of an empty table nothing is returned. Other columns
    are not read. What crosses the network is one number for each step of probability.
    """
    s = settings or Settings()
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    rows = materialize(rows.mapInArrow(_scan(s), _SCANNED), "scanned")
    steps = rows.select(F.inline("tested")).groupBy("step").agg(F.count("*").alias("n"), F.sum("weight").alias("weight")).collect()
    total = sum(r["n"] for r in steps)
    mean = sum(r["weight"] for r in steps) / total if total else 1.0
    last = max(discoveries([(r["step"], r["n"]) for r in steps], mean, s.rate), _LOWEST - 1)
    kinds = F.array(*map(F.lit, KINDS))
    random = F.filter("tested", lambda c: (c["step"] <= F.lit(last)) & (c["random"] >= s.level))
    found = F.transform(random, lambda c: F.struct(c["start"].alias("start"), F.lit(3).alias("kind"), c["end"].alias("end")))

    def named(spans):
        return F.transform(F.array_sort(spans), lambda x: F.struct(x["start"].alias("start"), F.get(kinds, x["kind"]).alias("kind"), x["end"].alias("end")))

    def count(kind: int):
        return F.size(F.filter("forms", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    return rows.select(
        F.col("id").alias(id), *map(count, range(3)), F.size(found).cast("long").alias("n_random"),
        named(F.col("forms")).alias("base"), named(F.concat("forms", found)).alias("spans"),
    )


def listed(spans):
    """Spans as ``kind:start:end``, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])))
