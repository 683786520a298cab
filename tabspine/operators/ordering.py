"""Global order without a global sort task: row numbers, exact order statistics, range buckets, splits by time."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabspine.functions.keys import sample_order
from tabspine.sources.scratch import materialize

_ROW_BITS = 33  # monotonically_increasing_id keeps the partition above these bits
_ACCURACY = 10_000
_COLLECT_LIMIT = 20_000
_CUTS = 64


def global_row_number(df: DataFrame, order: Sequence[str], out: str = "row_number") -> DataFrame:
    """Adds 1..N over the whole frame in the given order; the last order column must be unique.

    One range shuffle. Rows are numbered inside their range and written once; the offset of a range is the sum of
    the counts before it, one small row per range, so broadcasting the offsets is bounded by the partition count.
    """
    local = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_local", local)
    stored = materialize(ranged, "ranked").withColumn("_range", F.shiftright("_local", _ROW_BITS))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stored.groupBy("_range")
        .agg(F.count("*").alias("_rows"))
        .select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    position = F.col("_local").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1
    return (
        stored.join(F.broadcast(offsets), "_range")
        .withColumn(out, F.col("_before") + position)
        .drop("_range", "_local", "_before")
    )


def _literal(df: DataFrame, col: str, value: Any) -> Column:
    """A collected value as a literal of its column's own type."""
    kind = df.schema[col].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.lit(value.isoformat(sep=" ")).cast(kind)
    return F.lit(value).cast(kind)


@dataclass
class _Span:
    """Ranks of one column still being looked for: they lie in the open interval (low, high) of ``rows`` values."""

    col: str
    ranks: list[int]
    low: Any = None
    high: Any = None
    below: int = 0
    rows: int = 0

    def inside(self, base: DataFrame) -> Column:
        cond = F.col(self.col).isNotNull()
        if self.low is not None:
            cond = cond & (F.col(self.col) > _literal(base, self.col, self.low))
        if self.high is not None:
            cond = cond & (F.col(self.col) < _literal(base, self.col, self.high))
        return cond

    def bracket(self) -> list[float]:
        """Quantiles that enclose the ranks whatever the sketch's error."""
        first, last = (min(self.ranks) - self.below) / self.rows, (max(self.ranks) - self.below + 1) / self.rows
        return [max(0.0, first - 2 / _ACCURACY), min(1.0, last + 2 / _ACCURACY)]


def order_statistics(df: DataFrame, ranks: Mapping[str, Sequence[int]]) -> dict[tuple[str, int], Any]:
    """Exact values at zero-based ranks among the non-null values of numeric or time columns.

    Each round brackets the ranks between two sketched quantiles, counts what lies below, on and between them, and narrows
    to an open interval of about one row in a thousand. No row is shuffled and only counts reach the driver. A value that
    fills the table is a bracket end, decided by its count. An interval with few rows left is sorted in one small aggregate.
    """
    base = df.select(*[c for c, rs in ranks.items() if rs])
    if not base.columns:
        return {}
    counts = base.agg(*[F.count(c).alias(c) for c in base.columns]).first()
    spans = []
    for c in base.columns:
        wrong = [r for r in ranks[c] if not 0 <= r < counts[c]]
        if wrong:
            raise IndexError(f"rank {wrong[0]} of {counts[c]} values in {c}")
        spans += [_Span(c, group, rows=counts[c]) for group in _neighbours(ranks[c], counts[c])]
    return _search(base, spans)


def _neighbours(ranks: Sequence[int], rows: int) -> list[list[int]]:
    """Ranks in groups close enough to share a bracket."""
    groups: list[list[int]] = []
    for r in sorted(set(ranks)):
        if groups and r - groups[-1][0] <= max(1, rows // _ACCURACY):
            groups[-1].append(r)
        else:
            groups.append([r])
    return groups


def _search(base: DataFrame, spans: list[_Span], brackets: Sequence | None = None) -> dict[tuple[str, int], Any]:
    """Narrow the spans round by round; ``brackets`` are the first round's, if already sketched."""
    found: dict[tuple[str, int], Any] = {}
    while spans:
        small = [s for s in spans if s.rows <= _COLLECT_LIMIT]
        spans = [s for s in spans if s.rows > _COLLECT_LIMIT]
        if small:
            wanted = [(s, r) for s in small for r in s.ranks]
            sorted_values = [F.sort_array(F.collect_list(F.when(s.inside(base), F.col(s.col)))) for s, _ in wanted]
            row = base.agg(*[F.get(v, F.lit(r - s.below)) for v, (s, r) in zip(sorted_values, wanted)]).first()
            found |= {(s.col, r): value for (s, r), value in zip(wanted, row)}
            brackets = None
        if not spans:
            break
        if brackets is None:
            sketches = [F.percentile_approx(F.when(s.inside(base), F.col(s.col)), s.bracket(), _ACCURACY) for s in spans]
            brackets = base.agg(*sketches).first()
        tallies = []
        for s, (first, last) in zip(spans, brackets):
            value, start, end = F.col(s.col), _literal(base, s.col, first), _literal(base, s.col, last)
            places = [value < start, value == start, (value > start) & (value < end), (value == end) & (value > start)]
            tallies += [F.count_if(s.inside(base) & place) for place in places]
        seen = base.agg(*tallies).first()
        narrowed = []
        for i, (s, (first, last)) in enumerate(zip(spans, brackets)):
            edges = [s.below]
            for count in seen[4 * i : 4 * i + 4]:
                edges.append(edges[-1] + count)
            pieces = [(s.low, first), None, (first, last), None, (last, s.high)]
            ends = edges[1:] + [s.below + s.rows]
            for place, (piece, start, end) in enumerate(zip(pieces, edges, ends)):
                here = [r for r in s.ranks if start <= r < end]
                if here and piece is None:
                    found |= {(s.col, r): first if place == 1 else last for r in here}
                elif here:
                    narrowed.append(_Span(s.col, here, *piece, below=start, rows=end - start))
        spans, brackets = narrowed, None
    return found


def exact_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact median of each column, the mean of the two middle values for an even count; null without values.

    Counts and the first brackets come from the same pass.
    """
    base = df.select(*columns)
    middle = [0.5 - 2 / _ACCURACY, 0.5 + 2 / _ACCURACY]
    first = base.agg(
        *[F.count(c) for c in columns], *[F.percentile_approx(c, middle, _ACCURACY) for c in columns]
    ).first()
    counts = dict(zip(columns, first))
    sketched = dict(zip(columns, first[len(columns) :]))
    spans = [_Span(c, sorted({(n - 1) // 2, n // 2}), rows=n) for c, n in counts.items() if n]
    large = [sketched[s.col] for s in spans if s.rows > _COLLECT_LIMIT]
    whole = len(large) == len(spans)
    values = _search(base, spans, large if whole else None)
    middles = {s.col: [float(values[s.col, r]) for r in s.ranks] for s in spans}
    return {c: sum(middles[c]) / len(middles[c]) if c in middles else None for c in columns}


def approximate_medians(df: DataFrame, columns: Sequence[str], accuracy: int = 10_000) -> DataFrame:
    """One row of sketched medians in a single pass, for tables where a rank error of 1/accuracy will do."""
    return df.agg(*[F.percentile_approx(c, 0.5, accuracy).alias(c) for c in columns])


def _measure(df: DataFrame, col: str) -> Column:
    """A number that grows with the column's value."""
    kind = df.schema[col].dataType
    if isinstance(kind, T.TimestampNTZType):
        days = F.unix_date(F.to_date(col)).cast("double")
        return days * 86400 + F.hour(col) * 3600 + F.minute(col) * 60 + F.second(col)
    if isinstance(kind, T.TimestampType):
        return F.unix_seconds(col).cast("double")
    return F.col(col).cast("double")


def _bucket_of(measure: Column, cuts: Sequence[float]) -> Column:
    """How many of the sorted cuts are not above the measure: a tree of comparisons for few, a search in an array for many."""

    def tree(first: int, last: int) -> Column:
        if first == last:
            return F.lit(first)
        middle = (first + last) // 2
        return F.when(measure < F.lit(cuts[middle]), tree(first, middle)).otherwise(tree(middle + 1, last))

    if len(cuts) < 2 * _CUTS:
        return tree(0, len(cuts))
    array = F.split(F.lit(",".join(map(repr, cuts))), ",").cast("array<double>")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])

    def advance(place: Column, step: Column) -> Column:
        return F.when(F.get(array, place + step - 1) <= measure, place + step).otherwise(place)

    return F.aggregate(steps, F.lit(0), advance)


def range_buckets(df: DataFrame, col: str, rows_per_bucket: int = 1_000_000) -> Column:
    """Column expression giving an ordered bucket of about ``rows_per_bucket`` rows of ``df`` each.

    A pass sketches up to 63 cuts inside every part that is still too large, the whole column first, so each pass makes parts 64
    times smaller whatever the values look like. The cuts sit in the plan, so the bucket of a row depends on its value alone, in
    every stage and retry, and equal values share a bucket. Only balance, never the result, depends on the sketches. What
    reaches the driver is the cuts, about one for each bucket.
    """
    measured = df.select(_measure(df, col).alias("_measure")).filter(F.col("_measure").isNotNull())
    shares = [i / _CUTS for i in range(1, _CUTS)]
    cuts: list[float] = []
    part_rows = None  # expected in a part that is to be cut
    while part_rows is None or part_rows > rows_per_bucket:
        part = _bucket_of(F.col("_measure"), cuts)
        sketched = measured.groupBy(part.alias("part")).agg(
            F.count("*").alias("n"), F.min("_measure").alias("low"), F.max("_measure").alias("high"),
            F.percentile_approx("_measure", shares, 20 * _CUTS).alias("at"),
        )
        # A part is left alone when it is small enough, or holds one value.
        found = sketched.filter((F.col("n") > rows_per_bucket) & (F.col("high") > F.col("low"))).collect()
        if not found:
            break
        new: set[float] = set()
        for row in found:
            step = max(1, _CUTS * rows_per_bucket // row["n"])
            picked = [x for x in row["at"][step - 1 :: step] if math.isfinite(x)]
            # A value that fills a bucket ends one: what is above it is cut by itself.
            filling = {x for x, y in zip(picked, picked[1:]) if x == y}.union(x for x in picked if x == row["low"])
            new |= {x for x in picked if x > row["low"]}.union(math.nextafter(x, math.inf) for x in filling)
        if not new - set(cuts):
            break
        cuts = sorted(new.union(cuts))
        part_rows = max(row["n"] for row in found) / (_CUTS - 1)
    return _bucket_of(_measure(df, col), cuts)


def _key_at(df: DataFrame, key_col: str, rank: int) -> Any:
    """The key at a zero-based rank: by bracketing if it is a number or time, else by row numbers over the keys alone."""
    if isinstance(df.schema[key_col].dataType, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return order_statistics(df, {key_col: [rank]})[key_col, rank]
    numbered = global_row_number(df.select(key_col), [key_col], "_n")
    return numbered.filter(F.col("_n") == rank + 1).first()[key_col]


def chronological_split(
    df: DataFrame, time_col: str, key_col: str, fraction: float = 0.8, out: str = "split"
) -> DataFrame:
    """First ``int(fraction * n)`` rows by (time, key) are ``train``, the rest ``holdout``; null times come first.

    Only the boundary row is looked for; the split itself is a comparison with it, so rows are not moved.
    """
    narrow = df.select(time_col, key_col)
    total, timed = narrow.agg(F.count("*"), F.count(time_col)).first()
    cut = int(total * fraction)
    untimed = total - timed
    time, key = F.col(time_col), F.col(key_col)
    if cut == 0:
        first_part = F.lit(False)
    elif cut <= untimed:
        last_key = _key_at(narrow.filter(time.isNull()), key_col, cut - 1)
        first_part = time.isNull() & (key <= _literal(df, key_col, last_key))
    else:
        rank = cut - untimed - 1
        last_time = order_statistics(narrow, {time_col: [rank]})[time_col, rank]
        edge = _literal(df, time_col, last_time)
        tied = rank - narrow.filter(time < edge).count()
        last_key = _key_at(narrow.filter(time == edge), key_col, tied)
        first_part = time.isNull() | (time < edge) | ((time == edge) & (key <= _literal(df, key_col, last_key)))
    return df.withColumn(out, F.when(first_part, "train").otherwise("holdout"))


def first_by_hash(df: DataFrame, key_col: str, n: int, salt: int | str | None = None) -> DataFrame:
    """A repeatable sample of ``n`` rows: the first in hash order of the key. Each task keeps its own first n."""
    return df.orderBy(sample_order(F.col(key_col), salt), key_col).limit(n)


def first_by_key(df: DataFrame, key_col: str, n: int) -> DataFrame:
    """The ``n`` smallest keys, for a smoke run."""
    return df.select(key_col).orderBy(key_col).limit(n)
