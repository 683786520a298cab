"""Properties on random rows, checked against brute force."""

from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F

from tabspine.operators import ordering
from tabspine.operators.fingerprint import table_fingerprint
from tabspine.operators.importance import permutation_importance, permuted_rows
from tabspine.operators.metrics import classification_metrics
from tabspine.operators.ordering import (
    approximate_medians,
    chronological_split,
    exact_medians,
    first_by_hash,
    global_row_number,
    order_statistics,
    range_buckets,
)
from tabspine.operators.profile import cardinality, modes
from tabspine.operators.scoring import score_in_chunks
from tabspine.operators.spine import as_of_lookup
from tabspine.operators.status import latest_rows
from tabspine.operators.upsert import apply_changes, change_feed, upsert_rows


def auc(pairs):
    """Pairwise definition: wins plus half the ties."""
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.fixture(scope="module")
def scored(spark):
    draw = random.Random(5)
    # A third of all rows share one score.
    rows = [(i, draw.choice("ab"), draw.randint(0, 1), 0.25 if i % 3 == 0 else round(draw.random() ** 3, 2)) for i in range(900)]
    return rows, spark.createDataFrame(rows, "i int, g string, y int, s double")


@pytest.mark.parametrize("rows_per_bucket", [1_000_000, 20])
def test_metrics_equal_brute_force(scored, rows_per_bucket):
    rows, df = scored
    found = classification_metrics(df, "y", "s", rows_per_bucket=rows_per_bucket).first()
    pairs = [(y, s) for _, _, y, s in rows]
    called = [(y, int(s >= 0.5)) for y, s in pairs]
    tp, wrong = sum(y and c for y, c in called), sum(y != c for y, c in called)
    assert found["roc_auc"] == pytest.approx(auc(pairs))
    assert found["f1"] == pytest.approx(2 * tp / (2 * tp + wrong))
    assert found["accuracy"] == pytest.approx(1 - wrong / len(rows))
    by_group = {r["g"]: r["roc_auc"] for r in classification_metrics(df, "y", "s", ["g"], rows_per_bucket=rows_per_bucket).collect()}
    for g in "ab":
        assert by_group[g] == pytest.approx(auc([(y, s) for _, h, y, s in rows if h == g]))


def test_auc_is_unchanged_by_a_monotone_transform(scored):
    _, df = scored
    moved = df.withColumn("s", F.exp(F.col("s") * 3) - 7)
    values = [classification_metrics(d, "y", "s", rows_per_bucket=50).first()["roc_auc"] for d in (df, moved)]
    assert values[0] == pytest.approx(values[1])


def test_global_row_number_is_a_permutation_in_order(spark):
    df = spark.range(5_000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 11).alias("hot"))
    ranked = global_row_number(df, ["hot", "id"], "n").collect()
    expected = sorted((r["hot"], r["id"]) for r in ranked)
    assert [(r["hot"], r["id"]) for r in sorted(ranked, key=lambda r: r["n"])] == expected
    assert sorted(r["n"] for r in ranked) == list(range(1, 5_001))


@pytest.fixture()
def small_limit(monkeypatch):
    """Let the bracketing run on small data."""
    monkeypatch.setattr(ordering, "_COLLECT_LIMIT", 3)
    monkeypatch.setattr(ordering, "_ACCURACY", 40)


def spread(n=2_000):
    draw = random.Random(9)
    hot = [5.0] * (n // 3)
    return hot + [round(draw.gauss(5, 3), 4) for _ in range(n - len(hot))]


def test_order_statistics(spark, small_limit):
    values = spread()
    df = spark.createDataFrame([(v, int(v * 10)) for v in values] + [(None, None)], "x double, k long")
    ranks = [0, 1, 17, 599, 600, 666, 1000, 1332, 1400, 1998, 1999]
    found = order_statistics(df, {"x": ranks, "k": ranks})
    xs, ks = sorted(values), sorted(int(v * 10) for v in values)
    assert {r: found["x", r] for r in ranks} == {r: xs[r] for r in ranks}
    assert {r: found["k", r] for r in ranks} == {r: ks[r] for r in ranks}
    with pytest.raises(IndexError):
        order_statistics(df, {"x": [2_000]})


@pytest.mark.parametrize("n", [1, 2, 7, 2_000, 2_001])
def test_exact_medians(spark, small_limit, n):
    values = spread(n)
    df = spark.createDataFrame([(v, None, 1) for v in values], "x double, empty double, one int")
    assert exact_medians(df, ["x", "empty", "one"]) == {"x": pytest.approx(statistics.median(values)), "empty": None, "one": 1.0}


def test_approximate_medians(spark):
    row = approximate_medians(spark.range(1, 10_002), ["id"]).first()
    assert abs(row["id"] - 5_001) <= 2


@pytest.mark.parametrize("fraction", [0.0, 0.1, 0.8, 1.0])
def test_chronological_split(spark, small_limit, fraction):
    draw = random.Random(3)
    rows = [(i, None if i % 10 == 0 else 1_000 if i % 3 == 0 else draw.randint(0, 2_000)) for i in range(1_000)]
    df = spark.createDataFrame(rows, "k int, t int").withColumn("ts", F.timestamp_seconds("t")).repartition(4)
    for time_col in ("ts", "ntz"):
        timed = df.withColumn("ntz", F.col("ts").cast("timestamp_ntz"))
        split = {r["k"]: r["split"] for r in chronological_split(timed, time_col, "k", fraction).collect()}
        order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
        cut = int(len(rows) * fraction)
        assert {k for k, s in split.items() if s == "train"} == {k for k, _ in order[:cut]}
        assert len(split) == len(rows)


def test_chronological_split_with_text_keys(spark):
    rows = [(f"k{i * 7919 % 100:02d}", 5 if i % 2 else None) for i in range(100)]
    df = spark.createDataFrame(rows, "k string, t int")
    for fraction in (0.3, 0.75):
        split = {r["k"]: r["split"] for r in chronological_split(df, "t", "k", fraction).collect()}
        order = sorted(rows, key=lambda r: (r[1] is not None, r[0]))
        assert {k for k, s in split.items() if s == "train"} == {k for k, _ in order[: int(100 * fraction)]}


@pytest.mark.parametrize("kind", ["double", "timestamp", "timestamp_ntz", "long"])
def test_range_buckets_keep_order(spark, kind):
    seconds = F.pow(F.col("id") % 971, F.lit(2)).cast("long")
    value = seconds.cast(kind) if kind in ("double", "long") else F.timestamp_seconds(seconds).cast(kind)
    df = spark.range(4_000).select(value.alias("v"))
    rows = sorted((r["v"], r["b"]) for r in df.withColumn("b", range_buckets(df, "v", 30)).collect())
    buckets = [b for _, b in rows]
    assert buckets == sorted(buckets) and len(set(buckets)) > 60
    assert max(buckets.count(b) for b in set(buckets)) < 400


def test_range_buckets_are_even_whatever_the_values(spark):
    n, wish = 200_000, 50
    u = (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) + 1) / 1_000_004
    shapes = {"tail": F.pow(u, -3.0), "narrow": 1e9 + u / 10, "tied": F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.exp(20 * u))}
    for name, value in shapes.items():
        df = spark.range(n).select(value.alias("v"))
        counts = df.groupBy(range_buckets(df, "v", wish).alias("b")).agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        rows = counts.orderBy("b").collect()
        assert all(a["high"] < b["low"] for a, b in zip(rows, rows[1:]))
        tied = n // 3 + 1 if name == "tied" else 0
        assert max(r["n"] - (tied if r["low"] <= 7.0 <= r["high"] else 0) for r in rows) <= 4 * wish, name


def test_as_of_with_a_hot_key_equals_brute_force(spark):
    draw = random.Random(1)
    key = lambda i: 0 if i % 3 == 0 else draw.randint(1, 20)
    known = {(key(i), draw.randint(0, 500)): i for i in range(600)}
    asked = [(i, key(i), draw.randint(0, 500)) for i in range(900)]
    features = spark.createDataFrame([(k, t, v) for (k, t), v in known.items()], "k int, at int, v int")
    spine = spark.createDataFrame(asked, "i int, k int, t int")
    found = {r["i"]: r["v"] for r in as_of_lookup(spine, features, "k", "t", "at", ["v"], rows_per_bucket=25).collect()}
    for i, k, t in asked:
        times = [at for (kk, at) in known if kk == k and at <= t]
        assert found[i] == (known[k, max(times)] if times else None)
    odd = spark.createDataFrame([(1, None, 5), (2, 0, None), (2, 0, None)], "i int, k int, t int")
    rows = as_of_lookup(odd, features.unionByName(odd.select("k", F.col("t").alias("at"), F.lit(9).alias("v"))), "k", "t", "at", ["v"])
    assert sorted(map(tuple, rows.collect()), key=str) == [(1, None, 5, None), (2, 0, None, None), (2, 0, None, None)]


def snapshots(spark):
    before = spark.range(0, 300).select("id", F.when(F.col("id") % 7 != 0, F.col("id") % 5).alias("v"), F.lit("x").alias("w"))
    after = spark.range(20, 330).select("id", F.when(F.col("id") % 9 != 0, F.col("id") % 5).alias("v"), F.lit("x").alias("w"))
    return before, after


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_change_feed_applied_gives_the_new_snapshot(spark):
    before, after = snapshots(spark)
    feed = change_feed(before, after, "id")
    assert rows_of(apply_changes(before, feed, "id")) == rows_of(after)
    kinds = dict(feed.groupBy("_change_type").count().collect())
    assert kinds["insert"] == 30 and kinds["delete"] == 20 and kinds["update_preimage"] == kinds["update_postimage"] > 0
    assert change_feed(before, before, "id").count() == 0


def test_upsert_is_idempotent_and_keeps_newer_rows(spark):
    target = spark.createDataFrame([(1, 10, "a"), (2, 10, "b")], "k int, seq int, v string")
    source = spark.createDataFrame([(2, 11, "B"), (3, 5, "c"), (1, 9, "old")], "k int, seq int, v string")
    plain = upsert_rows(target, source, "k")
    assert rows_of(plain) == rows_of(upsert_rows(plain, source, "k")) == [(1, 9, "old"), (2, 11, "B"), (3, 5, "c")]
    newer = upsert_rows(target, source, "k", ["seq"])
    assert rows_of(newer) == rows_of(upsert_rows(newer, source, "k", ["seq"])) == [(1, 10, "a"), (2, 11, "B"), (3, 5, "c")]


def test_latest_rows(spark):
    df = spark.range(1_000).select((F.col("id") % 3).alias("g"), F.col("id").alias("n"), (-F.col("id")).alias("v"))
    assert rows_of(latest_rows(df, ["g"], ["n"])) == [(0, 999, -999), (1, 997, -997), (2, 998, -998)]


def test_fingerprint_ignores_order_and_sees_changes(spark):
    df = spark.range(1_000).select("id", (F.col("id") % 7).cast("string").alias("v"))
    for portable in (False, True):
        prints = [
            tuple(table_fingerprint(d, portable=portable).first())
            for d in (df, df.repartition(5, "v"), df.withColumn("v", F.when(F.col("id") == 3, "z").otherwise(F.col("v"))), df.union(df.limit(2)))
        ]
        assert prints[0] == prints[1] and len(set(prints)) == 3


def test_samples_are_repeatable(spark):
    df = spark.range(500)
    first = rows_of(first_by_hash(df, "id", 50, salt=1))
    assert first == rows_of(first_by_hash(df.repartition(7), "id", 50, salt=1)) and len(first) == 50
    assert first != rows_of(first_by_hash(df, "id", 50, salt=2))


def test_permuted_rows_are_a_permutation(spark):
    df = spark.range(1_000).select("id", (F.col("id") * 2).alias("a"))
    for block_rows in (10_000, 100):
        rows = permuted_rows(df, "id", ["a"], 3, 7, block_rows).collect()
        donors = {}
        for r in rows:
            donors.setdefault(r["_repeat"], []).append(r["_donor"]["a"])
        assert all(sorted(d) == [2 * i for i in range(1_000)] for d in donors.values()) and len(donors) == 3
        assert sum(r["_donor"]["a"] == r["a"] for r in rows) < 20
        assert donors[0] != donors[1]


def test_importance_finds_the_feature_that_matters(spark):
    df = spark.range(2_000).select("id", (F.col("id") % 2).alias("y"), (F.col("id") % 2).alias("signal"), (F.col("id") % 13).alias("noise"))
    scorer = lambda d: d.withColumn("score", F.col("signal").cast("double"))
    found = {}
    for r in permutation_importance(df, "id", "y", ["signal", "noise"], scorer).collect():
        found.setdefault(r["feature"], []).append(r["importance"])
    assert found["noise"] == [0.0] * 3 and all(0.4 < v < 0.6 for v in found["signal"])


def test_chunks(spark):
    df = spark.range(0, 1_000, numPartitions=3).withColumn("x", F.col("id") * 2)

    def scorer(chunk):
        assert len(chunk) <= 100
        return chunk["x"] / 4

    scored = score_in_chunks(df, "id", ["x"], scorer, chunk_rows=100)
    assert dict(scored.dtypes) == {"id": "bigint", "score": "double"}
    assert rows_of(scored) == sorted([(i, i / 2) for i in range(1_000)], key=repr)
    with pytest.raises(Exception, match="scorer returned"):
        score_in_chunks(df, "id", ["x"], lambda chunk: [0.0]).count()


def test_modes_and_cardinality(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("b", None), ("a", "q"), (None, "q"), (None, None), (None, None)], "c string, d string")
    assert dict(modes(df, ["c", "d"]).collect()) == {"c": "a", "d": "q"}
    assert dict(cardinality(df, ["c", "d"]).collect()) == {"c": 3, "d": 2}
    assert dict(cardinality(df, ["c", "d"], approximate=True).collect()) == {"c": 3, "d": 2}
