"""Ranked search, secrets and resampling against brute force, and on awkward and empty tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tabspine.llm import queries, ranked_search, resampling, secret_spans

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


@pytest.fixture(scope="module")
def texts(spark):
    queries.workers_find_library(spark)
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


# Ranked search


def search_truth(docs, items, best=10):
    """``docs``: (id, text) rows; ``items``: (item, text) rows."""
    counted = [(i, Counter(words(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n, total = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    found = []
    for item, text in items:
        scored = []
        for i, c in counted:
            m = 100 - 75 + (75 * c.total() * n) // total
            score = sum(
                k * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
                for t, k in Counter(words(text)).items() if t in c
            )
            if score > 0 and i is not None:
                scored.append((-score, i))
        found += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:best])]
    return sorted(found)


def ranked_rows(frame):
    return sorted((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in frame.collect())


@pytest.mark.parametrize("settings", [
    ranked_search.Settings(),
    ranked_search.Settings(coordinates=16, helping=2, growth=2, items=30, wanted=5),
    ranked_search.Settings(coordinates=1, helping=1, growth=3, item_bytes=5_000),
])
def test_search_equals_brute_force(spark, texts, settings):
    docs, items = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    items = items.where("item_id < 60")
    rows = ranked_rows(ranked_search.ranked(docs.repartition(3), items, settings=settings))
    assert rows == search_truth(texts.items(), [tuple(r) for r in items.select("item_id", "text").collect()])


def test_search_of_copies_and_repeated_ids(spark):
    passage = " ".join(f"word{i}" for i in range(30))
    docs = [(i, passage) for i in range(40, 0, -1)] + [(50, passage + " word1 word1"), (50, passage), (None, passage), (60, "other words"), (61, None)]
    items = [(1, passage), (1, passage), (1, "word1 WORD1 other"), (2, "nothing here is known"), (None, "other"), (3, None), (4, "!!")]
    got = ranked_search.ranked(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id int, text string"),
        settings=ranked_search.Settings(helping=3, growth=2),
    )
    assert got.dtypes == [("item_id", "int"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    distinct = [(1, passage), (1, "word1 WORD1 other"), (None, "other")]
    rows = sorted((tuple(r) for r in got.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))
    truth = sorted((r for item in distinct for r in search_truth(docs, [item])), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))
    assert rows == truth


def test_bounds_are_no_less_than_scores(spark, texts):
    docs = spark.createDataFrame(list(texts.items()), "id long, text string")
    s = ranked_search.Settings(coordinates=64)
    index = ranked_search.sketches(docs, s).toPandas()
    assert len(index) == sum(bool(words(t)) for t in texts.values())
    total = ranked_search.Collection(len(index), int(index["n"].sum()), {})
    for _, row in index.sample(20, random_state=1).iterrows():
        counts = Counter(w.encode() for w in words(texts[row["id"]]))
        assert counts.total() == row["n"]
        top = dict(zip(row["coordinates"], row["tops"]))
        terms = sorted(counts)
        for term, place in zip(terms, ranked_search._coordinates(terms, s.coordinates)):
            assert top[place] >= counts[term]
    assert total.damping(0) == 25


def test_search_of_awkward_and_empty_tables(spark, awkward, empty):
    items = spark.createDataFrame([("a", "word1 of the", 1.0), ("b", "ça va", 2.0)], "item_id string, text string, score double")
    rows = ranked_search.ranked(awkward, items).collect()
    assert {r["item_id"] for r in rows} == {"a", "b"} and [r["doc_id"] for r in rows if r["item_id"] == "b"][0] == 8
    assert ranked_search.ranked(empty, items).count() == 0 and ranked_search.ranked(awkward, items.limit(0)).count() == 0


# Secrets


def base_truth(text):
    """The forms by plain loops over the patterns of the contract."""
    text = text or ""
    forms = [
        ("assign", r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 12),
        ("access", "AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18),
        ("hex", "[0-9a-f]+", lambda m: len(m[0]) >= 16),
    ]
    found = [(m.start(), k, m.end(), name) for k, (name, pattern, fits) in enumerate(forms) for m in re.finditer(pattern, text) if fits(m)]
    return [(name, a, b) for a, _, b, name in sorted(found)]


def spans(column):
    return [(s["kind"], s["start"], s["end"]) for s in column]


def test_base_spans_equal_brute_force(spark, texts):
    odd = [
        'PassWord = "abcdefghijkl" passwd:short token==AAAAAAAAAAAA secret=token=abcdefghijkl', "api_key: 'abc.def-ghi_jkl' apikey=123456789012",
        "ſecret=abcdefghijklmnop toKen=abcdefghijklmnop", "AKIA" + "A" * 13 + " xAKIA" + "Z9" * 8 + "AKIAAKIA", "é" * 5 + "deadbeef" * 4 + "g" + "0" * 16,
        "token  :  " + "x" * 11 + " token\n= abcdefghijklmnop", "", None, "token=" + "a" * 500_000,
    ]
    texts = dict(texts) | {10_000 + i: t for i, t in enumerate(odd)}
    rows = secret_spans.secret_spans(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        truth = base_truth(texts[r["doc_id"]])
        assert spans(r["base"]) == truth, texts[r["doc_id"]][:80]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == kind for k, _, _ in truth) for kind in ("assign", "access", "hex")]
        assert set(truth) <= set(spans(r["spans"])) and len(r["spans"]) == len(truth) + r["n_random"]


def test_digests_of_the_query(spark, texts):
    for r in queries.QUERIES["op12_secrets"](spark, SMALL).collect():
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in base_truth(texts[r["doc_id"]]))
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert [x for x in r["spans"].split(",") if x and not x.startswith("random")] == [x for x in base.split(",") if x]


def brute_discoveries(candidates, s):
    """Which candidates of a table are reported: the step-up rule on exact weighted probabilities."""
    tested = []
    for place, text in candidates:
        _, values, k, excess = secret_spans.infer(text)
        *ps, squared = secret_spans.battery(values, k)
        p, weight = secret_spans.evidence(len(values), k, excess, squared)
        tested.append((place, p, weight, secret_spans.fisher(tuple(ps))))
    mean = sum(w for _, _, w, _ in tested) / len(tested)
    ratios = sorted(p / w * mean for _, p, w, _ in tested)
    reached = [q for j, q in enumerate(ratios) if q <= s.rate * (j + 1) / len(ratios)]
    cut = max(reached, default=-1)
    return {place: p / w * mean for place, p, w, r in tested if p / w * mean <= cut and r >= s.level}, cut


def test_random_strings_are_found_and_structured_ones_are_not(spark):
    draw = random.Random(3)
    alphabets = ["0123456789abcdef", secret_spans._UP + secret_spans._LOW + secret_spans._DIGITS, secret_spans._UP + secret_spans._LOW + secret_spans._DIGITS + "+/"]
    keys = ["".join(draw.choices(a, k=n)) for a in alphabets for n in (32, 40, 64, 120) for _ in range(6)]
    plain = [
        "usr/local/share/applications/default", "getElementsByClassNameAndValue", "this-is-a-slug-for-a-long-title", "AAAAAAAAAAAAAAAAAAAAAAAA",
        "0123456789abcdef0123456789abcdef", "abcdefghijklmnopqrstuvwxyz", "Donaudampfschifffahrtsgesellschaft", "-" * 40, "2024-01-01_12-30-45_backup",
    ] * 8
    rows = [(i, f"see {x} here") for i, x in enumerate([*keys, *plain])]
    got = secret_spans.secret_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {r["doc_id"] for r in got if r["n_random"]}
    assert not any(i >= len(keys) for i in found) and len(found) >= 0.9 * len(keys)
    truth, cut = brute_discoveries([(i, m) for i, t in rows for m in re.findall("[A-Za-z0-9+/_-]{16,}", t)], secret_spans.Settings())
    # Steps are rounded up, by a factor of at most 10 ** (1 / 50).
    assert found <= set(truth) and all(q > cut / 10 ** (2 / 50) for i, q in truth.items() if i not in found)


def test_battery():
    draw = random.Random(1)
    random_bytes = [draw.randrange(64) for _ in range(400)]
    assert secret_spans.fisher(secret_spans.battery(random_bytes, 64)[:3]) > 0.01
    assert secret_spans.fisher(secret_spans.battery(sorted(random_bytes), 64)[:3]) < 1e-6
    assert secret_spans.fisher(secret_spans.battery([0, 63] * 200, 64)[:3]) < 1e-6
    assert [secret_spans.infer(x)[0] for x in ("0123", "12ab", "12AB", "xyz", "a_b", "a+b", "a+_b", "Ab1", "Ab")] == [
        "decimal", "hex", "hex", "lower", "base64url", "base64", "mixed", "base62", "letters"]
    # Probabilities are uniform under randomness, roughly.
    ps = [secret_spans.fisher(secret_spans.battery([draw.randrange(16) for _ in range(48)], 16)[:3]) for _ in range(2_000)]
    assert 0.02 < sum(p < 0.05 for p in ps) / len(ps) < 0.09 and 0.4 < sum(p < 0.5 for p in ps) / len(ps) < 0.6


def test_secrets_of_awkward_and_empty_tables(spark, awkward, empty):
    assert secret_spans.secret_spans(awkward).count() == 14 and secret_spans.secret_spans(empty).count() == 0
    assert secret_spans.secret_spans(awkward).columns == ["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base", "spans"]
    one = spark.createDataFrame([(None, "deadbeef" * 4 + "x" * 2_000_000)], "doc_id long, text string")
    assert secret_spans.secret_spans(one).first()["n_hex"] == 1


# Resampling


def resampling_truth(docs, target, share=25, least=20):
    counted = [(i, words(t)) for i, t in docs]
    runs = [[zlib.crc32(x.encode()) % 10_000 for x in [*w, *map(" ".join, zip(w, w[1:]))]] for _, w in counted]
    source, wanted = Counter(b for r in runs for b in r), Counter()
    for t in target:
        w = words(t)
        wanted.update(zlib.crc32(x.encode()) % 10_000 for x in [*w, *map(" ".join, zip(w, w[1:]))])
    of_source, of_target = source.total() + 10_000, wanted.total() + 10_000
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * of_source / ((source[b] + 1) * of_target))) for b in range(10_000)]
    rows = []
    for (i, w), run in zip(counted, runs):
        weight = sum(gain[b] for b in run) // len(run) if run else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(run), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(w)])
    fit = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for rank, r in enumerate(fit[: share * len(fit) // 100]):
        r[4] = rank + 1
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def drawn_rows(frame):
    return sorted((tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("settings", [resampling.Settings(), resampling.Settings(chunk=7, few=3)])
def test_resampling_equals_brute_force(spark, texts, settings):
    docs, target = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    rows = drawn_rows(resampling.resampled(docs.repartition(3), target, settings=settings))
    assert rows == resampling_truth(texts.items(), [r["text"] for r in target.collect()])
    assert sum(r[4] is not None for r in rows) > 10


def test_long_words_and_very_long_texts_are_hashed_whole(spark):
    long = ["x" * 47, "y" * 48, "Z" * 49, "w" * 5_000]
    docs = [(1, " ".join(long)), (2, " ".join(f"{a}{b}" for a in long for b in "abc")), (3, "ab cd " * 200_000), (4, "v" * 300_000 + " é Ü")]
    rows = drawn_rows(resampling.resampled(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([("ab Cd",)], "text string")))
    assert rows == resampling_truth(docs, ["ab Cd"])


def test_ties_and_repeated_ids(spark):
    prose = " ".join(f"word{i}" for i in range(25))
    docs = [(5, prose)] * 6 + [(5, prose + " more")] * 2 + [(None, prose)] * 5 + [(7, "few words")] * 4 + [(i, prose) for i in range(100, 140)]
    target = spark.createDataFrame([("word1 word2",), (None,)], "text string")
    for share in (0, 10, 33, 100):
        s = resampling.Settings(share=share, chunk=4, few=2)
        rows = drawn_rows(resampling.resampled(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), target, settings=s))
        assert rows == resampling_truth(docs, ["word1 word2"], share)


def test_the_cut_is_exact_for_any_rank(spark):
    draw = random.Random(2)
    keys = [(draw.randint(-3, 3), draw.randint(0, 50), 0, i) for i in range(3_000)]
    frame = spark.createDataFrame(keys, "a long, b long, c long, d long").repartition(6)
    s = resampling.Settings(chunk=50, few=10)
    for rank in (1, 2, 1_499, 1_500, 2_999, 3_000):
        assert resampling.cutoff(frame, rank, s) == sorted(keys)[rank - 1]
    assert resampling.cutoff(frame, 0, s) is None and resampling.cutoff(frame, 3_001, s) is None


def test_resampling_of_awkward_and_empty_tables(spark, awkward, empty):
    rows = resampling.resampled(awkward, awkward.select(F.col("text").alias("words")), target_text="words")
    assert rows.count() == 14 and rows.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert resampling.resampled(empty, empty).count() == 0
    plain = drawn_rows(resampling.resampled(awkward, empty))
    assert plain == resampling_truth([(r["doc_id"], r["text"]) for r in awkward.collect()], [])
