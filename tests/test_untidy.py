"""Untidy inputs: what must be counted, refused or kept apart instead of lost."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tabspine.functions.numbers import to_number
from tabspine.operators.compare import compare_versions
from tabspine.operators.fingerprint import table_fingerprint
from tabspine.operators.importance import permuted_rows
from tabspine.operators.metrics import classification_metrics
from tabspine.operators.payloads import score_rows
from tabspine.operators.upsert import change_feed
from tabspine.sources.tables import VersionedTable
from tabspine.streaming.sync import file_stream, sync_rows


def test_only_plain_decimal_text_is_a_number(spark):
    cases = {"1": 1.0, " -2.5 ": -2.5, "+.5": 0.5, "3.": 3.0, "1e3": 1000.0, "nan": None, "NaN": None, "inf": None, "12d": None, "12f": None, "0x1p3": None, "": None, "?": None}
    rows = spark.createDataFrame([(t,) for t in cases], "t string").select("t", to_number(F.col("t")).alias("n")).collect()
    assert {r["t"]: r["n"] for r in rows} == cases


def test_score_of_a_pair_is_its_second_member_or_none(spark):
    cases = {"[[0.9,null]]": [None], '[[0.9,"x"]]': [None], '{"predictions":[{"prediction":[0.2,"x"]}]}': [None], "[[0.7]]": [0.7], "[]": [], "[[0.1,0.9]]": [0.9]}
    rows = score_rows(spark.createDataFrame(list(enumerate(cases)), "k int, p string"), "k", "p").collect()
    found = {i: [r["score"] for r in rows if r["k"] == i] for i in range(len(cases))}
    assert found == dict(enumerate(cases.values()))


def test_other_labels_are_lost_rows(spark):
    rows = spark.createDataFrame([(0, 0.1), (1, 0.9), (2, 0.5), (2, 0.6), (1, float("nan")), (None, 0.3)], "y int, s double")
    row = classification_metrics(rows, "y", "s").first()
    assert (row["eval_rows"], row["lost_rows"], row["roc_auc"]) == (2, 4, 1.0)


def test_a_missing_metric_still_gives_a_decision(spark):
    none = spark.createDataFrame([], "metric string, value double")
    assert [(r["result"], r["first_version"]) for r in compare_versions(none, None).collect()] == [("go", True)]
    assert [r["result"] for r in compare_versions(none, none).collect()] == ["error"]


def test_fingerprint_tells_nulls_apart(spark):
    a, b = (spark.createDataFrame([row], "x string, y string") for row in ((None, "x"), ("x", None)))
    assert table_fingerprint(a).first() != table_fingerprint(b).first()
    one = lambda *row: table_fingerprint(spark.createDataFrame([row], "a string, b string"), portable=True).first()
    assert one("p|q", "x") != one("p", "q|x") and one(None, "x") != one("\\N", "x") and one("", None) != one(None, "")


def test_blocks_do_not_change_the_ring(spark):
    rows = spark.range(500).select("id", (F.col("id") * 7 % 101).alias("x"))
    one, many = (
        sorted((r["id"], r["_repeat"], r["_donor"]["x"]) for r in permuted_rows(rows, "id", ["x"], 2, block_rows=n).collect())
        for n in (1000, 60)
    )
    assert one == many


def test_upserts_refuse_what_they_would_lose(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "k")
    table.upsert(spark.createDataFrame([(1, "a")], "k long, v string"))
    for rows, schema in (([(2, "b"), (2, "c")], "k long, v string"), ([(None, "b")], "k long, v string"), ([(2, "b", 1)], "k long, v string, w int")):
        with pytest.raises(ValueError):
            table.upsert(spark.createDataFrame(rows, schema))
    assert [tuple(r) for r in table.read().collect()] == [(1, "a")]


def test_two_writers_get_two_numbers(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "k")
    table.replace(spark.createDataFrame([(1, "a")], "k long, v string"))
    # Another writer has claimed the next number but has not written yet.
    assert table._fs().createNewFile(table._hadoop(f"{table.path}/_claims/000000002"))
    assert table.upsert(spark.createDataFrame([(2, "b")], "k long, v string")) >= 3
    assert table.read().count() == 2


def test_change_feed_refuses_null_keys(spark):
    rows = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    with pytest.raises(Exception, match="null k in a snapshot"):
        change_feed(rows, rows, "k").collect()


def test_change_feed_over_different_columns(spark):
    before, after = spark.createDataFrame([(1, "a", 5)], "k int, v string, gone int"), spark.createDataFrame([(1, "a", 7)], "k int, v string, new int")
    rows = {r["_change_type"]: (r["gone"], r["new"]) for r in change_feed(before, after, "k").collect()}
    assert rows == {"update_preimage": (5, None), "update_postimage": (None, 7)}


def test_a_new_checkpoint_brings_new_files(spark, tmp_path):
    schema = "k long, seq long, v string"
    table = VersionedTable(spark, str(tmp_path / "state"), "k")

    def run(checkpoint):
        stream = file_stream(spark, str(tmp_path / "in" / "*"), spark.createDataFrame([], schema).schema)
        sync_rows(stream, table, ["seq"], str(tmp_path / checkpoint))
        return sorted(tuple(r) for r in table.read().collect())

    spark.createDataFrame([(1, 1, "a")], schema).write.parquet(str(tmp_path / "in" / "0"))
    assert run("one") == [(1, 1, "a")]
    spark.createDataFrame([(2, 1, "b")], schema).write.parquet(str(tmp_path / "in" / "1"))
    assert run("two") == [(1, 1, "a"), (2, 1, "b")]
