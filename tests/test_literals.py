"""Literal cases of each operator."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tabspine.config import Config, Limits, Roles
from tabspine.functions.jsonvals import json_value, pair_map
from tabspine.functions.keys import hash_split, normal_split
from tabspine.functions.numbers import threshold, to_number, widen_integers
from tabspine.functions.text import encode_label, in_list, is_truthy, served_name, snake_name, split_list
from tabspine.functions.times import job_time, run_stamp
from tabspine.operators.canary import canary_arm
from tabspine.operators.checks import (
    GateError,
    evaluation_checks,
    key_check,
    monitor_check,
    monitor_status,
    require,
    require_schema,
    table_checks,
)
from tabspine.operators.clean import LabelError, normalize_records, require_columns
from tabspine.operators.compare import compare_versions
from tabspine.operators.engineer import contract_violations, feature_frame, with_engineered_features
from tabspine.operators.metrics import classification_metrics
from tabspine.operators.payloads import PayloadError, payload_pins, require_readable, score_rows
from tabspine.operators.spine import alignment_counts, as_of_lookup
from tabspine.operators.status import latest_version

ROLES = Roles()


def values(df, col="v"):
    return [r[col] for r in df.select(col).collect()]


def texts(spark, *items):
    rows = list(enumerate(items))
    return spark.createDataFrame(rows, "i int, t string").repartition(1).sortWithinPartitions("i")


def test_label_encoding(spark):
    df = texts(spark, ">50K", "<=50K", ">50K.", "<=50K.", " >50K ", ">50k", "<=50K..", "unknown", None)
    assert values(df.select(encode_label(F.col("t")).alias("v"))) == [1, 0, 1, 0, 1, 1, 0, None, None]


def raw_record(**changes):
    row = {
        "age": "39", "workclass": " Private", "fnlwgt": "77516", "education": "Bachelors", "education-num": "13",
        "marital-status": "Never-married", "occupation": "Adm-clerical", "relationship": "Not-in-family", "race": "White",
        "sex": "Male", "capital-gain": "2174", "capital-loss": "0", "hours-per-week": "40",
        "native-country": "United-States", "income": "<=50K",
    }
    row.update(changes)
    return row


def frame(spark, *rows):
    names = list(rows[0])
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ", ".join(f"`{n}` string" for n in names))


def test_normalise(spark):
    df = normalize_records(frame(spark, raw_record(), raw_record(workclass="?", age="old")), split="train")
    assert "income" not in df.columns and "education_num" in df.columns
    assert df.columns[-2:] == ["split", "income_gt_50k"]
    first, second = sorted(df.collect(), key=lambda r: r["workclass"] or "", reverse=True)
    assert (first["workclass"], second["workclass"], second["age"]) == ("Private", None, None)
    assert {first["split"], second["split"]} == {"train"} and first["education_num"] == 13.0


def test_class_column_alias_and_missing_label(spark):
    row = raw_record(income=">50K.")
    aliased = {("class" if k == "income" else k): v for k, v in row.items()}
    assert normalize_records(frame(spark, aliased)).first()["income_gt_50k"] == 1
    without = {k: v for k, v in row.items() if k != "income"}
    with pytest.raises(LookupError):
        normalize_records(frame(spark, without))


def test_unknown_labels_are_refused_in_order(spark):
    bad = [raw_record(income=f"x{i:02d}") for i in range(12)]
    with pytest.raises(LabelError, match=r"\['x00', 'x01', .*'x07'\]$"):
        normalize_records(frame(spark, raw_record(), *bad))
    lenient = normalize_records(frame(spark, raw_record(), *bad), strict=False)
    assert lenient.filter("income_gt_50k IS NULL").count() == 12


def census_row(spark, **changes):
    row = {c: 1.0 for c in ROLES.numeric} | {c: "a" for c in ROLES.categorical} | {"row_id": 1, "split": "train", "income_gt_50k": 1}
    row.update(changes)
    schema = ", ".join(
        f"{c} {'double' if c in ROLES.numeric else 'string' if c in (*ROLES.categorical, 'split') else 'long'}" for c in row
    )
    return spark.createDataFrame([tuple(row.values())], schema)


def test_engineered_values(spark):
    df = census_row(spark, capital_gain=100.0, capital_loss=30.0, hours_per_week=45.0, fnlwgt=math.e - 1, education_num=4.0)
    row = with_engineered_features(df).first()
    assert (row["capital_net"], row["hours_over_40"], row["education_num_sq"]) == (70.0, 1, 16.0)
    assert row["log_fnlwgt"] == pytest.approx(1.0)
    known = with_engineered_features(
        census_row(spark, capital_gain=2174.0, capital_loss=0.0, fnlwgt=77516.0, education_num=13.0, hours_per_week=None)
    ).first()
    assert (known["capital_net"], known["education_num_sq"], known["hours_over_40"]) == (2174.0, 169.0, 0)
    assert known["log_fnlwgt"] == pytest.approx(11.258252546125393)


def test_engineering_needs_all_columns(spark):
    with pytest.raises(LookupError, match="workclass"):
        with_engineered_features(spark.range(1).select(F.lit(1).alias("age")))


def test_contract(spark):
    contract = ROLES.contract
    assert len(contract) == 18 and contract["hours_over_40"] == "double" and contract["sex"] == "string"
    assert ROLES.label_col not in contract
    features = feature_frame(census_row(spark))
    assert contract_violations(features) == []
    require_schema(features)
    leaked = features.withColumns({"income_gt_50k": F.lit(1), "age": F.lit("x")})
    assert contract_violations(leaked) == ["age: string is not double", "income_gt_50k: label among the features"]
    with pytest.raises(GateError):
        require_schema(leaked)


def test_latest_version(spark):
    df = spark.createDataFrame([("m", "1"), ("m", "4"), ("m", "2"), ("n", "10"), ("n", "9")], "name string, version string")
    assert {tuple(r) for r in latest_version(df, ["name"], "version").collect()} == {("m", "4"), ("n", "10")}


def metric(spark, value, name="roc_auc"):
    return spark.createDataFrame([(name, value)], "metric string, value double")


@pytest.mark.parametrize(
    ("challenger", "champion", "higher", "margin", "expected"),
    [
        (0.70, 0.80, True, 0.0, "no-go"),
        (0.82, 0.80, True, 0.01, "go"),
        (0.80, 0.80, True, 0.0, "go"),
        (0.10, 0.12, False, 0.01, "go"),
        (0.12, 0.10, False, 0.01, "no-go"),
        (None, 0.80, True, 0.0, "error"),
        (0.80, None, True, 0.0, "error"),
    ],
)
def test_compare(spark, challenger, champion, higher, margin, expected):
    row = compare_versions(metric(spark, challenger), metric(spark, champion), higher_is_better=higher, margin=margin).first()
    assert (row["result"], row["first_version"]) == (expected, False)


def test_compare_first_version_and_absent_metric(spark):
    first = compare_versions(metric(spark, None), None).first()
    assert (first["result"], first["first_version"]) == ("go", True)
    absent = compare_versions(metric(spark, 0.9), metric(spark, 0.9, "f1")).collect()
    assert [r["result"] for r in absent] == ["error"]


@pytest.mark.parametrize(
    ("payload", "expected"),
    [
        ('{"predictions":[0.1,0.9]}', [0.1, 0.9]),
        ('{"predictions":[{"score":0.4}]}', [0.4]),
        ('{"predictions":[{"prediction":[0.2,0.8]}]}', [0.8]),
        ("[0.2,0.8]", [0.2, 0.8]),
        ('{"prediction":0.3}', [0.3]),
        ("[[0.1,0.9]]", [0.9]),
        ("[[0.7]]", [0.7]),
        ('{"predictions":[{"p":0.55}]}', [0.55]),
        ('{"predictions":[{"z":0.1,"a":0.9}]}', [0.1]),
        ('{"prediction":[{"flag":true,"z":0.1,"a":0.9}]}', [0.1]),
        ('{"predictions":[{"prediction":[0.6]}, 1, "0.5", true]}', [0.6, 1.0, 0.5, 1.0]),
        ("0.25", [0.25]),
        ("[]", []),
    ],
)
def test_score_payloads(spark, payload, expected):
    rows = score_rows(texts(spark, payload), "i", "t").collect()
    assert [r["score"] for r in rows if r["position"] is not None or expected] == expected


@pytest.mark.parametrize(
    "payload",
    [None, "null", '{"foo":1}', '{"predictions":null,"prediction":0.3}', '{"predictions":["x"]}', '{"predictions":[{"a":"b"}]}',
     '{"predictions":[0.1,null]}', "not json"],
)
def test_unreadable_payloads(spark, payload):
    scored = score_rows(texts(spark, payload), "i", "t")
    assert [tuple(r)[1:] for r in scored.collect()] == [(None, None)]
    with pytest.raises(PayloadError):
        require_readable(scored)


def test_pair_map(spark):
    df = texts(spark, '{"a":1,"b":null}', '[{"key":"a","value":"x"},{"name":"b","val":2},{"key":"","name":"c","value":3},{"key":"d"},5]', None)
    got = values(df.select(pair_map("t").alias("v")))
    assert got[0] == {"a": "1", "b": "None"}
    assert got[1:] == [{"a": "x", "b": "2", "c": "3"}, {}]
    merged = values(df.filter("i = 0").withColumn("u", F.lit('[{"key":"a","value":"z"}]')).select(pair_map("t", "u").alias("v")))
    assert merged == [{"a": "z", "b": "None"}]


def pin(spark, payload, run_id="12"):
    df = spark.createDataFrame([(run_id, payload)], "run string, t string")
    row = payload_pins(df, "run", "t").first()
    return row["promotable"], row["source_model_version"], row["reason"]


def task(values):
    return f'{{"run_id": 12, "tasks": [{{"task_key": "promotion_ready", "values": {values}}}]}}'


def test_pins(spark):
    assert pin(spark, task('{"ready": "true", "go_version": "6"}')) == (True, "6", "ready")
    assert pin(spark, task('[{"key": "ready", "value": "true"}, {"key": "go_version", "value": "6"}]')) == (True, "6", "ready")
    assert pin(spark, task('{"ready": "false"}')) == (False, "", "not ready")
    assert pin(spark, task('{"go_version": "6"}')) == (None, "", "ready missing")
    assert pin(spark, task('{"ready": "true", "go_version": "  "}')) == (None, "", "ready without version")
    assert pin(spark, task('{"ready": "true", "go_version": "6"}'), " ") == (None, "", "empty run id")
    assert pin(spark, task('{"ready": "true", "go_version": "6"}'), "13") == (None, "", "run id mismatch")
    assert pin(spark, '{"tasks": []}') == (None, "", "task missing")
    odd = '{"tasks": [5, {"taskKey": "promotion_ready", "status": {"values": {"ready": "TRUE", "go_version": 7}}}, "x"]}'
    assert pin(spark, odd) == (True, "7", "ready")
    repaired = '{"task_runs": [{"task_key": "promotion_ready", "values": {"ready": "no"}}], "repair_history": [3, {"tasks": null}, %s]}'
    again = '{"tasks": [{"task_key": "promotion_ready", "taskValues": {"ready": "true", "go_version": "8"}}]}'
    assert pin(spark, repaired % again) == (True, "8", "ready")


def test_canary_routes(spark):
    keys = spark.range(10_000)
    arm = lambda previous, percent: dict(
        keys.groupBy(canary_arm(F.col("id"), "9", previous, percent).alias("v")).count().collect()
    )
    shares = arm("7", 10)
    assert set(shares) == {"9", "7"} and 800 < shares["9"] < 1200
    assert arm("7", 100) == {"9": 10_000} and arm(None, 10) == {"9": 10_000} and arm("7", 0) == {"7": 10_000}


def test_monitor(spark):
    missing = monitor_status(None, None, as_of="2024-01-01 00:00:00", job_run_id="r", spark=spark)
    assert [tuple(r)[1:] for r in missing.collect()] == [(False, "feature table missing", "r")]
    require(monitor_check(None, spark))
    require(monitor_check(missing.filter("gate_ok"), spark))
    with pytest.raises(GateError, match="feature table missing"):
        require(monitor_check(missing, spark))
    mismatch = monitor_status(spark.range(3), None).first()
    assert not mismatch["gate_ok"] and mismatch["reason"].startswith("feature contract mismatch")


def test_text_functions(spark):
    truthy = texts(spark, "true", "YES", "1", " y ", "false", "0", "", None)
    assert values(truthy.select(is_truthy(F.col("t")).alias("v"))) == [True] * 4 + [False] * 4
    lists = texts(spark, "a, b ,,c", "", None)
    assert values(lists.select(split_list(F.col("t")).alias("v"))) == [["a", "b", "c"], [], []]
    assert values(lists.select(in_list(F.lit(" b "), F.col("t")).alias("v"))) == [True, False, False]
    assert values(spark.range(1).select(served_name(F.lit("main.ml.scorer"), F.lit(3)).alias("v"))) == ["scorer-3"]
    assert snake_name(" Hours-per week ") == "hours_per_week"


def test_run_stamp(spark):
    assert values(spark.range(1).select(run_stamp(job_time("2026-09-14 23:28:56")).alias("v"))) == ["140926-232856"]


def test_numbers(spark):
    df = texts(spark, "1", " 2.5 ", "x", "", None)
    assert values(df.select(to_number(F.col("t")).alias("v"))) == [1.0, 2.5, None, None, None]
    assert values(spark.range(1).select(threshold(F.lit(0.5)).alias("v"))) == [1]
    assert dict(widen_integers(df).dtypes) == {"i": "bigint", "t": "string"}


def test_splits(spark):
    df = texts(spark, "train", "holdout", "test", None)
    assert values(df.select(normal_split(F.col("t")).alias("v"))) == ["train", "holdout", "holdout", "holdout"]
    share = spark.range(20_000).filter(hash_split(F.col("id")) == "train").count() / 20_000
    assert 0.79 < share < 0.81


def test_json_value(spark):
    row = spark.range(1).select(
        json_value(F.lit("a\nb")), json_value(F.lit(None).cast("int")), json_value(F.array(F.lit(1), F.lit(2))), json_value(F.lit(0.5))
    ).first()
    assert tuple(row) == ('"a\\nb"', "null", "[1,2]", "0.5")


def test_table_checks_refuse(spark):
    limits = Limits(min_table_rows=1)
    row = census_row(spark)
    checks = {r["check"]: r["passed"] for r in table_checks(row, limits=limits).collect()}
    assert not checks["both_classes"] and not checks["both_splits"] and checks["key_unique"] and checks["min_rows"]
    twice = row.unionByName(row.withColumns({"income_gt_50k": F.lit(0).cast("long"), "split": F.lit("holdout")}))
    with pytest.raises(GateError, match="key_unique"):
        require(table_checks(twice, limits=limits))
    with pytest.raises(GateError, match="required_columns"):
        require(table_checks(row.drop("age")))
    empty = {r["check"]: r["passed"] for r in table_checks(row.filter("row_id < 0"), limits=limits).collect()}
    assert not empty["id_null_rate"] and not empty["min_rows"]
    with pytest.raises(GateError):
        require(key_check(twice, "row_id"))
    with pytest.raises(LookupError):
        require_columns(row, ["absent"])


def test_evaluation_gate(spark):
    scored = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, None), (None, 0.4), (1, float("nan"))], "y int, s double")
    metrics = classification_metrics(scored, "y", "s")
    row = metrics.first()
    assert (row["roc_auc"], row["eval_rows"], row["lost_rows"]) == (1.0, 2, 3)
    checks = {r["check"]: r["passed"] for r in evaluation_checks(metrics, Limits(min_eval_rows=2)).collect()}
    assert checks == {"min_eval_rows": True, "no_lost_rows": False, "metrics_defined": True, "min_roc_auc": True}
    one_class = classification_metrics(scored.filter("y = 1"), "y", "s")
    assert one_class.first()["roc_auc"] is None
    assert not {r["check"]: r["passed"] for r in evaluation_checks(one_class).collect()}["metrics_defined"]
    nothing = classification_metrics(scored.filter("y = 7"), "y", "s")
    assert not any(r["passed"] for r in evaluation_checks(nothing).collect() if r["check"] == "min_eval_rows")


def test_alignment_counts_a_null_feature_as_present(spark):
    raw = census_row(spark)
    features = raw.withColumn("age", F.lit(None).cast("double"))
    row = alignment_counts(raw, features, raw, "train").first()
    assert row.asDict() == {
        "raw_rows": 1, "spine_rows": 1, "raw_without_features": 0, "raw_without_spine": 0, "spine_without_raw": 0
    }


@pytest.mark.parametrize("rows_per_bucket", [1_000_000, 3])
def test_as_of_across_buckets(spark, rows_per_bucket):
    known = spark.createDataFrame([(1, 10, "a"), (1, 20, "b"), (1, 90, "z"), (2, 50, "c")], "k int, at int, v string")
    asked = [(1, 5), (1, 10), (1, 19), (1, 20), (1, 21), (1, 80), (1, 95), (2, 49), (2, 95), (3, 10), (1, 80), (1, None)]
    expected = [None, "a", "a", "b", "b", "b", "z", None, "c", None, "b", None]
    spine = spark.createDataFrame([(i, *r) for i, r in enumerate(asked)], "i int, k int, t int")
    found = as_of_lookup(spine, known, "k", "t", "at", ["v"], rows_per_bucket)
    assert [r["v"] for r in found.orderBy("i").collect()] == expected


def test_config_is_explicit():
    assert Config().limits.min_roc_auc == 0.70 and Config().trees.trees == 80
