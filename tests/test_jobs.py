"""Sources, tables, jobs and streams end to end."""

from __future__ import annotations

import json

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from showcase import streams
from showcase.frames import CENSUS_SCORE, CENSUS_SCORE_B, census
from tabspine.config import CSV_COLUMNS, Config, Limits, Roles, TreeParams
from tabspine.functions.keys import hash_split
from tabspine.operators.checks import GateError
from tabspine.operators.clean import LabelError
from tabspine.operators.engineer import feature_frame
from tabspine.operators.fingerprint import fingerprint_of
from tabspine.operators.scoring import Model, fit_preprocessing, many_valued, score_in_chunks
from tabspine.operators.spine import label_spine, lookup_features, prediction_inputs, training_frame
from tabspine.operators.status import latest_row
from tabspine.plans.data import check_job, feature_job, profile_job, seed_job, with_split
from tabspine.plans import model as model_plans
from tabspine.plans.model import (
    check_alignment,
    compare_evaluated,
    compare_job,
    evaluate_job,
    evaluate_versions,
    explain_job,
    holdout_metrics,
    monitor_job,
    predict_job,
    score_keys,
    smoke_job,
    train_job,
)
from tabspine.sources import scratch
from tabspine.sources.changelog import ChangeLog
from tabspine.sources.records import load_records, read_first_available, read_records, require_few_malformed
from tabspine.sources.tables import VersionedTable, append_log, read_log, replace_table, require_table, table_or_none
from tabspine.streaming.sync import file_stream, refresh_features, sync_changes, sync_rows

TRAIN = """|1x3 Cross validator
39, State-gov, 77516, Bachelors, 13, Never-married, Adm-clerical, Not-in-family, White, Male, 2174, 0, 40, United-States, <=50K

50, ?, 83311, Bachelors, 13, Married-civ-spouse, Exec-managerial, Husband, White, Male, 0, 0, 13, ?, >50K
"""
HOLDOUT = """25, Private, 226802, 11th, 7, Never-married, Machine-op-inspct, Own-child, Black, Male, 0, 0, x, United-States, >50K.
"""


def rule(expression):
    return lambda df: df.withColumn("score", F.expr(expression))


@pytest.fixture()
def files(tmp_path):
    (tmp_path / "train.csv").write_text(TRAIN)
    (tmp_path / "holdout.csv").write_text(HOLDOUT)
    return str(tmp_path)


def test_records(spark, files):
    rows = read_records(spark, f"{files}/train.csv").collect()
    assert len(rows) == 2 and rows[0].__fields__ == list(CSV_COLUMNS)
    assert (rows[0]["workclass"], rows[1]["workclass"], rows[1]["native-country"]) == ("State-gov", None, None)


def test_seed_keys_follow_the_lines(spark, files, tmp_path):
    many = "\n".join(TRAIN.splitlines()[1].replace("39,", f"{i},") for i in range(500))
    (tmp_path / "train2.csv").write_text(many)
    raw = VersionedTable(spark, str(tmp_path / "raw"))
    seed_job(spark, [f"{files}/train.csv", f"{files}/train2.csv"], f"{files}/holdout.csv", raw)
    rows = raw.read().orderBy("row_id").collect()
    assert [r["row_id"] for r in rows] == list(range(1, 504))
    assert [r["age"] for r in rows[:2]] == [39.0, 50.0] and [r["age"] for r in rows[2:502]] == [float(i) for i in range(500)]
    last = rows[-1]
    assert (last["split"], last["hours_per_week"], last["income_gt_50k"]) == ("holdout", None, 1)
    assert raw.read().columns == ["row_id", *Roles().features, "split", "income_gt_50k"]


def test_malformed_lines_are_set_aside(spark, tmp_path):
    (tmp_path / "a.csv").write_text("|x\n1,b\n|2,c\n2,c,extra\n3\n")
    (tmp_path / "b.csv").write_text("\n  \n|4,d\n\n5,e\n6,f\n|7,g\n")
    (tmp_path / "c.csv").write_text("one\n|8,h\n9,\n")
    found = load_records(spark, [[str(tmp_path / f"{n}.csv") for n in "cab"]], ["k", "v"])
    # Files go by their paths; a pipe line is data unless it is the first of its file.
    assert sorted(map(tuple, found.rows.select("_number", "k", "v").collect())) == [
        (1, "1", "b"), (2, "|2", "c"), (3, "5", "e"), (4, "6", "f"), (5, "|7", "g"), (6, "|8", "h"), (7, "9", None)]
    assert sorted((r["_file"][-5:], r["line"]) for r in found.malformed.collect()) == [("a.csv", "2,c,extra"), ("a.csv", "3"), ("c.csv", "one")]
    with pytest.raises(ValueError, match="more than 2 lines"):
        require_few_malformed(found.malformed, 2)
    require_few_malformed(found.malformed, 3)


def test_lines_are_numbered_where_they_lie(spark, tmp_path):
    lines = [f"{i},{'x' * (i % 50)}" for i in range(20_000)]
    for n, part in enumerate((lines[:9_000], lines[9_000:9_001], lines[9_001:])):
        (tmp_path / f"{n}.csv").write_text("|head,er\n" * (n != 1) + "\n".join(part) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = load_records(spark, [str(tmp_path / "[01].csv"), str(tmp_path / "2.csv")], ["k", "v"]).rows
        assert rows.rdd.getNumPartitions() > 4
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan and "rangepartitioning" not in plan and "Window" not in plan
        assert rows.filter("_number <=> try_cast(k AS BIGINT) + 1").count() == 20_000 and rows.count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_seed_refuses_unknown_labels(spark, files, tmp_path):
    (tmp_path / "bad.csv").write_text(HOLDOUT.replace(">50K.", "rich"))
    with pytest.raises(LabelError, match="rich"):
        seed_job(spark, f"{files}/train.csv", f"{files}/bad.csv", VersionedTable(spark, str(tmp_path / "raw")))


def test_first_available(spark, files, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "a"))
    assert read_first_available(spark, [str(tmp_path / "none"), str(tmp_path / "a")]).count() == 3
    with pytest.raises(FileNotFoundError, match="none"):
        read_first_available(spark, [str(tmp_path / "none")])
    lines = read_first_available(spark, [f"{files}/none.csv", f"{files}/train.csv"], lambda p: read_records(spark, p))
    assert lines.count() == 2


def test_versions(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert not table.exists() and table.version == 0
    with pytest.raises(LookupError):
        table.read()
    table.replace(spark.range(3))
    table.replace(spark.range(2).withColumn("v", F.lit("x")))
    assert table.version == 2 and table.read().columns == ["id", "v"] and table.read(1).count() == 3
    # A write that never committed is not seen, and its number is not used again.
    (tmp_path / "t" / "v000000003").mkdir()
    assert table.version == 2
    assert table.replace(spark.range(1)) == 4 and table.read().count() == 1
    assert table.vacuum(keep=1) == 2 and table.read().count() == 1
    with pytest.raises(LookupError):
        table.read(1)
    with pytest.raises(ValueError, match="no key"):
        table.upsert(spark.range(1))


def rows_of_frame(df):
    return sorted(map(tuple, df.collect()), key=repr)


def rows_of(table, version=None):
    return sorted(tuple(r) for r in table.read(version).collect())


def test_deltas(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "id", max_deltas=3, max_delta_share=10.0)
    row = lambda k, v: spark.range(k, k + 1).withColumn("v", F.lit(v))
    table.upsert(spark.range(3).withColumn("v", F.lit("a")))
    table.upsert(row(1, "b"))
    table.upsert(row(7, "c"))
    table.apply(row(2, "").withColumn("_deleted", F.lit(True)))
    assert table.version == 4 and rows_of(table) == [(0, "a"), (1, "b"), (7, "c")]
    assert [len(list((tmp_path / "t").glob(p))) for p in ("v*[0-9]", "v*d")] == [1, 3]
    assert rows_of(table, 2) == [(0, "a"), (1, "b"), (2, "a")] and table.vacuum(1) == 0
    # One delta more than allowed: everything is folded into a new full version.
    assert table.upsert(row(2, "d")) == 6 and rows_of(table) == [(0, "a"), (1, "b"), (2, "d"), (7, "c")]
    assert table.vacuum(1) == 5 and rows_of(table) == [(0, "a"), (1, "b"), (2, "d"), (7, "c")]


def test_a_fold_loses_no_write_that_commits_late(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "id", max_deltas=0)
    row = lambda k, v: spark.range(k, k + 1).withColumn("v", F.lit(v))
    deleted = F.lit(False).alias("_deleted")
    table.upsert(row(0, "first"))
    late = table.reserve()
    assert late == 2 and table.upsert(row(1, "a")) == 4  # 3, folded into 4
    assert rows_of(table) == [(0, "first"), (1, "a")] and table.vacuum(1) == 0
    row(1, "late").unionByName(row(2, "late")).select("*", deleted).write.parquet(str(tmp_path / "t" / "v000000002d"))
    # What was written under a larger number stands, whatever committed last.
    assert rows_of(table) == [(0, "first"), (1, "a"), (2, "late")]
    assert table.upsert(row(3, "b")) == 6 and rows_of(table) == [(0, "first"), (1, "a"), (2, "late"), (3, "b")]
    assert table.vacuum(1) == 5 and rows_of(table) == [(0, "first"), (1, "a"), (2, "late"), (3, "b")]


def test_fingerprints_follow_the_deltas(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "id", max_deltas=3, max_delta_share=10.0)
    rows = lambda low, n, v: spark.range(low, low + n).withColumn("v", F.lit(v))
    table.upsert(rows(0, 300, "a"))
    first = table.fingerprint()
    for i in range(10):
        low = (i * 67) % 330
        if i % 3 == 2:
            table.apply(rows(low, 9, "").withColumn("_deleted", F.lit(True)))
        else:
            table.upsert(rows(low, 25, f"v{i % 4}"))
        assert table.fingerprint() == fingerprint_of(table.read()), i
    assert table.fingerprint() != first
    # A state that has a fingerprint is not read again, a later one only where deltas touch it.
    for file in (tmp_path / "t").glob("v*/*.parquet"):
        file.rename(file.with_suffix(".gone"))
    assert table.fingerprint().rows > 0


def test_tables_of_as_many_buckets_join_without_a_shuffle(spark, sf_dir, tmp_path):
    raw, spine, features = (VersionedTable(spark, str(tmp_path / n), "row_id", buckets=4) for n in ("raw", "spine", "features"))
    raw.replace(census(spark, sf_dir))
    feature_job(raw.read(), spine, features)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for again in (False, True):
            lookups = {
                "train": training_frame(spine.read(), features.read(), "train"),
                "evaluate": lookup_features(spine.read().filter("split = 'holdout'").select("row_id"), features.read(), "row_id", ["age"]),
                "predict": prediction_inputs(raw.read(), features.read(), "row_id"),
                "explain": training_frame(spine.read(), features.read(), "holdout", keep_key=True),
            }
            for name, frame in lookups.items():
                assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString(), name
            assert lookups["predict"].count() == raw.read().count()
            assert lookups["train"].filter("age IS NULL").isEmpty() and lookups["train"].count() > 0
            if not again:  # another session's catalog knows none of the tables
                for found in spark.catalog.listTables():
                    spark.sql(f"DROP TABLE IF EXISTS {found.name}")
        assert features.read().filter("row_id = 5").count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    version = features.version
    features.upsert(features.read().filter("row_id = 5").withColumn("age", F.lit(1).cast(features.read().schema["age"].dataType)))
    assert features.version > version and features.read().filter("age = 1").count() == 1


def test_a_writer_that_was_given_up_is_told(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "id", max_deltas=0, patience=-1.0)
    table.upsert(spark.range(1))
    late = table.reserve()
    table.upsert(spark.range(1, 2))
    assert table.vacuum(1) == 2
    with pytest.raises(RuntimeError, match="given up"):
        table.replace(spark.range(9), number=late)
    assert table.read().count() == 2


def test_the_log_misses_no_version(spark, tmp_path, monkeypatch):
    features, copy = (VersionedTable(spark, str(tmp_path / n), "k") for n in ("features", "copy"))
    log = ChangeLog(spark, str(tmp_path / "log"), "k")
    frame = lambda rows: spark.createDataFrame(rows, "k long, v string")

    def publish(rows, crash=""):
        log.catch_up(features)
        version = features.reserve()
        log.stage(features.read(), frame(rows), version)
        if crash == "before":
            return
        features.replace(frame(rows), number=version)
        if crash != "after":
            log.settle(features)

    log.start(features.replace(frame([(1, "a"), (2, "b")])))
    publish([(1, "lost")], "before")  # staged, never published
    publish([(1, "A"), (2, "b"), (3, "c")], "after")  # published, not settled
    assert not log.exists()
    publish([(1, "A"), (3, "C")])
    features.upsert(frame([(4, "d")]))  # by another writer
    log.catch_up(features)
    assert sorted({r["_commit_version"] for r in log.read().collect()}) == [3, 4, features.version]
    assert log.read().filter("v = 'lost'").count() == 0
    assert sorted((r["k"], r["_change_type"], r["v"]) for r in log.read(after=3).filter("_commit_version = 4").collect()) == [
        (2, "delete", "b"), (3, "update_postimage", "C"), (3, "update_preimage", "c")]
    copy.replace(features.read(1))
    sync_changes(log.stream(files_per_batch=1), copy, ["_commit_version"], str(tmp_path / "c"))
    assert rows_of(copy) == rows_of(features) == [(1, "A"), (3, "C"), (4, "d")]


def test_changes_staged_beside_another_writer_are_told_anew(spark, tmp_path):
    features = VersionedTable(spark, str(tmp_path / "features"), "k")
    log = ChangeLog(spark, str(tmp_path / "log"), "k")
    frame = lambda *ks: spark.createDataFrame([(k,) for k in ks], "k long")
    log.start(features.replace(frame(1)))
    first, second = features.reserve(), features.reserve()
    log.stage(features.read(), frame(1, 2), first)
    log.stage(features.read(), frame(1, 3), second)
    features.replace(frame(1, 2), number=first)
    features.replace(frame(1, 3), number=second)
    log.settle(features)
    found = {(r["_commit_version"], r["_change_type"], r["k"]) for r in log.read().collect()}
    assert found == {(2, "insert", 2), (3, "delete", 2), (3, "insert", 3)}


def test_large_delta_is_folded_at_once(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "id")
    table.upsert(spark.range(10).withColumn("v", F.lit("a")))
    assert table.upsert(spark.range(5, 15).withColumn("v", F.lit("b"))) == 3
    assert rows_of(table) == [(i, "a" if i < 5 else "b") for i in range(15)]


def test_small_delta_reads_without_shuffling_the_table(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "id", max_delta_share=10.0)
    table.upsert(spark.range(1000))
    table.upsert(spark.range(998, 1002))
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and table.read().count() == 1002


def test_tagged_upsert_is_applied_once(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "k", max_delta_share=10.0)
    rows = spark.createDataFrame([(1, "a")], "k int, v string")
    assert table.upsert(rows, "s-0") == 1
    assert table.upsert(rows.withColumn("v", F.lit("z")), "s-0") == 1
    assert table.upsert(rows.withColumn("v", F.lit("b")), "s-1") == 2
    assert rows_of(table) == [(1, "b")] and not table.has_tag("0") and table.has_tag("s-1")


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    for name in ("spine_b", "features_b"):
        replace_table(spark.range(2000), name, path=str(tmp_path / name), bucket_by=(4, "id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = spark.table("spine_b").join(spark.table("features_b"), "id", "left")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString() and joined.count() == 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("spine_b", "features_b"):
            spark.sql(f"DROP TABLE {name}")


def test_catalog_tables(spark, tmp_path):
    assert table_or_none(spark, "absent_table") is None
    with pytest.raises(LookupError):
        require_table(spark, "absent_table")
    for cols in (["id"], ["id", "v"]):
        replace_table(spark.range(4).withColumn("v", F.col("id") % 2).select(*cols), "tests_t", path=str(tmp_path / "t"))
    assert require_table(spark, "tests_t").columns == ["id", "v"]
    spark.sql("DROP TABLE tests_t")


def test_log_gains_columns(spark, tmp_path):
    path = str(tmp_path / "log")
    append_log(spark.range(2), path)
    append_log(spark.range(1).withColumn("note", F.lit("n")), path)
    assert sorted((r["id"], r["note"]) for r in read_log(spark, path).collect() if r["note"] is None) == [(0, None), (1, None)]


def test_scratch_uses_the_named_folder(spark):
    root = scratch.scratch_root(spark)
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or root == named.rstrip("/")
    kept = scratch.materialize(spark.range(5), "kept")
    assert kept.count() == 5 and kept.inputFiles()[0].removeprefix("file://").startswith(root.removeprefix("file://"))


def test_splits(spark, sf_dir):
    raw = census(spark, sf_dir)
    assert {r[0] for r in with_split(raw).select("split").distinct().collect()} == {"train", "holdout"}
    hashed = with_split(raw.drop("split"))
    assert hashed.filter(F.col("split") != hash_split(F.col("row_id"))).count() == 0
    timed = raw.drop("split").withColumn("at", F.timestamp_seconds(F.col("fnlwgt")))
    split = with_split(timed, Config(roles=Roles(event_time_col="at")))
    n = raw.count()
    assert split.filter("split = 'train'").count() == int(0.8 * n)
    bounds = split.groupBy("split").agg(F.min("at").alias("lo"), F.max("at").alias("hi")).collect()
    by = {r["split"]: r for r in bounds}
    assert by["train"]["hi"] <= by["holdout"]["lo"]


@pytest.fixture(scope="module")
def tables(spark, sf_dir, tmp_path_factory):
    """Raw, spine and feature tables as the feature job leaves them."""
    root = tmp_path_factory.mktemp("tables")
    raw = VersionedTable(spark, str(root / "raw"))
    raw.replace(census(spark, sf_dir))
    spine, features = (VersionedTable(spark, str(root / n)) for n in ("spine", "features"))
    feed = ChangeLog(spark, str(root / "feed"), "row_id")
    feature_job(raw.read(), spine, features, feed)
    changed = raw.read().filter("row_id <> 5").withColumn("age", F.when(F.col("row_id") == 7, 99).otherwise(F.col("age")))
    assert not feed.exists()
    feature_job(changed, spine, features, feed)
    return with_split(changed), spine.read(), features.read(), feed.read()


def test_feature_job(tables, tmp_path):
    raw, spine, features, feed = tables
    assert features.columns == ["row_id", *Roles().model_features] and "income_gt_50k" not in features.columns
    images = {r["_change_type"]: r["age"] for r in feed.filter("row_id = 7").collect()}
    assert set(images) == {"update_preimage", "update_postimage"} and images["update_postimage"] == 99 != images["update_preimage"]
    assert feed.filter("row_id = 5").first()["_change_type"] == "delete" and feed.count() == 3
    assert spine.filter("split = 'train'").count() == raw.filter("split = 'train'").count()


def test_check_and_profile_jobs(spark, tables, tmp_path):
    raw = tables[0]
    assert check_job(raw).filter("NOT passed").count() == 0
    with pytest.raises(GateError, match="min_rows"):
        check_job(raw, Config(limits=Limits(min_table_rows=10_000_000)))
    profile = VersionedTable(spark, str(tmp_path / "profile"))
    profile_job(raw, profile)
    rows = dict(profile.read().collect())
    assert rows["rows"] == str(raw.count()) and rows["dup_keys"] == "0" and rows["leakage_label_in_features"] == "false"


def test_alignment(tables):
    raw, spine, features, _ = tables
    check_alignment(raw, features, spine, "holdout")
    some = raw.filter("split = 'holdout'").first()["row_id"]
    with pytest.raises(GateError, match="features_complete"):
        check_alignment(raw, features.filter(F.col("row_id") != some), spine, "holdout")
    with pytest.raises(GateError, match="spine_rows_equal"):
        check_alignment(raw, features, spine.filter(F.col("row_id") != some), "holdout")
    with pytest.raises(GateError, match="feature contract"):
        check_alignment(raw, features.drop("age"), spine, "holdout")
    with pytest.raises(GateError, match="split_not_empty"):
        check_alignment(raw, features, spine, "absent")


def test_train_evaluate_compare(spark, tables, tmp_path):
    raw, spine, features, _ = tables
    small = Config(trees=TreeParams(trees=5, depth=3))
    model = train_job(raw, features, spine, small)
    scored = score_keys(spine.filter("split = 'holdout'"), features, model.score)
    low, high, n = scored.agg(F.min("score"), F.max("score"), F.count("score")).first()
    assert 0 <= low < high <= 1 and n == spine.filter("split = 'holdout'").count()
    metrics = evaluate_job(spark, raw, features, spine, model.score, "2", config=small)
    found = {r["metric"]: r["value"] for r in metrics.collect()}
    assert found["roc_auc"] > 0.9 and set(found) == {"roc_auc", "f1", "accuracy", "eval_rows", "positive_rate"}
    model.save(str(tmp_path / "model"))
    again = Model.load(spark, str(tmp_path / "model"))
    assert rows_of_frame(again.score(features)) == rows_of_frame(model.score(features))
    # Unseen categories and missing numbers still get a score.
    odd = features.withColumns({"sex": F.lit("unseen"), "age": F.lit(None).cast("bigint")})
    assert model.score(odd).filter("score IS NULL").count() == 0
    assert model.inputs == {} and again.inputs == {}
    weak = evaluate_job(spark, raw, features, spine, rule(CENSUS_SCORE_B), "1", config=small)
    assert compare_job(metrics, None).first()["first_version"]
    decision = compare_job(metrics, weak).first()
    assert decision["result"] == ("go" if decision["challenger"] >= decision["champion"] else "no-go")


def test_versions_are_evaluated_in_one_pass(spark, tables, tmp_path, monkeypatch):
    raw, spine, features, _ = tables
    stored = VersionedTable(spark, str(tmp_path / "features"), "row_id")
    stored.replace(features)
    seen = []
    monkeypatch.setattr(model_plans, "check_alignment", lambda *a, **k: seen.append(check_alignment(*a, **k)))
    scorers = {"3": rule(CENSUS_SCORE), "2": rule(CENSUS_SCORE_B), "1": rule("CAST(fnlwgt % 1000 AS DOUBLE) / 1000 + CAST(fnlwgt > 250000 AS INT)")}
    together = evaluate_versions(spark, raw, stored, spine, scorers)
    assert len(seen) == 1
    alone = [evaluate_job(spark, raw, features, spine, s, v) for v, s in scorers.items()]
    pairs = lambda *frames: sorted((r["model_version"], r["metric"], round(r["value"], 9)) for f in frames for r in f.collect())
    assert pairs(together) == pairs(*alone)
    inputs = json.loads(together.first()["inputs"])
    assert inputs == {"features": {"version": 1, "fingerprint": str(fingerprint_of(features))}}
    decision = compare_evaluated(together, "2", "3").first()
    assert decision["result"] == ("go" if decision["challenger"] >= decision["champion"] else "no-go")
    with pytest.raises(GateError, match="min_roc_auc"):
        evaluate_versions(spark, raw, features, spine, {"3": rule(CENSUS_SCORE), "0": rule("0.5D")})
    with pytest.raises(GateError, match="no_lost_rows"):
        evaluate_versions(spark, raw, features, spine, {"3": rule(CENSUS_SCORE), "0": rule("CASE WHEN row_id % 2 = 0 THEN 0.5D END")})


def test_a_model_knows_its_inputs(spark, tables, tmp_path):
    raw, spine, features, _ = tables
    stored = VersionedTable(spark, str(tmp_path / "features"), "row_id")
    stored.replace(features)
    model = train_job(raw, stored, spine, Config(trees=TreeParams(trees=2, depth=2)))
    assert model.inputs["features"] == {"version": 1, "fingerprint": str(fingerprint_of(features))}
    model.save(str(tmp_path / "model"))
    assert Model.load(spark, str(tmp_path / "model")).inputs == model.inputs


def test_a_column_of_many_categories_is_hashed(spark):
    rows = spark.range(3_000).select("id", (F.col("id") % 7).cast("double").alias("n"), F.concat(F.lit("c"), F.col("id")).alias("many"), (F.col("id") % 3).cast("string").alias("few"))
    encoder = fit_preprocessing(rows, ["n"], ["many", "few"], most=1_000, slots=64)
    stages = {type(s).__name__: s for s in encoder.pipeline.stages}
    assert stages["FeatureHasher"].getInputCols() == ["many"] and [len(x) for x in stages["StringIndexerModel"].labelsArray] == [3]
    out = encoder.transform(rows).select(vector_to_array("_features").alias("v"))
    assert out.filter(F.size("v") != 1 + 3 + 64).isEmpty()
    assert out.filter(F.aggregate(F.slice("v", 5, 64), F.lit(0.0), lambda a, x: a + x) != 1).isEmpty()
    assert many_valued(rows, ["many", "few"]) == [] and many_valued(rows, []) == []


def test_evaluation_is_refused(spark, tables, tmp_path):
    raw, spine, features, _ = tables
    with pytest.raises(GateError, match="min_roc_auc"):
        evaluate_job(spark, raw, features, spine, rule("0.5D"), "1")
    lost = rule("CASE WHEN row_id % 2 = 0 THEN 0.5D END")
    with pytest.raises(GateError, match="no_lost_rows"):
        evaluate_job(spark, raw, features, spine, lost, "1")
    log = str(tmp_path / "log")
    monitor_job(spark, features, None, log, "2024-01-01 00:00:00", "a")
    evaluate_job(spark, raw, features, spine, rule(CENSUS_SCORE), "1", read_log(spark, log))
    monitor_job(spark, features.limit(3), None, log, "2024-01-02 00:00:00", "b")
    with pytest.raises(GateError, match="feature rows 3 < 200"):
        evaluate_job(spark, raw, features, spine, rule(CENSUS_SCORE), "1", read_log(spark, log))
    assert latest_row(read_log(spark, log), ["as_of"]).first()["job_run_id"] == "b"


def test_smoke(tables):
    features = tables[2]
    assert smoke_job(features, rule(CENSUS_SCORE)).count() == 20
    with pytest.raises(GateError, match="smoke_parity"):
        smoke_job(features, rule("CASE WHEN row_id > 4 THEN 0.5D END"))


def test_training_reads_one_split_and_two_features(tables):
    _, spine, features, _ = tables
    rows = training_frame(spine, features, "train", columns=["age", "sex"])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    assert "ReadSchema: struct<row_id:bigint,age:bigint,sex:string>" in plan


def test_python_scorer_in_a_prediction_job(spark, tables, tmp_path):
    raw, _, features, _ = tables
    predictions = VersionedTable(spark, str(tmp_path / "p"), "row_id")
    scorer = lambda df: score_in_chunks(df, "row_id", ["age", "fnlwgt"], lambda chunk: chunk["age"] / 100)
    spine = label_spine(raw)
    assert holdout_metrics(spine, features, scorer, "1").first()["lost_rows"] == 0
    n = predict_job(raw, features, scorer, predictions, "1")
    assert n == raw.count() == predictions.read().filter("score IS NOT NULL").count()


def test_predictions(spark, tables, tmp_path):
    raw, _, features, _ = tables
    predictions = VersionedTable(spark, str(tmp_path / "predictions"), "row_id")
    twice = raw.unionByName(raw)
    n = predict_job(twice.filter("row_id <= 100"), features, rule(CENSUS_SCORE_B), predictions, "1", "2024-01-01 00:00:00")
    m = predict_job(twice.filter("row_id > 50"), features, rule(CENSUS_SCORE), predictions, "2", "2024-01-02 00:00:00")
    rows = predictions.read()
    assert n == 99 and m == raw.filter("row_id > 50").count()
    assert rows.count() == raw.count() == rows.select("row_id").distinct().count()
    assert {r[0] for r in rows.filter("row_id <= 50").select("model_version").distinct().collect()} == {"1"}
    assert rows.dtypes == [("row_id", "bigint"), ("score", "double"), ("scored_at", "timestamp"), ("model_version", "string")]
    with pytest.raises(LookupError, match="no raw key"):
        predict_job(raw.withColumn("row_id", -F.col("row_id")), features, rule(CENSUS_SCORE), predictions, "3")


def test_explain(spark, tables, tmp_path):
    _, spine, features, _ = tables
    importances = VersionedTable(spark, str(tmp_path / "importances"))
    explain_job(features, spine, rule(CENSUS_SCORE), importances, "4")
    rows = {r["feature"]: r["importance"] for r in importances.read().collect()}
    assert set(rows) == set(Roles().model_features)
    assert rows["fnlwgt"] == max(rows.values()) > 0.2 and rows["sex"] == 0.0
    explain_job(features, spine, rule("no_such_column"), importances, "5")
    error = importances.read().collect()
    assert [(r["feature"], r["importance"]) for r in error] == [("error", 0.0)] and "no_such_column" in error[0]["method"]


def test_holdout_metrics_keep_lost_rows_visible(tables):
    _, spine, features, _ = tables
    some = spine.filter("split = 'holdout'").first()["row_id"]
    row = holdout_metrics(spine, features.filter(F.col("row_id") != some), rule("age / 100D"), "1").first()
    assert row["lost_rows"] == 1


def test_stream_replay_changes_nothing(spark, tmp_path):
    schema = "k long, seq long, v string"
    arrive = lambda rows, n: spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"{n}"))
    state = VersionedTable(spark, str(tmp_path / "state"), "k")

    def run(checkpoint):
        stream = file_stream(spark, str(tmp_path / "in" / "*"), spark.createDataFrame([], schema).schema, files_per_batch=1)
        sync_rows(stream, state, ["seq"], str(tmp_path / checkpoint))
        return sorted(tuple(r) for r in state.read().collect())

    arrive([(1, 5, "new"), (1, 4, "older"), (2, 1, "x")], 0)
    assert run("c") == [(1, 5, "new"), (2, 1, "x")]
    arrive([(1, 3, "late"), (2, 2, "y"), (3, 1, "z")], 1)
    expected = [(1, 5, "new"), (2, 2, "y"), (3, 1, "z")]
    assert run("c") == expected
    version = state.version
    assert run("c") == expected and state.version == version
    # A lost checkpoint replays the same batches: their tags are known, so nothing is written again.
    assert run("other") == expected and state.version == version


def test_stream_of_changes(spark, tmp_path):
    target = VersionedTable(spark, str(tmp_path / "target"), "k")
    target.replace(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string"))
    changes = [(1, "delete", "a", 1), (2, "update_preimage", "b", 1), (2, "update_postimage", "B", 1), (4, "insert", "d", 1), (2, "update_postimage", "BB", 2)]
    feed = spark.createDataFrame(changes, "k int, _change_type string, v string, n int")
    feed.write.parquet(str(tmp_path / "feed"))
    sync_changes(file_stream(spark, str(tmp_path / "feed"), feed.schema), target, ["n"], str(tmp_path / "c"))
    assert sorted(tuple(r) for r in target.read().collect()) == [(2, "BB"), (3, "c"), (4, "d")]


def test_refresh(spark, tables, tmp_path):
    raw = tables[0].withColumn("day", F.lit(1))
    features, predictions = (VersionedTable(spark, str(tmp_path / n), "row_id") for n in ("features", "predictions"))
    arrived = str(tmp_path / "raw")

    def run():
        stream = file_stream(spark, arrived, raw.schema)
        refresh_features(stream, features, predictions, rule(CENSUS_SCORE), "1", ["day"], str(tmp_path / "c"), "2024-01-01 00:00:00")

    raw.filter("row_id <= 300").write.parquet(arrived)
    run()
    later = raw.filter("row_id BETWEEN 290 AND 400").withColumns({"day": F.lit(2), "age": F.lit(20).cast("bigint")})
    later.write.mode("append").parquet(arrived)
    run()
    assert features.read().count() == predictions.read().count() == 399
    # A day that arrives late changes neither features nor scores of the keys that had a later one.
    scores = rows_of(predictions)
    late = raw.filter("row_id BETWEEN 300 AND 401").withColumns({"day": F.lit(0), "age": F.lit(77).cast("bigint")})
    late.write.mode("append").parquet(arrived)
    run()
    assert [r["row_id"] for r in features.read().filter("age = 77").orderBy("row_id").collect()] == [401]
    assert [r for r in rows_of(predictions) if r[0] != 401] == scores and features.read().count() == 400
    assert features.read().filter("row_id = 295").first()["age"] == 20
    assert features.has_tag("refresh-2") and not features.has_tag("refresh-3")
    assert feature_frame(raw).columns == features.read().columns
    assert label_spine(raw).columns == ["row_id", "split", "income_gt_50k"]


@pytest.mark.parametrize("name, folder, batches", [("stream_refresh", "raw", 2), ("stream_sync", "arrived", 2)])
def test_streams_arrive_in_as_many_files_as_the_table_has_partitions(spark, tmp_path, monkeypatch, name, folder, batches):
    row = "id AS o_orderkey, id % 50 AS o_custkey, CASE id % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'O' ELSE 'P' END AS o_orderstatus"
    orders = spark.range(1200).selectExpr(*row.split(", ", 2), "200000e0 + id AS o_totalprice", "concat(1 + id % 5, '-X') AS o_orderpriority")
    orders.repartition(12).write.parquet(str(tmp_path / "orders.parquet"))
    events = spark.range(1200).selectExpr("id % 100 AS user_id", "id AS event_id", "'x' AS event_type", "id * 1e0 AS value", "timestamp_seconds(id) AS ts")
    events.repartition(12).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(streams, "scratch_path", lambda _, what: str(tmp_path / what))
    found = getattr(streams, name)(spark, str(tmp_path))
    assert found.count() == {"stream_refresh": 1200, "stream_sync": 100}[name]
    files = [p for p in (tmp_path / folder).glob("*.parquet") if spark.read.parquet(str(p)).count()]
    assert len(files) >= 5 * batches
    assert len([p for p in next(tmp_path.glob("*-checkpoint")).glob("commits/*") if p.name.isdigit()]) == batches
