"""Plan shapes: no single-task windows over rows, pruned and pushed-down scans, no Python where built-ins do."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from showcase.frames import census, table
from tabspine.operators.engineer import feature_frame
from tabspine.operators.metrics import classification_metrics
from tabspine.operators.ordering import chronological_split, global_row_number
from tabspine.operators.payloads import score_rows
from tabspine.operators.profile import table_profile
from tabspine.operators.spine import as_of_lookup, training_frame
from tabspine.operators.status import latest_rows
from tabspine.operators.upsert import change_feed, upsert_rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges_of(node, column):
    """Shuffles of a column in a physical plan."""
    own = node.getClass().getSimpleName() == "ShuffleExchangeExec" and any(
        column in node.output().apply(i).name() for i in range(node.output().size()))
    children = node.children()
    return own + sum(exchanges_of(children.apply(i), column) for i in range(children.size()))


def test_split_needs_no_shuffle(spark, sf_dir):
    text = plan(chronological_split(table(spark, sf_dir, "events"), "ts", "event_id"))
    assert "Exchange" not in text and "Window" not in text


def test_row_number_has_no_single_task_window_over_rows(spark, sf_dir):
    text = plan(global_row_number(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"]))
    windows = re.findall(r"Window.*", text)
    assert len(windows) == 1 and "_range" in windows[0]


def test_latest_rows_limits_before_the_shuffle(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id")
    text = plan(latest_rows(events, ["user_id"], ["ts", "event_id"]))
    below = text[text.index("Exchange") :]
    assert "WindowGroupLimit" in below


def test_scores_are_combined_before_they_are_ordered(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select((F.col("l_quantity") > 25).cast("int").alias("y"), F.col("l_tax").alias("s"))
    text = plan(classification_metrics(lines, "y", "s", rows_per_bucket=500))
    assert "partial_count" in text and "SinglePartition" not in text[text.rindex("Window [") :]
    assert "BroadcastNestedLoop" not in text and "Cartesian" not in text


def test_training_scan_is_pruned_and_filtered(spark, sf_dir):
    raw = census(spark, sf_dir)
    text = plan(training_frame(raw, feature_frame(raw), "train", columns=["age", "capital_net"]))
    assert "PushedFilters: [" in text
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert len(schemas) == 2 and all("o_orderpriority" not in s and "o_orderdate" not in s for s in schemas)


def test_profile_reads_few_times(spark, sf_dir):
    assert plan(table_profile(census(spark, sf_dir))).count("FileScan") <= 4


def test_small_upsert_does_not_shuffle_the_target(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    text = plan(upsert_rows(orders, orders.filter("o_orderkey < 10"), "o_orderkey"))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_change_feed_is_one_join(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    assert len(re.findall(r"Join", plan(change_feed(orders, orders.filter("o_orderkey > 9"), "o_orderkey")))) == 1


def test_as_of_windows_are_keyed(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    spine = events.select("event_id", "user_id", "ts")
    text = plan(as_of_lookup(spine, events.select("user_id", F.col("ts").alias("at"), "value"), "user_id", "ts", "at", ["value"], 100))
    assert "SinglePartition" not in text and "Python" not in text
    # Whole spine rows are shuffled once; what else is shuffled has neither ids nor rows.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        wide = spine.withColumns({f"c{i}": F.col("event_id") + i for i in range(5)})
        found = as_of_lookup(wide, events.select("user_id", F.col("ts").alias("at"), "value"), "user_id", "ts", "at", ["value"], 100)
        tree = found._jdf.queryExecution().executedPlan()
        assert exchanges_of(tree.initialPlan(), "_row") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_payload_stages_are_evaluated_once(spark):
    payloads = spark.range(9).select("id", F.lit("[[0.1, 0.2], 0.3]").alias("p"))
    text = plan(score_rows(payloads, "id", "p"))
    assert "Filter" not in text and text.count("try_parse_json") <= 1


@pytest.mark.parametrize("module", ["clean", "engineer", "spine", "upsert", "status", "profile", "canary", "compare", "fingerprint", "importance"])
def test_operators_do_not_pull_rows_to_the_driver(module):
    with open(f"tabspine/operators/{module}.py") as source:
        text = source.read()
    assert "toPandas" not in text and "localCheckpoint" not in text and "crossJoin" not in text
    assert text.count(".collect()") <= (1 if module == "clean" else 0)
