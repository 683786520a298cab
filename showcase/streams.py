"""Triggered streams run to completion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from showcase.frames import CENSUS_SCORE, CENSUS_SQL, FEATURES_SQL, census, table
from showcase.models import census_scorer
from showcase.registry import query
from tabspine.operators.upsert import change_feed
from tabspine.plans.data import feature_job
from tabspine.sources.changelog import ChangeLog
from tabspine.sources.scratch import scratch_path
from tabspine.sources.tables import VersionedTable
from tabspine.streaming.sync import file_stream, refresh_features, sync_changes, sync_rows


def _arrive(rows: DataFrame, path: str) -> None:
    """More files for a stream, as many as the rows have partitions, so that tasks do not grow with the table."""
    rows.write.mode("append").parquet(path)


@query(
    "SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id "
    "ORDER BY ts DESC, event_id DESC) = 1"
)
def stream_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events arriving in two batches keep the newest row of each user up to date."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", "ts")
    arrived, checkpoint = scratch_path(spark, "arrived"), scratch_path(spark, "sync-checkpoint")
    state = VersionedTable(spark, scratch_path(spark, "state"), "user_id")
    for half in (0, 1):
        _arrive(events.filter(F.pmod(F.xxhash64("event_id"), F.lit(2)) == half), arrived)
        sync_rows(file_stream(spark, arrived, events.schema), state, ["ts", "event_id"], checkpoint)
    return state.read().drop("ts")


@query(
    "SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderpriority = '2-HIGH' THEN 'changed' ELSE o_orderpriority END AS o_orderpriority "
    "FROM orders WHERE o_orderstatus <> 'F'"
)
def stream_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change feed streamed into the old snapshot gives the new one."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    priority = F.col("o_orderpriority")
    before = orders.filter("o_orderstatus <> 'P'")
    after = orders.filter("o_orderstatus <> 'F'").withColumn(
        "o_orderpriority", F.when(priority == "2-HIGH", "changed").otherwise(priority)
    )
    feed = change_feed(before, after, "o_orderkey").withColumn("_version", F.lit(2))
    arrived = scratch_path(spark, "feed")
    _arrive(feed, arrived)
    target = VersionedTable(spark, scratch_path(spark, "target"), "o_orderkey")
    target.replace(before)
    stream = file_stream(spark, arrived, feed.schema)
    sync_changes(stream, target, ["_version"], scratch_path(spark, "changes-checkpoint"))
    return target.read()


@query(
    f"""WITH {CENSUS_SQL}, {FEATURES_SQL}
    SELECT row_id, CASE WHEN row_id % 5 = 0 THEN 99 ELSE age END AS age, capital_net,
           CASE WHEN education = 'P' THEN 3 WHEN row_id % 5 = 0 THEN 2 ELSE 1 END AS _commit_version FROM features WHERE education <> 'F'"""
)
def logged_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three feature jobs log their changes; the log alone takes a copy of the first version to the third, a version a batch."""
    raw = census(spark, sf_dir)
    older = raw.withColumn("age", F.when(F.col("row_id") % 5 == 0, 99).otherwise(F.col("age")))
    spine, features, copy = (VersionedTable(spark, scratch_path(spark, n), "row_id") for n in ("spine", "features", "copy"))
    feed = ChangeLog(spark, scratch_path(spark, "feature-log"), "row_id")
    for rows in (raw.filter("education <> 'P'"), older.filter("education = 'O'"), older.filter("education <> 'F'")):
        feature_job(rows, spine, features, feed)
    copy.replace(features.read(1).withColumn("_commit_version", F.lit(1).cast("long")))
    sync_changes(feed.stream(), copy, ["_commit_version"], scratch_path(spark, "log-checkpoint"))
    return copy.read().select("row_id", "age", "capital_net", "_commit_version")


@query(
    f"""WITH {CENSUS_SQL.replace("o_custkey * 7", "o_custkey * 7 + CASE WHEN o_orderkey % 3 = 0 THEN 9 ELSE 1 END")}, {FEATURES_SQL}
    SELECT row_id, capital_net, hours_over_40, {CENSUS_SCORE} AS score, '5' AS model_version FROM features"""
)
def stream_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New raw rows become features and predictions, batch by batch. Rows of day 1 arrive after a third of the keys had theirs of day 9."""
    raw = census(spark, sf_dir)
    arrived, checkpoint = scratch_path(spark, "raw"), scratch_path(spark, "refresh-checkpoint")
    features = VersionedTable(spark, scratch_path(spark, "features"), "row_id")
    predictions = VersionedTable(spark, scratch_path(spark, "predictions"), "row_id")
    for day, some in ((9, "row_id % 3 = 1"), (1, "true")):  # a key is one more than the order's
        gain = F.when((F.col("row_id") - 1) % 11 == 0, F.col("capital_gain") + day).otherwise(F.col("capital_gain"))
        late = raw.filter(some).withColumns({"capital_gain": gain, "day": F.lit(day)})
        _arrive(late, arrived)
        stream = file_stream(spark, arrived, late.schema)
        refresh_features(
            stream, features, predictions, census_scorer(CENSUS_SCORE), "5", ["day"], checkpoint, "2024-01-01 00:00:00"
        )
    renewed = predictions.read().drop("scored_at")
    return features.read().select("row_id", "capital_net", "hours_over_40").join(renewed, "row_id")
