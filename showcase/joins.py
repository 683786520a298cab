"""Lookup joins, alignment, upsert, change feed, latest rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from showcase.frames import CENSUS_SQL, FEATURES_SQL, census, rounded, table
from showcase.registry import query
from tabspine.operators.checks import alignment_checks
from tabspine.operators.engineer import feature_frame
from tabspine.operators.scoring import prediction_rows
from tabspine.operators.spine import (
    alignment_counts,
    as_of_lookup,
    distinct_keys,
    lookup_features,
    missing_keys,
    prediction_inputs,
    training_frame,
)
from tabspine.operators.status import latest_row, latest_rows, latest_version
from tabspine.operators.upsert import apply_changes, change_feed, upsert_rows


@query("SELECT doc_id, quality, lang, source, n_chars FROM labels LEFT JOIN documents USING (doc_id)")
def feature_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label spine with looked-up document features."""
    spine = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return lookup_features(spine, table(spark, sf_dir, "documents"), "doc_id", ["lang", "source", "n_chars"])


@query(
    f"WITH {CENSUS_SQL}, {FEATURES_SQL} SELECT income_gt_50k, f.* EXCLUDE (row_id) REPLACE (round(log_fnlwgt, 6) AS log_fnlwgt) "
    "FROM raw LEFT JOIN features f USING (row_id) WHERE split = 'train'"
)
def training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label and all model features of the train split, key dropped."""
    raw = census(spark, sf_dir)
    return rounded(training_frame(raw, feature_frame(raw), "train"))


@query(
    "SELECT o_orderkey, o_custkey, o_totalprice FROM (SELECT DISTINCT l_orderkey AS o_orderkey FROM lineitem) "
    "JOIN orders USING (o_orderkey)"
)
def predict_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of the distinct keys of a table in which keys repeat."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return prediction_inputs(lines, table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey")


@query("SELECT DISTINCT l_partkey FROM lineitem")
def dedup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_keys(table(spark, sf_dir, "lineitem"), "l_partkey")


@query("SELECT doc_id FROM documents WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)")
def keys_without_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_keys(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")


_ALIGNED = f"""WITH {CENSUS_SQL},
    feat AS (SELECT row_id FROM raw WHERE workclass IS NOT NULL),
    spine AS (SELECT row_id FROM raw WHERE split = 'holdout' AND native_country <> 'c7'),
    held AS (SELECT row_id FROM raw WHERE split = 'holdout'),
    counts AS (SELECT (SELECT count(*) FROM held) AS raw_rows, (SELECT count(*) FROM spine) AS spine_rows,
                      (SELECT count(*) FROM held ANTI JOIN feat USING (row_id)) AS no_features,
                      (SELECT count(*) FROM held ANTI JOIN spine USING (row_id)) AS no_spine,
                      (SELECT count(*) FROM spine ANTI JOIN held USING (row_id)) AS no_raw)
    SELECT 'split_not_empty' AS "check", raw_rows >= 1 AS passed, CAST(raw_rows AS DOUBLE) AS observed, 1e0 AS bound,
           'raw rows in the split' AS detail FROM counts
    UNION ALL SELECT 'features_complete', no_features = 0, no_features, 0, 'raw keys without features' FROM counts
    UNION ALL SELECT 'spine_rows_equal', spine_rows = raw_rows, spine_rows - raw_rows, 0, 'spine rows more than raw rows' FROM counts
    UNION ALL SELECT 'spine_keys_equal', no_spine + no_raw = 0, no_spine + no_raw, 0, 'keys on one side only' FROM counts"""


@query(_ALIGNED)
def spine_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of raw, feature table and spine for the holdout, with gaps in both of the latter."""
    raw = census(spark, sf_dir)
    features = raw.filter("workclass IS NOT NULL")
    spine = raw.filter("native_country <> 'c7'")
    return alignment_checks(alignment_counts(raw, features, spine, "holdout"))


@query(
    "SELECT e.event_id, e.user_id, p.value AS last_purchase FROM events e ASOF LEFT JOIN "
    "(SELECT user_id, ts, value FROM events WHERE event_type = 'purchase') p ON e.user_id = p.user_id AND e.ts >= p.ts"
)
def as_of_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with its user's latest purchase value known at that time."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    purchases = table(spark, sf_dir, "events").filter("event_type = 'purchase'").select(
        "user_id", F.col("ts").alias("at"), F.col("value").alias("last_purchase")
    )
    found = as_of_lookup(events, purchases, "user_id", "ts", "at", ["last_purchase"])
    return found.drop("ts")


@query(
    """WITH old AS (SELECT o_orderkey, o_totalprice / 1000 AS score, '1' AS model_version FROM orders WHERE o_orderstatus <> 'P'),
    new AS (SELECT o_orderkey, o_totalprice / 2000 AS score, '2' AS model_version FROM orders WHERE o_orderstatus <> 'F')
    SELECT o_orderkey, round(score, 6) AS score, '2024-01-02' AS scored_on, model_version FROM new
    UNION ALL SELECT o_orderkey, round(score, 6), '2024-01-01', model_version FROM old ANTI JOIN new USING (o_orderkey)"""
)
def upsert_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping prediction batches over all orders; the later one wins where keys match."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    first = orders.filter("o_orderstatus <> 'P'").withColumn("score", F.col("o_totalprice") / 1000)
    second = orders.filter("o_orderstatus <> 'F'").withColumn("score", F.col("o_totalprice") / 2000)
    merged = upsert_rows(
        prediction_rows(first, "o_orderkey", "1", "2024-01-01 00:00:00"),
        prediction_rows(second, "o_orderkey", "2", "2024-01-02 00:00:00"),
        "o_orderkey",
    )
    return rounded(merged).select(
        "o_orderkey", "score", F.date_format("scored_at", "yyyy-MM-dd").alias("scored_on"), "model_version"
    )


# The old snapshot lacks one order status and the new one another; two priorities change their price.
_SNAPSHOTS = """before AS (SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders WHERE o_orderstatus <> 'P'),
    after AS (SELECT o_orderkey, o_orderpriority, CASE o_orderpriority WHEN '5-LOW' THEN NULL WHEN '2-HIGH' THEN o_totalprice + 1
              ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderstatus <> 'F')"""


def _snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice", "o_orderstatus")
    price, priority = F.col("o_totalprice"), F.col("o_orderpriority")
    changed = F.when(priority == "5-LOW", None).when(priority == "2-HIGH", price + 1).otherwise(price)
    before = orders.filter("o_orderstatus <> 'P'").drop("o_orderstatus")
    after = orders.filter("o_orderstatus <> 'F'").drop("o_orderstatus").withColumn("o_totalprice", changed)
    return before, after


@query(
    f"""WITH {_SNAPSHOTS}, both_sides AS (
      SELECT coalesce(b.o_orderkey, a.o_orderkey) AS o_orderkey, b.o_orderkey AS bk, a.o_orderkey AS ak, b.o_orderpriority AS bs,
             a.o_orderpriority AS "as", b.o_totalprice AS bp, a.o_totalprice AS ap
      FROM before b FULL JOIN after a ON b.o_orderkey = a.o_orderkey
      WHERE b.o_orderkey IS DISTINCT FROM a.o_orderkey OR b.o_orderpriority IS DISTINCT FROM a.o_orderpriority
            OR b.o_totalprice IS DISTINCT FROM a.o_totalprice)
    SELECT o_orderkey, CASE WHEN bk IS NULL THEN 'insert' ELSE 'update_postimage' END AS _change_type, "as" AS o_orderpriority,
           round(ap, 6) AS o_totalprice FROM both_sides WHERE ak IS NOT NULL
    UNION ALL SELECT o_orderkey, CASE WHEN ak IS NULL THEN 'delete' ELSE 'update_preimage' END, bs, round(bp, 6)
    FROM both_sides WHERE bk IS NOT NULL"""
)
def snapshot_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change feed between two snapshots."""
    before, after = _snapshots(spark, sf_dir)
    return rounded(change_feed(before, after, "o_orderkey"))


@query(f"WITH {_SNAPSHOTS} SELECT o_orderkey, o_orderpriority, round(o_totalprice, 6) AS o_totalprice FROM after")
def applied_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change feed applied to the old snapshot gives the new one."""
    before, after = _snapshots(spark, sf_dir)
    return rounded(apply_changes(before, change_feed(before, after, "o_orderkey"), "o_orderkey"))


@query(
    "SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id "
    "ORDER BY ts DESC, event_id DESC) = 1"
)
def latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest event of each user."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return latest_rows(events, ["user_id"], ["ts", "event_id"]).drop("ts")


@query("SELECT event_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def newest_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    return latest_row(events, ["ts", "event_id"]).drop("ts")


@query(
    "SELECT event_type, CAST(max(CAST(regexp_extract(props, '[0-9]+') AS BIGINT)) AS VARCHAR) AS version FROM events GROUP BY event_type"
)
def newest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event type, the version text with the greatest number."""
    version = F.regexp_extract("props", "[0-9]+", 0).alias("version")
    return latest_version(table(spark, sf_dir, "events").select("event_type", version), ["event_type"], "version")
