"""Profiles, metrics, gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from showcase.frames import (
    CENSUS,
    CENSUS_SQL,
    DOCUMENTS_SQL,
    FEATURES_SQL,
    census,
    labelled_documents,
    metrics_sql,
    rounded,
    table,
)
from showcase.registry import query
from tabspine.config import CATEGORICAL, NUMERIC, Config, Limits, Roles
from tabspine.operators.canary import canary_metrics
from tabspine.operators.checks import (
    contract_check,
    duplicate_keys,
    evaluation_checks,
    leakage_check,
    monitor_check,
    monitor_status,
    null_rates,
    schema_check,
    score_count_check,
    smoke_check,
    table_checks,
)
from tabspine.operators.clean import missing_columns
from tabspine.operators.compare import compare_versions
from tabspine.operators.engineer import feature_frame
from tabspine.operators.metrics import METRICS, class_balance, classification_metrics, long_metrics
from tabspine.operators.ordering import exact_medians
from tabspine.operators.profile import cardinality, distinct_values, modes, numeric_summary
from tabspine.plans.data import profile_job
from tabspine.plans.model import monitor_job
from tabspine.sources.scratch import scratch_path
from tabspine.sources.tables import VersionedTable, append_log, read_log

_NAMES = [c for c in CENSUS]


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


@query(
    "SELECT count(*) AS rows, count(*) FILTER (WHERE quality = 1) AS positives, count(*) FILTER (WHERE quality <> 1) AS negatives, "
    "round(avg(quality), 6) AS positive_rate, "
    "round(count(*) FILTER (WHERE quality = 0) / count(*) FILTER (WHERE quality = 1), 6) AS class_weight FROM labels"
)
def label_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(class_balance(table(spark, sf_dir, "labels"), "quality"))


@query("SELECT DISTINCT o_orderstatus FROM orders")
def status_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_values(table(spark, sf_dir, "orders"), "o_orderstatus")


_CARDINALITY = f"WITH {CENSUS_SQL} " + _union(
    [f"SELECT '{c}' AS column_name, count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS n_distinct FROM raw"
     for c in CATEGORICAL]
)


@query(_CARDINALITY)
def profile_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values per category, null counted as one."""
    return cardinality(census(spark, sf_dir), CATEGORICAL)


@query(
    f"WITH {CENSUS_SQL} " + _union(
        [f"SELECT '{c}' AS column_name, round(avg({c}), 6) AS mean, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max "
         "FROM raw" for c in NUMERIC])
)
def profile_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(numeric_summary(census(spark, sf_dir), NUMERIC))


@query(
    f"WITH {CENSUS_SQL} " + _union(
        [f"SELECT '{c}' AS column_name, round(avg(CASE WHEN {c} IS NULL THEN 1e0 ELSE 0e0 END), 6) AS null_rate FROM raw"
         for c in _NAMES])
)
def profile_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(null_rates(census(spark, sf_dir), _NAMES))


@query("SELECT l_orderkey, count(*) AS rows FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1")
def repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(table(spark, sf_dir, "lineitem"), "l_orderkey")


_PROFILE_TYPES = {c: "bigint" for c in CENSUS} | {c: "string" for c in (*CATEGORICAL, "split")} | {"income_gt_50k": "int"}


def _json_list(names: list[str] | tuple[str, ...]) -> str:
    return "[" + ",".join(f'"{n}"' for n in names) + "]"


def _profile_sql() -> str:
    doubles = "concat('\"{0}\":{{\"mean\":', avg({0}), ',\"min\":', CAST(min({0}) AS DOUBLE), ',\"max\":', CAST(max({0}) AS DOUBLE), '}}')"
    summary = ", ',', ".join(doubles.format(c) for c in NUMERIC)
    missing = ", ',', ".join(
        f"concat('\"{c}\":', avg(CASE WHEN {c} IS NULL THEN 1e0 ELSE 0e0 END))" for c in CENSUS
    )
    distinct = ", ',', ".join(
        f"concat('\"{c}\":', count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END))" for c in sorted(CATEGORICAL)
    )
    types = "{" + ",".join(f'"{c}":"{_PROFILE_TYPES[c]}"' for c in CENSUS) + "}"
    fixed = {
        "dtypes": types,
        "numeric": _json_list(NUMERIC),
        "categorical": _json_list(CATEGORICAL),
        "feature_cols": _json_list(NUMERIC + CATEGORICAL),
        "id_col": '"row_id"',
        "label_col": '"income_gt_50k"',
        "leakage_label_in_features": "false",
        "dataset": '"census income"',
        "target_definition": '"income_gt_50k is 1 if the class is >50K, 0 if it is <=50K"',
        "positive_class": '">50K"',
        "negative_class": '"<=50K"',
    }
    parts = [
        "SELECT 'rows' AS metric, CAST(count(*) AS VARCHAR) AS value FROM raw",
        "SELECT 'positives', CAST(sum(income_gt_50k) AS VARCHAR) FROM raw",
        "SELECT 'negatives', CAST(sum(1 - income_gt_50k) AS VARCHAR) FROM raw",
        "SELECT 'positive_rate', CAST(avg(income_gt_50k) AS VARCHAR) FROM raw",
        f"SELECT 'numeric_summary', concat('{{', {summary}, '}}') FROM raw",
        f"SELECT 'missingness', concat('{{', {missing}, '}}') FROM raw",
        f"SELECT 'categorical_cardinality', concat('{{', {distinct}, '}}') FROM raw",
        "SELECT 'dup_keys', CAST(count(*) AS VARCHAR) FROM (SELECT row_id FROM raw GROUP BY row_id HAVING count(*) > 1)",
    ] + [f"SELECT '{k}', '{v}'" for k, v in fixed.items()]
    return f"WITH {CENSUS_SQL} " + _union(parts)


@query(_profile_sql())
def eda_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole profile as (metric, JSON value) rows, stored and read back."""
    profile = VersionedTable(spark, scratch_path(spark, "profile"))
    profile_job(census(spark, sf_dir), profile)
    return profile.read()


_IMPUTE_SQL = f"WITH {CENSUS_SQL}, {FEATURES_SQL} " + _union(
    [f"SELECT '{c}' AS column_name, round(median(CAST({c} AS DOUBLE)), 6) AS median, CAST(NULL AS VARCHAR) AS mode FROM features"
     for c in (*NUMERIC, "capital_net", "hours_over_40", "log_fnlwgt", "education_num_sq")]
    + [f"SELECT '{c}', NULL, (SELECT {c} FROM raw WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
       for c in CATEGORICAL]
)


@query(_IMPUTE_SQL)
def impute_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact medians and most frequent values, smallest on ties."""
    roles = Roles()
    features = feature_frame(census(spark, sf_dir))
    medians = exact_medians(features, roles.model_numeric)
    found = [
        F.struct(F.lit(c).alias("column_name"), F.lit(v).alias("median"), F.lit(None).cast("string").alias("mode"))
        for c, v in medians.items()
    ]
    numeric = spark.range(1).select(F.inline(F.array(*found)))
    frequent = modes(features, roles.categorical).select("column_name", F.lit(None).cast("double").alias("median"), F.col("value").alias("mode"))
    return rounded(numeric.unionByName(frequent))


@query(
    "SELECT round(median(l_extendedprice), 6) AS price, round(median(l_quantity), 6) AS quantity, "
    "round(median(l_tax), 6) AS tax, round(median(l_partkey), 6) AS part FROM lineitem"
)
def medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact medians by bracketing: values spread thin, and values that fill the table."""
    columns = {"l_extendedprice": "price", "l_quantity": "quantity", "l_tax": "tax", "l_partkey": "part"}
    found = exact_medians(table(spark, sf_dir, "lineitem"), list(columns))
    return rounded(spark.range(1).select(*[F.lit(found[c]).alias(name) for c, name in columns.items()]))


_METRIC_COLUMNS = "round(roc_auc, 6) AS roc_auc, round(f1, 6) AS f1, round(accuracy, 6) AS accuracy, eval_rows, round(positive_rate, 6) AS positive_rate"


@query(f"WITH {DOCUMENTS_SQL} SELECT {_METRIC_COLUMNS} FROM ({metrics_sql('docs', 'quality', 'score')})")
def eval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AUC, f1, accuracy, rows and positive rate of a score."""
    scored = labelled_documents(spark, sf_dir)
    return rounded(classification_metrics(scored, "quality", "score").select(*METRICS))


@query(
    f"""WITH scored AS (SELECT l_returnflag AS flag, CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS label,
        l_extendedprice / 100000 AS score FROM lineitem)
    SELECT flag, {_METRIC_COLUMNS} FROM ({metrics_sql('scored', 'label', 'score', by='flag')})"""
)
def segment_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics by segment over many distinct scores, ranked in score ranges."""
    scored = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("flag"), (F.col("l_quantity") > 25).cast("int").alias("label"),
        (F.col("l_extendedprice") / 100000).alias("score"),
    )
    return rounded(classification_metrics(scored, "label", "score", ["flag"]).select("flag", *METRICS))


_GATES_SQL = f"""WITH {DOCUMENTS_SQL}, m AS ({metrics_sql('docs', 'quality', 'score')})
    SELECT 'min_eval_rows' AS "check", eval_rows >= 200 AS passed, CAST(eval_rows AS DOUBLE) AS observed, 200e0 AS bound, 'evaluated rows' AS detail FROM m
    UNION ALL SELECT 'no_lost_rows', true, 0, 0, 'rows without label or score' FROM m
    UNION ALL SELECT 'metrics_defined', true, 0, 0, 'undefined metrics' FROM m
    UNION ALL SELECT 'min_roc_auc', roc_auc >= 0.7, round(roc_auc, 6), 0.7, 'roc_auc' FROM m"""


@query(_GATES_SQL)
def eval_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation gate on the same metrics."""
    return rounded(evaluation_checks(classification_metrics(labelled_documents(spark, sf_dir), "quality", "score")))


def _compare_sql() -> str:
    return f"""WITH {DOCUMENTS_SQL}, c AS ({metrics_sql('docs', 'quality', 'score', by='lang')}),
    p AS ({metrics_sql('docs', 'quality', 'score_b', by='lang')})
    SELECT lang, 'roc_auc' AS metric, round(c.roc_auc, 6) AS challenger, round(p.roc_auc, 6) AS champion,
           CASE WHEN c.roc_auc IS NULL OR p.roc_auc IS NULL THEN 'error' WHEN c.roc_auc >= p.roc_auc + 0.01 THEN 'go' ELSE 'no-go' END AS result, false AS first_version
    FROM c JOIN p USING (lang)"""


@query(_compare_sql())
def compare_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Challenger against champion by language, with a margin."""
    scored = labelled_documents(spark, sf_dir)
    long = [
        long_metrics(classification_metrics(scored, "quality", s, ["lang"]), ["lang"]) for s in ("score", "score_b")
    ]
    return rounded(compare_versions(long[0], long[1], by=["lang"], margin=0.01))


_ARMS_SQL = f"""WITH {DOCUMENTS_SQL}, arms AS (
      SELECT quality, CASE WHEN new THEN '9' ELSE '7' END AS model_version, CASE WHEN new THEN score ELSE score_b END AS s
      FROM (SELECT *, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 30 AS new FROM docs))
    SELECT model_version, {_METRIC_COLUMNS} FROM ({metrics_sql('arms', 'quality', 's', by='model_version')})"""


@query(_ARMS_SQL)
def canary_arms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of the new and the previous version, 30% of the keys on the new one."""
    scored = labelled_documents(spark, sf_dir)
    by_arm = canary_metrics(scored, "doc_id", "quality", {"9": "score", "7": "score_b"}, "9", "7", 30)
    return rounded(by_arm.select("model_version", *METRICS))


@query(
    f"""WITH {CENSUS_SQL},
    c AS (SELECT count(*) AS n, count(DISTINCT income_gt_50k) AS classes,
                 count(DISTINCT split) FILTER (WHERE split IN ('train', 'holdout')) AS splits,
                 (SELECT count(*) FROM (SELECT row_id FROM raw GROUP BY row_id HAVING count(*) > 1)) AS dup FROM raw)
    SELECT 'required_columns' AS "check", true AS passed, 0e0 AS observed, 0e0 AS bound, '' AS detail
    UNION ALL SELECT 'min_rows', n >= 200, n, 200, 'rows' FROM c
    UNION ALL SELECT 'id_null_rate', true, 0, 0.4, 'nulls in row_id'
    UNION ALL SELECT 'label_null_rate', true, 0, 0.4, 'nulls in income_gt_50k'
    UNION ALL SELECT 'label_binary', true, 0, 0, 'labels other than 0 and 1'
    UNION ALL SELECT 'both_classes', classes = 2, classes, 2, 'classes present' FROM c
    UNION ALL SELECT 'both_splits', splits = 2, splits, 2, 'splits present' FROM c
    UNION ALL SELECT 'key_unique', dup = 0, dup, 0, 'duplicate keys' FROM c"""
)
def quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks on the raw table."""
    return table_checks(census(spark, sf_dir))


@query(
    """WITH c AS (SELECT count(*) AS n, count(*) FILTER (WHERE ts > TIMESTAMP '2024-01-20') AS future,
                 (SELECT count(*) FROM (SELECT user_id FROM events GROUP BY user_id HAVING count(*) > 1)) AS dup FROM events)
    SELECT 'required_columns' AS "check", true AS passed, 0e0 AS observed, 0e0 AS bound, '' AS detail
    UNION ALL SELECT 'min_rows', n >= 200, n, 200, 'rows' FROM c
    UNION ALL SELECT 'id_null_rate', true, 0, 0.4, 'nulls in user_id'
    UNION ALL SELECT 'label_null_rate', false, (SELECT round(avg(CASE WHEN event_type = 'view' THEN 0 ELSE 1 END), 6) FROM events), 0.4, 'nulls in seen'
    UNION ALL SELECT 'label_binary', true, 0, 0, 'labels other than 0 and 1'
    UNION ALL SELECT 'both_classes', false, 1, 2, 'classes present'
    UNION ALL SELECT 'no_future_events', future = 0, future, 0, 'event times in the future' FROM c
    UNION ALL SELECT 'key_unique', dup = 0, dup, 0, 'duplicate keys' FROM c"""
)
def failed_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks that fail: null labels, one class, repeated keys, events after the given time."""
    roles = Roles(id_col="user_id", label_col="seen", numeric=("value",), categorical=("event_type",), event_time_col="ts")
    events = table(spark, sf_dir, "events").withColumn("seen", F.when(F.col("event_type") == "view", 1))
    return rounded(table_checks(events, roles, as_of="2024-01-20 00:00:00"))


@query(
    """SELECT 'feature_contract' AS "check", false AS passed, 17e0 AS observed, 0e0 AS bound, (SELECT count(*) FROM documents) AS rows
    UNION ALL SELECT 'no_label_leakage', false, 1, 0, (SELECT count(*) FROM documents)
    UNION ALL SELECT 'required_columns', false, 2, 0, (SELECT count(*) FROM documents)"""
)
def contract_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema-level checks on a feature table that breaks them: names, types, leaked label."""
    broken = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("row_id"), F.col("lang").alias("age"), F.col("source").alias("workclass"),
        F.lit("F").alias("sex"), F.lit(1).alias("income_gt_50k"),
    )
    absent = missing_columns(broken, ["row_id", "split", "event_time"])
    checks = (
        contract_check(broken)
        .unionByName(leakage_check(broken))
        .unionByName(schema_check(spark, "required_columns", absent))
    )
    rows = broken.agg(F.count("*").alias("rows")).scalar()
    return checks.drop("detail").withColumn("rows", rows)


@query(
    """SELECT event_type AS batch, count(*) AS requested, count(*) FILTER (WHERE event_type <> 'view' OR value >= 2) AS scored,
       event_type <> 'view' AS passed FROM events GROUP BY event_type"""
)
def score_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested and scored rows by batch; one batch lost some."""
    events = table(spark, sf_dir, "events").select(F.col("event_type").alias("batch"), "event_id", "value")
    return score_count_check(events, events.filter("batch <> 'view' OR value >= 2"), "batch")


@query(
    """SELECT 'smoke_parity' AS "check", false AS passed, CAST(count(*) FILTER (WHERE o_orderstatus = 'P') AS DOUBLE) AS observed, 0e0 AS bound,
       'keys without a score' AS detail FROM orders"""
)
def smoke_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return smoke_check(keys, keys.filter("o_orderstatus <> 'P'"), "o_orderkey")


@query(
    """WITH f AS (SELECT (SELECT count(*) FROM orders) AS n)
    SELECT '2024-01-01' AS as_of, n >= 200 AS gate_ok, 'predictions table not created yet' AS reason, 'a' AS job_run_id, CAST(NULL AS VARCHAR) AS note FROM f
    UNION ALL SELECT '2024-01-02', true, 'predictions empty', 'b', NULL FROM f
    UNION ALL SELECT '2024-01-03', true, 'ok', 'c', NULL FROM f
    UNION ALL SELECT '2024-01-04', false, concat('feature rows ', n, ' < 100000000'), 'd', 'late' FROM f
    UNION ALL SELECT '2024-01-05', false, 'feature table missing', 'e', 'late' FROM f"""
)
def monitor_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status rows appended by five monitor runs, the later ones with a new column."""
    features = feature_frame(census(spark, sf_dir))
    path = scratch_path(spark, "monitor")
    monitor_job(spark, features, None, path, "2024-01-01 00:00:00", "a")
    monitor_job(spark, features, features.filter("age < 0"), path, "2024-01-02 00:00:00", "b")
    monitor_job(spark, features, features, path, "2024-01-03 00:00:00", "c")
    strict = Config(limits=Limits(min_table_rows=100_000_000))
    for day, tag, frame in (("04", "d", features), ("05", "e", None)):
        status = monitor_status(frame, None, Roles(), strict.limits, f"2024-01-{day} 00:00:00", tag, spark)
        append_log(status.withColumn("note", F.lit("late")), path)
    return read_log(spark, path).withColumn("as_of", F.date_format("as_of", "yyyy-MM-dd"))


@query(
    """SELECT 'monitor_ok' AS "check", event_type <> 'error' AS passed, CASE WHEN event_type <> 'error' THEN 0e0 ELSE 1e0 END AS observed, 0e0 AS bound,
       event_type AS detail FROM events ORDER BY ts DESC, event_id DESC LIMIT 1"""
)
def monitor_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest status row decides."""
    log = table(spark, sf_dir, "events").select(
        F.col("ts").alias("as_of"), (F.col("event_type") != "error").alias("gate_ok"), F.col("event_type").alias("reason")
    )
    return monitor_check(log, spark)
