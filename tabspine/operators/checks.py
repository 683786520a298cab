"""Fail-closed checks: each gives rows (check, passed, observed, bound, detail); :func:`require` raises on a failure."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabspine.config import Limits, Roles
from tabspine.functions.text import is_truthy
from tabspine.functions.times import job_time
from tabspine.operators.clean import missing_columns
from tabspine.operators.engineer import contract_violations
from tabspine.operators.status import latest_row


class GateError(RuntimeError):
    """A fail-closed check did not pass."""


def require(checks: DataFrame) -> None:
    """Raise naming every failed check."""
    failed = checks.filter(~F.coalesce(F.col("passed"), F.lit(False))).collect()
    if failed:
        raise GateError("; ".join(f"{r['check']}: observed {r['observed']}, {r['detail']}" for r in failed))


def _check(name: str, passed: Column, observed: Column, bound: float | None, detail: str) -> Column:
    return F.struct(
        F.lit(name).alias("check"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        observed.cast("double").alias("observed"),
        F.lit(bound).cast("double").alias("bound"),
        F.lit(detail).alias("detail"),
    )


def _rows(counts: DataFrame, checks: Sequence[Column]) -> DataFrame:
    """Check rows out of a one-row frame of counts."""
    return counts.select(F.inline(F.array(*checks)))


def schema_check(spark: SparkSession, name: str, problems: Sequence[str]) -> DataFrame:
    """A check on names and types, decided without reading data."""
    count = F.lit(float(len(problems)))
    return _rows(spark.range(1), [_check(name, F.lit(not problems), count, 0, ", ".join(problems))])


def require_schema(features: DataFrame, roles: Roles = Roles()) -> None:
    """Raise unless the feature table keeps its contract and holds no label; reads no data."""
    problems = contract_violations(features, roles)
    if roles.id_col not in features.columns:
        problems.append(f"{roles.id_col}: missing")
    if problems:
        raise GateError(f"feature contract: {', '.join(problems)}")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys with more than one row, and how many."""
    return df.groupBy(key).agg(F.count("*").alias("rows")).filter("rows > 1")


def key_check(df: DataFrame, key: str) -> DataFrame:
    """Key unique and not null."""
    counts = df.groupBy(key).agg(F.count("*").alias("rows")).filter((F.col("rows") > 1) | F.col(key).isNull())
    counts = counts.agg(F.count("*").alias("n"))
    return _rows(counts, [_check("key_unique", F.col("n") == 0, F.col("n"), 0, "duplicate keys")])


def null_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, null_rate) in one pass; null for an empty table."""
    rates = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
    return rates.unpivot([], list(columns), "column_name", "null_rate")


def table_checks(
    df: DataFrame, roles: Roles = Roles(), limits: Limits = Limits(), as_of: datetime | str | None = None
) -> DataFrame:
    """All checks on a raw table. Everything but the key check comes from one pass over the columns it needs."""
    required = [roles.id_col, *roles.features, roles.label_col]
    if roles.event_time_col:
        required.append(roles.event_time_col)
    schema = schema_check(df.sparkSession, "required_columns", missing_columns(df, required))
    if missing_columns(df, required):
        return schema
    label = F.col(roles.label_col)
    aggregates = [
        F.count("*").alias("rows"),
        F.avg(F.col(roles.id_col).isNull().cast("double")).alias("id_nulls"),
        F.avg(label.isNull().cast("double")).alias("label_nulls"),
        F.count_if(~label.isin(0, 1)).alias("not_binary"),
        F.count_if(label == 0).alias("zeros"),
        F.count_if(label == 1).alias("ones"),
    ]
    rate = limits.max_null_rate
    classes = (F.col("zeros") > 0).cast("int") + (F.col("ones") > 0).cast("int")
    checks = [
        _check("min_rows", F.col("rows") >= limits.min_table_rows, F.col("rows"), limits.min_table_rows, "rows"),
        _check("id_null_rate", F.col("id_nulls") <= rate, F.col("id_nulls"), rate, f"nulls in {roles.id_col}"),
        _check("label_null_rate", F.col("label_nulls") <= rate, F.col("label_nulls"), rate, f"nulls in {roles.label_col}"),
        _check("label_binary", F.col("not_binary") == 0, F.col("not_binary"), 0, "labels other than 0 and 1"),
        _check("both_classes", classes == 2, classes, 2, "classes present"),
    ]
    if roles.split_col in df.columns:
        for name in ("train", "holdout"):
            aggregates.append(F.count_if(F.col(roles.split_col) == name).alias(f"split_{name}"))
        splits = (F.col("split_train") > 0).cast("int") + (F.col("split_holdout") > 0).cast("int")
        checks.append(_check("both_splits", splits == 2, splits, 2, "splits present"))
    if roles.event_time_col:
        aggregates.append(F.count_if(F.col(roles.event_time_col) > job_time(as_of)).alias("future"))
        checks.append(_check("no_future_events", F.col("future") == 0, F.col("future"), 0, "event times in the future"))
    return schema.unionByName(_rows(df.agg(*aggregates), checks)).unionByName(key_check(df, roles.id_col))


def leakage_check(features: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Label absent from the feature table and from the feature list."""
    leaks = [roles.label_col] if roles.label_col in (*features.columns, *roles.model_features) else []
    return schema_check(features.sparkSession, "no_label_leakage", leaks)


def contract_check(features: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Feature names and types as contracted."""
    return schema_check(features.sparkSession, "feature_contract", contract_violations(features, roles))


def alignment_checks(counts: DataFrame) -> DataFrame:
    """Raw, feature table and spine line up, from the counts of ``alignment_counts``."""
    unmatched = F.col("raw_without_spine") + F.col("spine_without_raw")
    return _rows(
        counts,
        [
            _check("split_not_empty", F.col("raw_rows") >= 1, F.col("raw_rows"), 1, "raw rows in the split"),
            _check("features_complete", F.col("raw_without_features") == 0, F.col("raw_without_features"), 0,
                   "raw keys without features"),
            _check("spine_rows_equal", F.col("spine_rows") == F.col("raw_rows"), F.col("spine_rows") - F.col("raw_rows"), 0,
                   "spine rows more than raw rows"),
            _check("spine_keys_equal", unmatched == 0, unmatched, 0, "keys on one side only"),
        ],
    )


def evaluation_checks(metrics: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Gate on one row of metrics: rows, lost rows, defined metrics, minimum AUC."""
    names = ("roc_auc", "f1", "accuracy", "positive_rate")
    undefined = sum((F.coalesce(F.isnan(n), F.lit(True)) | F.col(n).isNull()).cast("int") for n in names)
    return _rows(
        metrics,
        [
            _check("min_eval_rows", F.col("eval_rows") >= limits.min_eval_rows, F.col("eval_rows"),
                   limits.min_eval_rows, "evaluated rows"),
            _check("no_lost_rows", F.col("lost_rows") == 0, F.col("lost_rows"), 0, "rows without label or score"),
            _check("metrics_defined", undefined == 0, undefined, 0, "undefined metrics"),
            _check("min_roc_auc", F.col("roc_auc") >= limits.min_roc_auc, F.col("roc_auc"), limits.min_roc_auc, "roc_auc"),
        ],
    )


def monitor_check(log: DataFrame | None, spark: SparkSession) -> DataFrame:
    """The latest monitor row must be ok; no log or an empty log passes."""
    if log is None:
        return schema_check(spark, "monitor_ok", [])
    latest = latest_row(log.withColumn("_bad", ~F.coalesce(is_truthy(F.col("gate_ok")), F.lit(False))), ["as_of", "_bad"]).agg(
        F.count("*").alias("n"), F.max(F.struct(is_truthy(F.col("gate_ok")).alias("ok"), "reason")).alias("row")
    )
    ok = (F.col("n") == 0) | F.col("row.ok")
    return latest.select(
        F.lit("monitor_ok").alias("check"),
        F.coalesce(ok, F.lit(False)).alias("passed"),
        F.when(ok, 0.0).otherwise(1.0).alias("observed"),
        F.lit(0.0).alias("bound"),
        F.coalesce(F.col("row.reason"), F.lit("")).alias("detail"),
    )


def smoke_check(requested: DataFrame, scored: DataFrame, key: str) -> DataFrame:
    """Scored rows equal requested keys."""
    rows = requested.select(F.lit(1).alias("asked"), F.lit(0).alias("got")).unionByName(
        scored.select(F.lit(0).alias("asked"), F.col(key).isNotNull().cast("int").alias("got"))
    )
    gap = F.coalesce(F.sum("asked"), F.lit(0)) - F.coalesce(F.sum("got"), F.lit(0))
    counts = rows.agg(gap.alias("gap"))
    return _rows(counts, [_check("smoke_parity", F.col("gap") == 0, F.col("gap"), 0, "keys without a score")])


def score_count_check(requests: DataFrame, scores: DataFrame, batch: str) -> DataFrame:
    """Per batch, requested and scored row counts and whether they agree."""
    asked = requests.select(batch, F.lit(1).alias("asked"), F.lit(0).alias("got"))
    got = scores.select(batch, F.lit(0).alias("asked"), F.lit(1).alias("got"))
    counts = asked.unionByName(got).groupBy(batch).agg(F.sum("asked").alias("requested"), F.sum("got").alias("scored"))
    return counts.withColumn("passed", F.col("requested") == F.col("scored"))


def monitor_status(
    features: DataFrame | None,
    predictions: DataFrame | None,
    roles: Roles = Roles(),
    limits: Limits = Limits(),
    as_of: datetime | str | None = None,
    job_run_id: str = "",
    spark: SparkSession | None = None,
) -> DataFrame:
    """One status row (as_of, gate_ok, reason, job_run_id). Missing or empty predictions are only a note."""
    session = spark or (features or predictions).sparkSession
    problems = ["feature table missing"] if features is None else []
    if features is not None:
        absent = missing_columns(features, roles.model_features)
        problems = [f"feature contract mismatch: {absent}"] if absent else []
    if problems:
        state = session.range(1).select(F.lit(False).alias("gate_ok"), F.lit(problems[0]).alias("reason"))
    else:
        counted = features.select(F.lit(1).alias("f"), F.lit(0).alias("p"))
        if predictions is not None:
            counted = counted.unionByName(predictions.select(F.lit(0).alias("f"), F.lit(1).alias("p")))
        n, least = F.col("n"), limits.min_table_rows
        note = F.lit("predictions table not created yet") if predictions is None else F.when(
            F.col("predicted") == 0, "predictions empty").otherwise("ok")
        few = F.concat(F.lit("feature rows "), n.cast("string"), F.lit(f" < {least}"))
        state = counted.agg(
            F.coalesce(F.sum("f"), F.lit(0)).alias("n"), F.coalesce(F.sum("p"), F.lit(0)).alias("predicted")
        ).select((n >= least).alias("gate_ok"), F.when(n >= least, note).otherwise(few).alias("reason"))
    return state.select(job_time(as_of).alias("as_of"), "gate_ok", "reason", F.lit(job_run_id).alias("job_run_id"))
