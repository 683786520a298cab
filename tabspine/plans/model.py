"""Train, evaluate, compare, predict, explain and monitor jobs."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import replace
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabspine.config import Config
from tabspine.operators.checks import (
    alignment_checks,
    evaluation_checks,
    key_check,
    monitor_check,
    monitor_status,
    require,
    require_schema,
    smoke_check,
)
from tabspine.operators.compare import compare_versions
from tabspine.operators.importance import importance_table, permutation_importance
from tabspine.operators.metrics import classification_metrics, long_metrics
from tabspine.operators.ordering import first_by_key
from tabspine.operators.scoring import Model, prediction_rows, train_trees
from tabspine.operators.spine import (
    alignment_counts,
    labelled_scores,
    lookup_features,
    prediction_inputs,
    training_frame,
)
from tabspine.sources.scratch import materialize
from tabspine.sources.tables import VersionedTable, append_log

# Takes a frame of keys and features, gives at least the key and ``score``. For explaining it must keep all columns.
Scorer = Callable[[DataFrame], DataFrame]
Table = DataFrame | VersionedTable


def check_alignment(
    raw: DataFrame, features: DataFrame, spine: DataFrame, split: str, config: Config = Config()
) -> DataFrame:
    """Raise unless raw table, feature table and spine line up for the split; returns the check rows."""
    require_schema(features, config.roles)
    checks = alignment_checks(alignment_counts(raw, features, spine, split, config.roles))
    require(checks)
    return checks


def pinned(*tables: Table) -> list[DataFrame]:
    """Frames of tables; of versioned ones the version that is current now, whatever is written meanwhile."""
    return [t.read(t.version) if isinstance(t, VersionedTable) else t for t in tables]


def input_versions(**tables: Table) -> dict[str, dict]:
    """Version and fingerprint of each versioned table."""
    return {
        name: {"version": t.version, "fingerprint": str(t.fingerprint())} for name, t in tables.items() if isinstance(t, VersionedTable)
    }


def train_job(raw: Table, features: Table, spine: Table, config: Config = Config()) -> Model:
    """Fit trees on the train split. The looked-up rows are written once, since fitting reads them many times.

    The model knows the versions and fingerprints of the versioned tables it was fitted on.
    """
    roles = config.roles
    inputs = input_versions(raw=raw, features=features, spine=spine)
    raw, features, spine = pinned(raw, features, spine)
    check_alignment(raw, features, spine, "train", config)
    rows = materialize(training_frame(spine, features, "train", roles), "training")
    model = train_trees(rows, roles.label_col, roles.model_numeric, roles.categorical, config.trees)
    return replace(model, inputs=inputs)


def score_keys(keys: DataFrame, features: DataFrame, scorer: Scorer, config: Config = Config()) -> DataFrame:
    """(key, score) of looked-up features."""
    roles = config.roles
    found = lookup_features(keys.select(roles.id_col), features, roles.id_col, roles.model_features)
    return scorer(found).select(roles.id_col, "score")


def smoke_job(features: DataFrame, scorer: Scorer, rows: int = 20, config: Config = Config()) -> DataFrame:
    """Score the first few keys of the feature table; raise unless each got a score."""
    key = config.roles.id_col
    keys = first_by_key(features, key, rows)
    scored = materialize(score_keys(keys, features, scorer, config), "smoke")
    require(smoke_check(keys, scored.filter(F.col("score").isNotNull()), key))
    return scored


def version_metrics(spine: DataFrame, features: DataFrame, scorers: Mapping[str, Scorer], config: Config = Config()) -> DataFrame:
    """One row of holdout metrics for each model version, all out of one lookup and one join with the labels.

    The looked-up features are written once for all scorers. Labels are joined to the scores afterwards, so no scorer ever sees them, and a
    score that got lost on the way shows up as a lost row of its version.
    """
    roles = config.roles
    key, version = roles.id_col, F.col("model_version")
    labels = spine.filter(F.col(roles.split_col) == "holdout").select(key, roles.label_col)
    found = lookup_features(labels.select(key), features, key, roles.model_features)
    if len(scorers) > 1:
        found = materialize(found, "holdout-features")
    scored = [s(found).select(key, F.lit(v).alias("model_version"), F.col("score").cast("double").alias("score")) for v, s in scorers.items()]
    asked = labels.withColumn("model_version", F.explode(F.array(*map(F.lit, scorers))))
    joined = asked.join(reduce(DataFrame.unionByName, scored), [key, "model_version"], "left")
    stored = materialize(joined.select(version, roles.label_col, "score"), "holdout-scores")
    return classification_metrics(stored, roles.label_col, "score", ["model_version"], config.limits.threshold)


def holdout_metrics(
    spine: DataFrame, features: DataFrame, scorer: Scorer, model_version: str, config: Config = Config()
) -> DataFrame:
    """One row of holdout metrics of a model version."""
    return version_metrics(spine, features, {model_version: scorer}, config)


def evaluate_versions(
    spark: SparkSession,
    raw: Table,
    features: Table,
    spine: Table,
    scorers: Mapping[str, Scorer],
    monitor_log: DataFrame | None = None,
    config: Config = Config(),
) -> DataFrame:
    """Monitor gate, one alignment, holdout metrics of all versions, evaluation gates; returns (model_version, metric, value) rows.

    Of versioned tables, ``inputs`` tells the versions and fingerprints as JSON.
    """
    if monitor_log is not None:
        require(monitor_check(monitor_log, spark))
    inputs = input_versions(raw=raw, features=features, spine=spine)
    raw, features, spine = pinned(raw, features, spine)
    check_alignment(raw, features, spine, "holdout", config)
    metrics = materialize(version_metrics(spine, features, scorers, config), "metrics")
    for version in scorers:
        own = metrics.filter(F.col("model_version") == version)
        # A holdout without rows gives none for a version, and none would pass any gate.
        require(evaluation_checks(own if not own.isEmpty() else _no_rows(metrics), config.limits))
    rows = long_metrics(metrics, ["model_version"])
    return rows.withColumn("inputs", F.lit(json.dumps(inputs))) if inputs else rows


def _no_rows(metrics: DataFrame) -> DataFrame:
    return metrics.sparkSession.range(1).select(*[F.lit(0 if n.endswith("rows") else None).cast(t).alias(n) for n, t in metrics.dtypes])


def evaluate_job(
    spark: SparkSession,
    raw: Table,
    features: Table,
    spine: Table,
    scorer: Scorer,
    model_version: str,
    monitor_log: DataFrame | None = None,
    config: Config = Config(),
) -> DataFrame:
    """:func:`evaluate_versions` of one version."""
    return evaluate_versions(spark, raw, features, spine, {model_version: scorer}, monitor_log, config)


def compare_evaluated(metrics: DataFrame, challenger: str, champion: str | None, config: Config = Config()) -> DataFrame:
    """Decision row between two versions that were evaluated together."""
    rows = {v: metrics.filter(F.col("model_version") == v) for v in (challenger, champion) if v is not None}
    return compare_job(rows[challenger], rows.get(champion), config)


def compare_job(challenger: DataFrame, champion: DataFrame | None, config: Config = Config()) -> DataFrame:
    """Decision row on the configured metric; inputs are (model_version, metric, value) rows."""
    limits = config.limits
    old = champion.drop("model_version", "inputs") if champion is not None else None
    return compare_versions(
        challenger.drop("model_version", "inputs"), old, limits.compare_metric,
        higher_is_better=limits.higher_is_better, margin=limits.compare_margin,
    )


def predict_job(
    raw: DataFrame,
    features: DataFrame,
    scorer: Scorer,
    predictions: VersionedTable,
    model_version: str,
    as_of: datetime | str | None = None,
    config: Config = Config(),
) -> int:
    """Score the distinct raw keys that have features and upsert the predictions; returns the rows scored.

    The scored batch is written once. Its count comes from the file footers, its key check reads one column, and the upsert
    reads what was written, so nothing is scored twice.
    """
    roles = config.roles
    require_schema(features, roles)
    scored = scorer(prediction_inputs(raw, features, roles.id_col))
    batch = materialize(prediction_rows(scored, roles.id_col, model_version, as_of), "scored")
    count = batch.count()
    if not count:
        raise LookupError("no raw key has features")
    require(key_check(batch, roles.id_col))
    predictions.upsert(batch)
    return count


def explain_job(
    features: DataFrame,
    spine: DataFrame,
    scorer: Scorer,
    importances: VersionedTable,
    model_version: str,
    repeats: int = 3,
    config: Config = Config(),
) -> int:
    """Replace the importance table from the whole holdout; a failing scorer leaves one ``error`` row."""
    roles = config.roles
    holdout = training_frame(spine, features, "holdout", roles, keep_key=True)
    rows = materialize(holdout, "explained")
    try:
        measured = permutation_importance(
            rows, roles.id_col, roles.label_col, roles.model_features, scorer, repeats, config.trees.seed,
            config.limits.threshold,
        )
        return importances.replace(importance_table(measured, model_version).coalesce(1))
    except Exception as failure:  # noqa: BLE001 - the reason is the result
        error = [(model_version, "error", 0.0, str(failure))]
        schema = "model_version string, feature string, importance double, method string"
        return importances.replace(rows.sparkSession.createDataFrame(error, schema))


def monitor_job(
    spark: SparkSession,
    features: DataFrame | None,
    predictions: DataFrame | None,
    log_path: str,
    as_of: datetime | str | None = None,
    job_run_id: str = "",
    config: Config = Config(),
) -> DataFrame:
    """Append one status row to the monitor log; returns it."""
    status = monitor_status(features, predictions, config.roles, config.limits, as_of, job_run_id, spark)
    row = materialize(status, "monitor")
    append_log(row, log_path)
    return row
