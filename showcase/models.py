"""Scoring, training, evaluation, importance and JSON payload jobs."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from showcase.frames import (
    CENSUS_SCORE,
    CENSUS_SCORE_B,
    CENSUS_SQL,
    DOCUMENT_SCORE,
    DOCUMENTS_SQL,
    FEATURES_SQL,
    census,
    labelled_documents,
    metrics_sql,
    rounded,
    table,
)
from showcase.registry import query
from tabspine.config import Roles, TreeParams
from tabspine.functions.keys import hash_split
from tabspine.functions.numbers import positive_score, threshold
from tabspine.operators.importance import importance_table, mean_importance, permutation_importance
from tabspine.operators.engineer import feature_frame
from tabspine.operators.metrics import METRICS, classification_metrics
from tabspine.operators.payloads import payload_pins, score_rows
from tabspine.operators.scoring import fit_preprocessing, impute, impute_values, score_in_chunks, train_trees
from tabspine.operators.spine import label_spine, labelled_scores, lookup_features
from tabspine.functions.jsonvals import json_value, pair_map
from tabspine.plans.data import with_split
from tabspine.plans.model import compare_evaluated, evaluate_job, evaluate_versions, explain_job, predict_job, score_keys, train_job
from tabspine.sources.scratch import materialize, scratch_path
from tabspine.sources.tables import VersionedTable

_METRIC_COLUMNS = "round(roc_auc, 6) AS roc_auc, round(f1, 6) AS f1, round(accuracy, 6) AS accuracy, eval_rows, round(positive_rate, 6) AS positive_rate"


def census_scorer(rule: str):
    """A fixed scoring rule in place of a model."""
    return lambda df: df.withColumn("score", F.expr(rule))


@query(
    f"""WITH {DOCUMENTS_SQL}, held AS (SELECT * FROM docs
        WHERE CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 10 >= 8)
    SELECT {_METRIC_COLUMNS} FROM ({metrics_sql('held', 'quality', 'score')})"""
)
def holdout_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label spine, hash split, feature lookup, score and metrics of the holdout, as one lazy plan."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    holdout = labels.filter(hash_split(F.col("doc_id")) == "holdout")
    found = lookup_features(holdout, table(spark, sf_dir, "documents"), "doc_id", ["n_chars"])
    scored = found.select("doc_id", F.expr(DOCUMENT_SCORE).alias("score"))
    joined = labelled_scores(holdout, scored, "doc_id")
    return rounded(classification_metrics(joined, "quality", "score").select(*METRICS))


@query(
    "SELECT doc_id, quality, CAST(n_chars % 1000 AS DOUBLE) / 1000 AS score, CASE WHEN n_chars % 1000 >= 500 THEN 1 ELSE 0 END AS class "
    "FROM labels LEFT JOIN documents USING (doc_id)"
)
def score_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys with looked-up features, a two-class score vector, P(positive) and the class."""
    keys = table(spark, sf_dir, "labels").select("doc_id", "quality")
    found = lookup_features(keys, table(spark, sf_dir, "documents"), "doc_id", ["n_chars"])
    share = F.expr(DOCUMENT_SCORE)
    score = positive_score(F.array(1 - share, share))
    return found.select("doc_id", "quality", score.alias("score"), threshold(score).alias("class"))


@query(
    f"WITH {CENSUS_SQL}, {FEATURES_SQL}, scored AS (SELECT row_id, income_gt_50k, {CENSUS_SCORE} AS score FROM raw "
    "WHERE split <> 'train'), "
    f"m AS ({metrics_sql('scored', 'income_gt_50k', 'score')}) "
    "SELECT '3' AS model_version, metric, round(value, 6) AS value FROM (UNPIVOT (SELECT roc_auc, f1, accuracy, "
    "CAST(eval_rows AS DOUBLE) AS eval_rows, positive_rate FROM m) ON * INTO NAME metric VALUE value)"
)
def evaluated_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The evaluate job: gates, alignment, holdout metrics, as metric rows of a model version."""
    raw = with_split(census(spark, sf_dir))
    metrics = evaluate_job(spark, raw, feature_frame(raw), label_spine(raw), census_scorer(CENSUS_SCORE), "3")
    return rounded(metrics)


@query(
    f"""WITH {CENSUS_SQL}, scored AS (SELECT income_gt_50k, {CENSUS_SCORE} AS a, {CENSUS_SCORE_B} AS b FROM raw WHERE split <> 'train'),
    c AS ({metrics_sql('scored', 'income_gt_50k', 'a')}), p AS ({metrics_sql('scored', 'income_gt_50k', 'b')})
    SELECT 'roc_auc' AS metric, round(c.roc_auc, 6) AS challenger, round(p.roc_auc, 6) AS champion,
           CASE WHEN c.roc_auc >= p.roc_auc THEN 'go' ELSE 'no-go' END AS result, false AS first_version FROM c, p"""
)
def compared_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluate two versions on the same holdout in one pass, then decide."""
    raw = with_split(census(spark, sf_dir))
    scorers = {"3": census_scorer(CENSUS_SCORE), "2": census_scorer(CENSUS_SCORE_B)}
    metrics = evaluate_versions(spark, raw, feature_frame(raw), label_spine(raw), scorers)
    return rounded(compare_evaluated(metrics, "3", "2"))


@query(
    f"""WITH {CENSUS_SQL}, {FEATURES_SQL}
    SELECT row_id, {CENSUS_SCORE} AS score, '2' AS model_version FROM features WHERE education <> 'F'
    UNION ALL SELECT row_id, {CENSUS_SCORE_B}, '1' FROM features WHERE education = 'F'"""
)
def batch_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two prediction jobs into one table: the second renews some keys and adds others."""
    raw = census(spark, sf_dir)
    features = feature_frame(raw)
    predictions = VersionedTable(spark, scratch_path(spark, "predictions"), "row_id")
    for version, part, rule in (("1", "education <> 'P'", CENSUS_SCORE_B), ("2", "education <> 'F'", CENSUS_SCORE)):
        predict_job(raw.filter(part), features, census_scorer(rule), predictions, version, "2024-01-01 00:00:00")
    return predictions.read().drop("scored_at")


@query("SELECT doc_id, round(least(n_chars, 5000) / 5000e0, 6) AS score FROM documents")
def map_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of a Python scorer called on at most 256 records at a time."""
    documents = table(spark, sf_dir, "documents")

    def scorer(chunk):
        assert len(chunk) <= 256
        return (chunk["n_chars"].clip(upper=5000) / 5000.0).tolist()

    return rounded(score_in_chunks(documents, "doc_id", ["n_chars"], scorer))


_IMPUTED = "coalesce({0}, (SELECT {0} FROM raw WHERE {0} IS NOT NULL GROUP BY {0} ORDER BY count(*) DESC, {0} LIMIT 1)) AS {0}"


@query(
    f"WITH {CENSUS_SQL} SELECT row_id, CAST(age AS DOUBLE) AS age, "
    "CAST(coalesce(hours_per_week, (SELECT median(hours_per_week) FROM raw)) AS DOUBLE) AS hours_per_week, "
    f"{_IMPUTED.format('workclass')}, {_IMPUTED.format('sex')} FROM raw"
)
def imputed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls replaced by exact medians and most frequent values."""
    raw = census(spark, sf_dir)
    numeric, categorical = ["age", "hours_per_week"], ["workclass", "sex"]
    filled = impute(raw, *impute_values(raw, numeric, categorical))
    return filled.select("row_id", *numeric, *categorical)


@query(
    """WITH kinds AS (SELECT DISTINCT p_type FROM part WHERE p_type <> 'SMALL'),
    slots AS (SELECT p_type, row_number() OVER (ORDER BY p_type) AS slot FROM kinds)
    SELECT p_partkey, p_size + 0e0 AS size, coalesce(slot, 0) AS slot, (SELECT count(*) FROM slots) + 1 AS width
    FROM part LEFT JOIN slots USING (p_type)"""
)
def encoded_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature vectors: the number and the one-hot slot of the category, no slot for a category unseen in fitting."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_type")
    encoder = fit_preprocessing(part.filter("p_type <> 'SMALL'"), ["p_size"], ["p_type"])
    vector = vector_to_array("_features")
    return encoder.transform(part).select(
        "p_partkey",
        F.get(vector, F.lit(0)).alias("size"),
        F.array_position(F.slice(vector, F.lit(2), F.size(vector) - 1), 1.0).alias("slot"),
        F.size(vector).cast("long").alias("width"),
    )


@query(
    f"WITH {CENSUS_SQL} SELECT count(*) AS eval_rows, round(avg(CAST(income_gt_50k AS DOUBLE)), 6) AS positive_rate, "
    "CAST(0 AS BIGINT) AS lost_rows, true AS auc_passes, true AS above_constant FROM raw WHERE split <> 'train'"
)
def trained_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train boosted trees on the census train split, score the holdout, and say whether the fit is any good."""
    raw = with_split(census(spark, sf_dir))
    spine, features = label_spine(raw), feature_frame(raw)
    model = train_job(raw, features, spine)
    labels = spine.filter("split = 'holdout'").select("row_id", "income_gt_50k")
    scored = score_keys(labels, features, model.score)
    joined = materialize(labelled_scores(labels, scored, "row_id"), "trained-scores")
    metrics = rounded(classification_metrics(joined, "income_gt_50k", "score"))
    constant = F.greatest(F.col("positive_rate"), 1 - F.col("positive_rate"))
    return metrics.select(
        "eval_rows", "positive_rate", "lost_rows", F.coalesce(F.col("roc_auc") >= 0.7, F.lit(False)).alias("auc_passes"),
        F.coalesce(F.col("accuracy") > constant, F.lit(False)).alias("above_constant"),
    )


@query(f"WITH {DOCUMENTS_SQL} SELECT doc_id, quality, true AS in_range FROM docs")
def document_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small trees on document features, with unseen categories in the scored rows: every row gets a probability."""
    rows = labelled_documents(spark, sf_dir).select("doc_id", "quality", "lang", "n_chars")
    train = rows.filter((hash_split(F.col("doc_id")) == "train") & (F.col("lang") != "es"))
    model = train_trees(train, "quality", ["n_chars"], ["lang"], TreeParams(trees=10))
    in_range = F.coalesce(F.col("score").between(0, 1), F.lit(False))
    return model.score(rows).select("doc_id", "quality", in_range.alias("in_range"))


def _importance_sql() -> str:
    return f"""WITH {DOCUMENTS_SQL},
    reps AS (SELECT docs.*, r.rep FROM docs, (SELECT unnest([0, 1, 2]) AS rep) r),
    ordered AS (SELECT *, md5(concat(rep, '|42|', doc_id)) AS o FROM reps),
    ring AS (SELECT *, coalesce(lead(n_chars) OVER w, first_value(n_chars) OVER w) AS other_chars,
                    coalesce(lead(lang) OVER w, first_value(lang) OVER w) AS other_lang
             FROM ordered WINDOW w AS (PARTITION BY rep ORDER BY o, doc_id)),
    hits AS (SELECT rep, avg(CASE WHEN (n_chars % 1000 + (CASE WHEN lang = 'en' THEN 300 ELSE 0 END) >= 500) = (quality = 1) THEN 1e0 ELSE 0e0 END) AS base,
                    avg(CASE WHEN (other_chars % 1000 + (CASE WHEN lang = 'en' THEN 300 ELSE 0 END) >= 500) = (quality = 1) THEN 1e0 ELSE 0e0 END) AS chars,
                    avg(CASE WHEN (n_chars % 1000 + (CASE WHEN other_lang = 'en' THEN 300 ELSE 0 END) >= 500) = (quality = 1) THEN 1e0 ELSE 0e0 END) AS langs
             FROM ring GROUP BY rep)
    SELECT '3' AS model_version, 'n_chars' AS feature, round(avg(base - chars), 6) AS importance, 'permutation' AS method FROM hits
    UNION ALL SELECT '3', 'lang', round(avg(base - langs), 6), 'permutation' FROM hits"""


@query(_importance_sql())
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Permutation importance over all labelled documents, three repeats."""
    rows = materialize(labelled_documents(spark, sf_dir).select("doc_id", "quality", "n_chars", "lang"), "documents")
    rule = F.expr("(n_chars % 1000 + CASE WHEN lang = 'en' THEN 300 ELSE 0 END) / 1000e0")
    measured = permutation_importance(
        rows, "doc_id", "quality", ["n_chars", "lang"], lambda df: df.withColumn("score", rule)
    )
    return rounded(importance_table(measured, "3"))


def _explained_sql() -> str:
    """Only age and fnlwgt enter the rule; the other features keep every score."""
    rule = "floor(({0} + 2000 * {1}) / 700) / 1000e0 >= 0.5"
    hit = "avg(CASE WHEN ({0}) = (income_gt_50k = 1) THEN 1e0 ELSE 0e0 END)"
    others = ", ".join(f"'{c}'" for c in Roles().model_features if c not in ("age", "fnlwgt"))
    return f"""WITH {CENSUS_SQL},
    ordered AS (SELECT raw.*, rep, md5(concat(rep, '|42|', row_id)) AS o
                FROM raw, (SELECT unnest([0, 1, 2]) AS rep) WHERE split <> 'train'),
    ring AS (SELECT *, coalesce(lead(fnlwgt) OVER w, first_value(fnlwgt) OVER w) AS other_fnlwgt,
                    coalesce(lead(age) OVER w, first_value(age) OVER w) AS other_age
             FROM ordered WINDOW w AS (PARTITION BY rep ORDER BY o, row_id)),
    hits AS (SELECT {hit.format(rule.format('fnlwgt', 'age'))} AS base, {hit.format(rule.format('other_fnlwgt', 'age'))} AS weight,
                    {hit.format(rule.format('fnlwgt', 'other_age'))} AS years FROM ring GROUP BY rep)
    SELECT '3' AS model_version, 'age' AS feature, round(avg(base - years), 6) AS importance, 'permutation' AS method FROM hits
    UNION ALL SELECT '3', 'fnlwgt', round(avg(base - weight), 6), 'permutation' FROM hits
    UNION ALL SELECT '3', unnest([{others}]), 0, 'permutation'"""


@query(_explained_sql())
def explained_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The explain job: importance of all 18 features over the census holdout, stored and read back."""
    raw = with_split(census(spark, sf_dir))
    importances = VersionedTable(spark, scratch_path(spark, "importance"))
    explain_job(feature_frame(raw), label_spine(raw), census_scorer(CENSUS_SCORE), importances, "3")
    return rounded(importances.read())


@query(
    "SELECT event_type AS feature, round(avg(value), 6) AS importance FROM events GROUP BY event_type"
)
def importance_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean of repeated measurements by feature."""
    measured = table(spark, sf_dir, "events").select(F.col("event_type").alias("feature"), F.col("value").alias("importance"))
    return rounded(mean_importance(measured))


# Payload texts of many shapes; a and b are scores such as 0.0417.
_A = "concat('0.', lpad(concat('', event_id % 9999), 4, '0'))"
_B = "concat('0.', lpad(concat('', user_id % 997), 4, '0'))"
_PAYLOADS = [
    f"concat('{{\"predictions\": [', {_A}, ', ', {_B}, ']}}')",
    f"concat('{{\"predictions\": [{{\"score\": ', {_A}, '}}, {{\"prediction\": [', {_A}, ', ', {_B}, ']}}]}}')",
    f"concat('{{\"prediction\": ', {_A}, '}}')",
    f"concat('[[', {_A}, ', ', {_B}, '], [', {_A}, ']]')",
    f"concat('{{\"predictions\": [{{\"z\": true, \"p\": ', {_B}, ', \"a\": ', {_A}, '}}]}}')",
    f"concat('[\"', {_A}, '\", ', {_B}, ']')",
    "'null'",
    f"concat('{{\"foo\": ', {_A}, '}}')",
    _A,
    f"concat('{{\"predictions\": [{{\"prediction\": ', {_B}, '}}, \"x\"]}}')",
    "'[]'",
    "'true'",
    f"concat('{{\"predictions\": [[', {_A}, '], {{\"score\": \"', {_B}, '\"}}]}}')",
    f"concat('{{\"predictions\": [', {_A})",
    "'{\"predictions\": []}'",
    f"concat('[', {_A}, ', null]')",
]
_PAYLOAD = "CASE event_id % 16 " + " ".join(f"WHEN {i} THEN {p}" for i, p in enumerate(_PAYLOADS)) + " END"
_SCORES_SQL = f"""WITH n AS (SELECT event_id, event_id % 16 AS shape, CAST({_A} AS DOUBLE) AS a, CAST({_B} AS DOUBLE) AS b FROM events)
    SELECT event_id, 0 AS position, CASE WHEN shape = 11 THEN 1 WHEN shape IN (0, 1, 2, 5, 8, 12) THEN a ELSE b END AS score
    FROM n WHERE shape NOT IN (6, 7, 9, 10, 13, 14, 15)
    UNION ALL SELECT event_id, 1, CASE WHEN shape = 3 THEN a ELSE b END FROM n WHERE shape IN (0, 1, 3, 5, 12)
    UNION ALL SELECT event_id, NULL, NULL FROM n WHERE shape IN (6, 7, 9, 13, 15)"""


@query(_SCORES_SQL)
def score_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores out of JSON payloads of sixteen shapes."""
    payloads = table(spark, sf_dir, "events").select("event_id", F.expr(_PAYLOAD).alias("payload"))
    return score_rows(payloads, "event_id", "payload")


@query("SELECT event_id, 'k' AS key, regexp_extract(props, '[0-9]+') AS value FROM events UNION ALL SELECT event_id, 'type', event_type FROM events")
def json_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key/value JSON, an object and a list of pairs, merged and read as rows."""
    listed = "concat('[{\"name\": \"type\", \"val\": \"old\"}, {\"key\": \"type\", \"value\": \"', event_type, '\"}, {\"key\": \"none\"}]')"
    events = table(spark, sf_dir, "events")
    listed_events = events.select("event_id", "props", F.expr(listed).alias("listed"))
    return listed_events.select("event_id", F.explode(pair_map("props", "listed")).alias("key", "value"))


@query(
    "SELECT event_type, concat('{\"n\":', count(*), ',\"last\":', max(event_id), '}') AS value FROM events GROUP BY event_type"
)
def json_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON value per group."""
    counts = F.struct(F.count("*").alias("n"), F.max("event_id").alias("last"))
    grouped = table(spark, sf_dir, "events").groupBy("event_type").agg(counts.alias("v"))
    return grouped.select("event_type", json_value(F.col("v")).alias("value"))


_TASK = "'{\"task_key\": \"promotion_ready\", \"values\": '"
_RUNS = {
    0: f"concat('{{\"run_id\": ', event_id, ', \"tasks\": [', {_TASK}, '{{\"ready\": \"true\", \"go_version\": \"', user_id, '\"}}}}]}}')",
    1: f"concat('{{\"runId\": \"', event_id, '\", \"task_runs\": [', {_TASK}, '[{{\"key\": \"ready\", \"value\": \"TRUE\"}}, "
       "{\"name\": \"go_version\", \"val\": \"', user_id, '\"}]}]}')",
    2: f"concat('{{\"tasks\": [', {_TASK}, '{{\"ready\": false}}}}]}}')",
    3: f"concat('{{\"tasks\": [', {_TASK}, '{{\"go_version\": \"4\"}}}}]}}')",
    4: f"concat('{{\"tasks\": [', {_TASK}, '{{\"ready\": true, \"go_version\": \" \"}}}}]}}')",
    5: f"concat('{{\"run_id\": 1', event_id, ', \"tasks\": [', {_TASK}, '{{\"ready\": true, \"go_version\": \"4\"}}}}]}}')",
    6: "concat('{\"run_id\": ', event_id, ', \"tasks\": [{\"task_key\": \"train\"}]}')",
    7: f"concat('{{\"tasks\": [', {_TASK}, '{{\"ready\": \"no\"}}}}], \"repair_history\": [{{\"tasks\": [', {_TASK}, "
       "'{\"ready\": \"false\"}, \"status\": {\"task_values\": {\"ready\": \"true\", \"go_version\": \"', user_id, '\"}}}]}, {}]}')",
}
_RUN = "CASE event_id % 8 " + " ".join(f"WHEN {i} THEN {p}" for i, p in _RUNS.items()) + " END"


@query(
    """SELECT event_id, CASE WHEN event_id % 8 IN (0, 1, 7) THEN true WHEN event_id % 8 = 2 THEN false END AS promotable,
    CASE WHEN event_id % 8 IN (0, 1, 7) THEN CAST(user_id AS VARCHAR) ELSE '' END AS source_model_version,
    CASE event_id % 8 WHEN 2 THEN 'not ready' WHEN 3 THEN 'ready missing' WHEN 4 THEN 'ready without version'
         WHEN 5 THEN 'run id mismatch' WHEN 6 THEN 'task missing' ELSE 'ready' END AS reason FROM events"""
)
def run_pins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Promotion pins out of run payloads of eight shapes."""
    runs = table(spark, sf_dir, "events").select("event_id", F.expr(_RUN).alias("payload"))
    return payload_pins(runs, "event_id", "payload").drop("payload")
