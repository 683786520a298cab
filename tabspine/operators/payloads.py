"""Jobs over JSON payload tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabspine.functions.jsonvals import (
    body_items,
    if_complete,
    item_scores,
    ordered_objects,
    pair_map,
    payload_body,
)

# The layout of a job run payload, with its alternative names.
_TASK = (
    "task_key string, taskKey string, values string, task_values string, taskValues string, "
    "status struct<values: string, task_values: string>"
)
_RUN = "run_id string, runId string, tasks array<string>, task_runs array<string>, repair_history array<string>"
READY_TASK = "promotion_ready"


class PayloadError(ValueError):
    """A prediction payload could not be read."""


def score_rows(df: DataFrame, key: str, payload_col: str) -> DataFrame:
    """(key, position, score) rows; an unreadable payload gives one row with null position and score, an empty list none.

    Each parse is a column of its own, so that it happens once per row.
    """
    text = F.col(payload_col)
    parsed = df.select(
        key, text.alias("_text"), F.try_parse_json(text).alias("_payload"), F.json_object_keys(text).alias("_names")
    )
    bodies = parsed.select(key, "_text", payload_body("_payload", "_names").alias("_body"))
    items = bodies.select(key, "_text", body_items("_body").alias("_items"))
    staged = items.select(key, "_items", ordered_objects("_items", "_text").alias("_ordered"))
    scores = staged.select(key, item_scores("_items", "_ordered").alias("_scores"))
    whole = scores.select(key, if_complete("_scores").alias("_scores"))
    # No filter on the scores: it would be pushed below every stage, and each stage evaluated again for it.
    unread = F.array(F.struct(F.lit(None).cast("int").alias("position"), F.lit(None).cast("double").alias("score")))
    read = F.transform("_scores", lambda s, i: F.struct(i.alias("position"), s.alias("score")))
    return whole.select(key, F.inline(F.when(F.col("_scores").isNull(), unread).otherwise(read)))


def require_readable(scored: DataFrame) -> DataFrame:
    bad = scored.filter(F.col("position").isNull()).take(1)
    if bad:
        raise PayloadError(f"cannot read scores of payload {bad[0][0]}")
    return scored


def with_run_values(df: DataFrame, payload_col: str, out: str, task_key: str = READY_TASK) -> DataFrame:
    """Adds the key/value map of the last task with this key, repairs after first runs; null if there is none."""
    first_runs = "CASE WHEN size(_run.tasks) > 0 THEN _run.tasks ELSE _run.task_runs END"
    repairs = "filter(transform(_run.repair_history, r -> from_json(r, 'tasks array<string>').tasks), l -> l IS NOT NULL)"
    texts = f"concat(coalesce({first_runs}, array()), coalesce(flatten({repairs}), array()))"
    named = f"filter(_tasks, t -> coalesce(nullif(t.task_key, ''), t.taskKey) = '{task_key}')"
    values = pair_map("_last.values", "_last.task_values", "_last.taskValues", "_last.status.values", "_last.status.task_values")
    return (
        df.withColumn("_run", F.from_json(F.col(payload_col), _RUN))
        .withColumn("_tasks", F.expr(f"transform({texts}, t -> from_json(t, '{_TASK}'))"))
        .withColumn("_last", F.expr(f"try_element_at({named}, -1)"))
        .withColumn(out, F.when(F.col("_last").isNotNull(), values))
        .drop("_tasks", "_last")
    )


def payload_pins(df: DataFrame, run_id_col: str, payload_col: str, task_key: str = READY_TASK) -> DataFrame:
    """Adds promotable, source_model_version and reason to each run payload.

    promotable is null for a refused row: blank or different run id, no such task, missing ``ready``, or ready
    without a version. A ``ready`` other than true is not promotable.
    """
    staged = with_run_values(df, payload_col, "_values", task_key).withColumns(
        {
            "_run_id": F.expr(f"trim(coalesce(cast({run_id_col} AS string), ''))"),
            "_named_id": F.expr("trim(coalesce(nullif(_run.run_id, ''), _run.runId, ''))"),
            "_ready": F.expr("lower(trim(coalesce(_values['ready'], '')))"),
            "_version": F.expr("trim(coalesce(_values['go_version'], ''))"),
        }
    )
    refusal = F.expr("""
        CASE WHEN _run_id = '' THEN 'empty run id'
             WHEN _named_id <> '' AND _named_id <> _run_id THEN 'run id mismatch'
             WHEN _values IS NULL THEN 'task missing'
             WHEN _ready = '' THEN 'ready missing'
             WHEN _ready = 'true' AND _version = '' THEN 'ready without version' END""")
    refused = staged.withColumn("_refusal", refusal)
    return refused.withColumns(
        {
            "promotable": F.expr("CASE WHEN _refusal IS NULL THEN _ready = 'true' END"),
            "source_model_version": F.expr("CASE WHEN _refusal IS NULL AND _ready = 'true' THEN _version ELSE '' END"),
            "reason": F.expr("coalesce(_refusal, CASE WHEN _ready = 'true' THEN 'ready' ELSE 'not ready' END)"),
        }
    ).drop("_values", "_run", "_run_id", "_named_id", "_ready", "_version", "_refusal")
