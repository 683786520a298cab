"""Shared scratch storage for results that must be computed exactly once.

A plan that is read twice and must not change in between (row numbers, a scored batch) is written as a table
in the folder the cluster names in ``spark.checkpoint.dir``. A written table outlives lost executors.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_RUNS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The session's shared folder; a temporary one only for an unset local session."""
    root = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError(f"{_SETTING} is not set: name a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="tabspine-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path of this application under the shared folder."""
    app = spark.sparkContext.applicationId
    if app not in _RUNS:
        _RUNS[app] = f"{scratch_root(spark)}/tabspine-{app}-{uuid.uuid4().hex[:8]}"
    return f"{_RUNS[app]}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to scratch and read it back: cut lineage, one evaluation, columnar reads afterwards."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote to scratch; frames built on it can no longer be read."""
    path = _RUNS.pop(spark.sparkContext.applicationId, None)
    if path:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
