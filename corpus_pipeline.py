"""A corpus pipeline over documents: each stage applies one operator to all rows that the stage before kept.

Language: documents without a letter have no language and go. Quality: documents scored below the threshold go. Near
duplicates: one document of each group stays, the one with the smallest id. Decontamination: documents that hold a passage of
the benchmark go. Packing: what is left becomes pieces of token sequences.

Rows that repeat a doc_id are one document and go or stay together; rows with a null doc_id are only judged by themselves and take
no part in groups. Null and empty texts have no language and go in the first stage. Very long texts are read whole in every stage. Of
documents that are equally near a group's start, the smallest id stays; a score that equals the quality threshold is kept. Columns beyond those of
documents pass through all stages but the last; one that has the name of what a stage adds to its rows (``lang_pred``, ``score``,
``predicted``, a statistic of ``quality``) comes out with that stage's value. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabspine.llm import decontamination, language, near_duplicates, packing, quality, queries
from tabspine.llm.selection import without
from tabspine.sources.scratch import materialize


def with_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    queries.workers_find_library(spark)
    prototypes = language.train(docs.where(queries.remainder("doc_id", 5) != 0))
    if not prototypes:  # nothing to judge by
        return docs
    return language.predict(docs, prototypes).where("lang_pred != 'und'").select(docs.columns)


def of_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    queries.workers_find_library(spark)
    stats = materialize(quality.statistics(docs), "statistics")
    ensemble = queries.quality_model(spark, stats, sf_dir)
    return quality.scored(quality.statistics(docs, whole_rows=True), ensemble).where("predicted = 1").select(docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    queries.workers_find_library(spark)
    found = near_duplicates.near_duplicates(docs)
    return without(docs, found.where("not kept"), "doc_id").select(docs.columns)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    queries.workers_find_library(spark)
    found = decontamination.contaminated(docs, queries.table(spark, sf_dir, "benchmark"))
    return without(docs, found.where("contaminated"), "doc_id").select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    queries.workers_find_library(spark)
    return packing.pack(docs, queries.packing_settings())


STAGES = [
    ("language", with_language),
    ("quality", of_quality),
    ("near_duplicates", one_of_each_group),
    ("decontamination", clean_of_benchmark),
    ("packing", packed),
]

#: No SQL trains the models or runs the tokenizer of these stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that packing makes of the documents that all stages keep."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
