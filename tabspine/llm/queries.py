"""Queries of the training-data operators: each applies one to its whole table with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabspine.llm import (
    decontamination, language, language_model, licenses, near_duplicates, neighbours, packing, quality, ranked_search, resampling,
    secret_spans, token_counts, warc,
)
from tabspine.llm.oracles import ORACLES  # noqa: F401
from tabspine.sources.scratch import materialize, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def workers_find_library(spark: SparkSession) -> None:
    """Python workers import this library from where the driver has it, whatever folder they were started in."""
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if _ROOT not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [_ROOT, known]))


def query(function):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        workers_find_library(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(key: str, of: int):
    """crc32 of a key as text, modulo ``of``."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % of


@query
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(True))
    prototypes = language.train(docs.where(~held_out))
    return language.predict(docs.select("doc_id", "text"), prototypes).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


@query
def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return near_duplicates.near_duplicates(docs, settings=near_duplicates.Settings(shingle_words=2))


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


def packing_settings() -> packing.Settings:
    return packing.Settings(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), packing_settings())


def quality_model(spark: SparkSession, stats: DataFrame, sf_dir: str) -> quality.Ensemble:
    """Learns from labelled rows outside the held-out quarter."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("int").alias("quality"))
    return quality.fit(stats.where(remainder("doc_id", 4) != 2).join(labels, "doc_id"))


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = materialize(quality.statistics(table(spark, sf_dir, "documents")), "statistics")
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(True))
    rows = quality.scored(stats, quality_model(spark, stats, sf_dir))
    return rows.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text", "detections")


@query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), root)
    return warc.read(spark, root, payloads=False).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query
def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder("doc_id", 7) == 2, F.lit(True))
    model = language_model.train(docs.where(~held_out))
    return language_model.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score", "score", "perplexity",
    )


@query
def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), lambda id: id % 100 == 0)


#: What op9 edits: addresses of mail and runs of digits are masked, and repeated marks shortened.
_MASKS = r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9.-]{1,255}|[0-9]{3,}|[!#$%&*]{2,}"


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents before and after masking: trees are built and kept, then edits are applied to what was kept."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    settings = token_counts.Settings(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    kept = materialize(token_counts.build(docs, settings), "token-trees")
    return token_counts.apply(token_counts.masked(kept, _MASKS, "[masked]"), settings).select("doc_id", *token_counts.NUMBERS)


@query
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secret_spans.secret_spans(table(spark, sf_dir, "documents"))
    base = F.sha2(secret_spans.listed("base").cast("binary"), 256).alias("base_sha256")
    return rows.select("doc_id", "n_assign", "n_access", "n_hex", base, secret_spans.listed("spans").alias("spans"), "n_random")


@query
def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_features", "weight", "score", "rank")
