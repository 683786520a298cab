"""Preprocessing, boosted trees, scoring and prediction rows."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from datetime import datetime

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import FeatureHasher, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.pipeline import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabspine.config import TreeParams
from tabspine.functions.numbers import positive_score
from tabspine.functions.times import job_time
from tabspine.operators.metrics import class_balance
from tabspine.operators.ordering import exact_medians
from tabspine.operators.profile import cardinality, modes


def impute_values(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> tuple[dict, dict]:
    """Exact medians of the numeric columns and most frequent values of the categorical ones."""
    medians = exact_medians(df, numeric) if numeric else {}
    frequent = {r[0]: r[1] for r in modes(df, categorical).collect()} if categorical else {}
    return medians, frequent


def impute(df: DataFrame, medians: dict, frequent: dict) -> DataFrame:
    """Numerics as doubles with nulls at the median, categories with nulls at the most frequent value."""
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(v if v is not None else 0.0)) for c, v in medians.items()}
    filled |= {c: F.coalesce(F.col(c), F.lit(v)) for c, v in frequent.items()}
    return df.withColumns(filled)


@dataclass(frozen=True)
class Model:
    """Imputation values and a fitted pipeline over the imputed columns; scores frames lazily. ``inputs``: versions of what it was fitted on."""

    medians: dict
    frequent: dict
    pipeline: PipelineModel
    inputs: dict = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        return self.pipeline.transform(impute(df, self.medians, self.frequent))

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        """Adds P(positive); feature columns come out imputed."""
        probability = positive_score(vector_to_array("_probability")).alias(out)
        return self.transform(df).select(*df.columns, probability)

    def save(self, path: str) -> None:
        """Write the model to a folder that any session can load."""
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        spark = SparkSession.active()
        values = json.dumps({"medians": self.medians, "frequent": self.frequent, "inputs": self.inputs})
        spark.range(1).select(F.lit(values).alias("value")).coalesce(1).write.mode("overwrite").text(f"{path}/imputation")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Model:
        values = json.loads(spark.read.text(f"{path}/imputation", wholetext=True).first()[0])
        return Model(values["medians"], values["frequent"], PipelineModel.load(f"{path}/pipeline"), values.get("inputs", {}))


#: Categories of a column up to which each has a slot of its own; a column of more is hashed into ``HASHED_SLOTS`` slots.
MOST_CATEGORIES = 10_000
HASHED_SLOTS = 4096


def many_valued(df: DataFrame, categorical: Sequence[str], most: int = MOST_CATEGORIES) -> list[str]:
    """The columns with more than ``most`` categories. What is counted stays in the tasks but for one number a column."""
    if not categorical:
        return []
    counts = cardinality(df, categorical).filter(F.col("n_distinct") > most)
    large = {r["column_name"] for r in counts.select("column_name").collect()}
    return [c for c in categorical if c in large]


def preprocessing(numeric: Sequence[str], categorical: Sequence[str], hashed: Sequence[str] = (), slots: int = HASHED_SLOTS) -> list:
    """Stages that index and one-hot the categories, unknown ones as all zeros, and assemble ``_features``.

    The vocabulary of an indexed column goes to the driver. ``hashed`` columns have none: their categories share ``slots`` slots, in
    which a category unseen in fitting has one as well.
    """
    stages: list = []
    categorical = [c for c in categorical if c not in hashed]
    hot = [f"{c}__hot" for c in categorical]
    if hashed:
        stages.append(FeatureHasher(inputCols=list(hashed), outputCol="_hashed", numFeatures=slots, categoricalCols=list(hashed)))
    if categorical:
        index = [f"{c}__index" for c in categorical]
        stages.append(
            StringIndexer(inputCols=list(categorical), outputCols=index, handleInvalid="keep", stringOrderType="alphabetAsc")
        )
        stages.append(OneHotEncoder(inputCols=index, outputCols=hot))
    stages.append(VectorAssembler(inputCols=[*numeric, *hot, *(["_hashed"] if hashed else [])], outputCol="_features", handleInvalid="keep"))
    return stages


def fit_preprocessing(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], most: int = MOST_CATEGORIES, slots: int = HASHED_SLOTS
) -> Model:
    """Imputation and encoding learned from a frame; a column of more than ``most`` categories is hashed."""
    medians, frequent = impute_values(df, numeric, categorical)
    rows = impute(df.select(*numeric, *categorical), medians, frequent)
    stages = preprocessing(numeric, categorical, many_valued(df, categorical, most), slots)
    return Model(medians, frequent, Pipeline(stages=stages).fit(rows))


def train_trees(
    df: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str], params: TreeParams = TreeParams()
) -> Model:
    """Gradient-boosted trees over all executors, positives weighted by negatives / positives."""
    encoder = fit_preprocessing(df, numeric, categorical)
    weight = class_balance(df, label).first()["class_weight"]
    rows = encoder.transform(df).select(
        F.col(label).cast("double").alias(label),
        F.when(F.col(label) == 1, float(weight)).otherwise(1.0).alias("_weight"),
        "_features",
    )
    trees = GBTClassifier(
        labelCol=label, featuresCol="_features", weightCol="_weight", predictionCol="_prediction",
        maxIter=params.trees, maxDepth=params.depth, stepSize=params.rate, subsamplingRate=params.row_sample,
        featureSubsetStrategy=str(params.column_sample), seed=params.seed,
    )
    fitted = trees.setRawPredictionCol("_raw").setProbabilityCol("_probability").fit(rows)
    return Model(encoder.medians, encoder.frequent, PipelineModel([*encoder.pipeline.stages, fitted]))


def score_in_chunks(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    scorer: Callable[[pd.DataFrame], Sequence[float]],
    chunk_rows: int = 256,
) -> DataFrame:
    """(key, score) by a caller's Python scorer, at most ``chunk_rows`` records a call, key type kept.

    The scorer runs inside the tasks, one call per chunk of an Arrow batch; a call that returns another number of
    scores than it got records fails the job.
    """
    names = list(features)

    def score_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), chunk_rows):
                chunk = batch.iloc[start : start + chunk_rows]
                scores = list(scorer(chunk[names]))
                if len(scores) != len(chunk):
                    raise RuntimeError(f"scorer returned {len(scores)} scores for {len(chunk)} rows")
                yield pd.DataFrame({key: chunk[key].to_numpy(), "score": [float(s) for s in scores]})

    schema = T.StructType([df.schema[key], T.StructField("score", T.DoubleType())])
    return df.select(key, *[c for c in names if c != key]).mapInPandas(score_batches, schema)


def prediction_rows(
    scored: DataFrame, key: str, model_version: str, as_of: datetime | str | None = None
) -> DataFrame:
    """(key, score, scored_at, model_version); a ``prediction`` column is taken as the score."""
    score = "score" if "score" in scored.columns else "prediction"
    return scored.select(
        key,
        F.col(score).cast("double").alias("score"),
        job_time(as_of).alias("scored_at"),
        F.lit(model_version).alias("model_version"),
    )
