"""Input frames: the given tables, and census-style records derived from ``orders``.

A derived column is one expression that both engines read the same way, so the operators under test start from the
same rows as their SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CENSUS = {
    "row_id": "o_orderkey + 1",
    "age": "17 + o_custkey % 60",
    "fnlwgt": "CAST(floor(o_totalprice) AS BIGINT)",
    "education_num": "1 + o_orderkey % 16",
    "capital_gain": "CASE WHEN o_orderkey % 11 = 0 THEN o_custkey * 7 ELSE 0 END",
    "capital_loss": "CASE WHEN o_orderkey % 13 = 0 THEN o_custkey % 2000 ELSE 0 END",
    "hours_per_week": "CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE 20 + o_custkey % 50 END",
    "workclass": "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_orderpriority END",
    "education": "o_orderstatus",
    "marital_status": "concat('m', o_custkey % 7)",
    "occupation": "concat('occ', o_orderkey % 14)",
    "relationship": "concat('rel', o_custkey % 6)",
    "race": "concat('race', o_orderkey % 5)",
    "sex": "CASE WHEN o_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END",
    "native_country": "concat('c', o_custkey % 41)",
    "split": "CASE o_orderstatus WHEN 'F' THEN 'train' WHEN 'O' THEN 'holdout' ELSE o_orderstatus END",
    "income_gt_50k": "CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END",
}

# The same records as text, before cleaning: hyphenated names, blanks, missing tokens, dotted labels, bad numbers.
RECORDS = {
    "row_id": "o_orderkey + 1",
    "age": "CASE WHEN o_orderkey % 53 = 0 THEN 'n/a' WHEN o_orderkey % 59 = 0 THEN concat(o_custkey % 60, 'd') "
    "WHEN o_orderkey % 61 = 0 THEN ' nan' WHEN o_orderkey % 67 = 0 THEN concat('+', o_custkey % 60, '.5e1 ') ELSE concat(' ', 17 + o_custkey % 60) END",
    "workclass": "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN ' ?' ELSE concat(' ', o_orderpriority) END",
    "fnlwgt": "concat('', CAST(floor(o_totalprice) AS BIGINT))",
    "education": "concat(o_orderstatus, ' ')",
    "education-num": "concat('', 1 + o_orderkey % 16)",
    "marital-status": "CASE WHEN o_custkey % 7 = 0 THEN 'nan' ELSE concat('m', o_custkey % 7) END",
    "occupation": "CASE WHEN o_orderkey % 14 = 0 THEN 'None' ELSE concat('occ', o_orderkey % 14) END",
    "relationship": "concat('rel', o_custkey % 6)",
    "race": "concat('race', o_orderkey % 5)",
    "sex": "CASE WHEN o_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END",
    "capital-gain": "CASE WHEN o_orderkey % 11 = 0 THEN concat('', o_custkey * 7) ELSE '0' END",
    "capital-loss": "CASE WHEN o_orderkey % 13 = 0 THEN concat('', o_custkey % 2000) ELSE '0' END",
    "hours-per-week": "CASE WHEN o_orderkey % 97 = 0 THEN '' ELSE concat('', 20 + o_custkey % 50) END",
    "native-country": "concat('c', o_custkey % 41)",
    "income": "concat(CASE WHEN o_totalprice > 250000 THEN ' >50' ELSE ' <=50' END,"
    " CASE o_orderkey % 3 WHEN 0 THEN 'K.' WHEN 1 THEN 'K' ELSE 'k ' END)",
}

# A fixed scoring rule over census features, with many tied scores.
CENSUS_SCORE = "floor((fnlwgt + 2000 * age) / 700) / 1000e0"
CENSUS_SCORE_B = "floor((fnlwgt + 6000 * age) / 900) / 1000e0"
DOCUMENT_SCORE = "CAST(n_chars % 1000 AS DOUBLE) / 1000e0"
DOCUMENT_SCORE_B = "CAST((n_chars * 7) % 1000 AS DOUBLE) / 1000e0"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _select(expressions: dict[str, str], quote: str) -> str:
    return ", ".join(f"{e} AS {quote}{n}{quote}" for n, e in expressions.items())


def census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw census-style table from ``orders``."""
    return table(spark, sf_dir, "orders").selectExpr(*[f"{e} AS {n}" for n, e in CENSUS.items()])


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as uncleaned text."""
    return table(spark, sf_dir, "orders").selectExpr(*[f"{e} AS `{n}`" for n, e in RECORDS.items()])


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label spine joined with document features and two scores."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return labels.join(documents, "doc_id").select(
        "*", F.expr(DOCUMENT_SCORE).alias("score"), F.expr(DOCUMENT_SCORE_B).alias("score_b")
    )


CENSUS_SQL = f"raw AS (SELECT {_select(CENSUS, '')} FROM orders)"
RECORDS_SQL = "records AS (SELECT {} FROM orders)".format(_select(RECORDS, '"'))
FEATURES_SQL = (
    "features AS (SELECT row_id, age, fnlwgt, education_num, capital_gain, capital_loss, hours_per_week, workclass, "
    "education, marital_status, occupation, relationship, race, sex, native_country, "
    "capital_gain - capital_loss AS capital_net, "
    "CASE WHEN hours_per_week > 40 THEN CAST(1 AS BIGINT) ELSE CAST(0 AS BIGINT) END AS hours_over_40, "
    "ln(1 + CAST(fnlwgt AS DOUBLE)) AS log_fnlwgt, "
    "CAST(education_num AS DOUBLE) * CAST(education_num AS DOUBLE) AS education_num_sq FROM raw)"
)
DOCUMENTS_SQL = (
    "docs AS (SELECT doc_id, quality, lang, n_chars, "
    f"{DOCUMENT_SCORE} AS score, {DOCUMENT_SCORE_B} AS score_b FROM labels JOIN documents USING (doc_id))"
)


def metrics_sql(source: str, label: str, score: str, by: str = "", threshold: float = 0.5) -> str:
    """SQL for the wide metric rows of ``source``: rank-sum AUC with averaged ties, and confusion counts."""
    keys = f"{by}, " if by else ""
    window = f"PARTITION BY {by} " if by else ""
    tie = f"PARTITION BY {keys}{score}"
    group = f"GROUP BY {by}" if by else ""
    return f"""
    SELECT {keys}CASE WHEN p > 0 AND n > 0 THEN (ranksum - p * (p + 1) / 2e0) / (p * n) END AS roc_auc,
           CASE WHEN 2 * tp + fp + fn > 0 THEN 2e0 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1,
           (tp + tn) / CAST(p + n AS DOUBLE) AS accuracy, p + n AS eval_rows, p / CAST(p + n AS DOUBLE) AS positive_rate
    FROM (SELECT {keys}sum(CASE WHEN {label} = 1 THEN rk ELSE 0 END) AS ranksum,
                 count(*) FILTER (WHERE {label} = 1) AS p, count(*) FILTER (WHERE {label} = 0) AS n,
                 count(*) FILTER (WHERE {label} = 1 AND {score} >= {threshold}) AS tp,
                 count(*) FILTER (WHERE {label} = 0 AND {score} >= {threshold}) AS fp,
                 count(*) FILTER (WHERE {label} = 1 AND {score} < {threshold}) AS fn,
                 count(*) FILTER (WHERE {label} = 0 AND {score} < {threshold}) AS tn
          FROM (SELECT *, rank() OVER ({window}ORDER BY {score})
                          + (count(*) OVER ({tie}) - 1) / 2e0 AS rk FROM {source}) {group})"""


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Double columns rounded, so that two engines' last digits do not matter."""
    return df.select(
        *[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )
