"""Sources, cleaning, projections, functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from showcase.frames import CENSUS_SQL, FEATURES_SQL, RECORDS_SQL, census, records, rounded, table
from showcase.registry import query
from tabspine.config import CSV_COLUMNS
from tabspine.functions.keys import hash_split, md5_int, normal_split, sample_order
from tabspine.functions.numbers import threshold, to_number, widen_integers
from tabspine.functions.text import (
    dotted,
    encode_label,
    in_list,
    is_truthy,
    null_if_missing,
    served_name,
    snake_value,
    split_list,
)
from tabspine.functions.times import iso_text, run_stamp
from tabspine.operators.clean import normalize_records, unknown_labels
from tabspine.operators.engineer import feature_frame
from tabspine.operators.fingerprint import table_fingerprint
from tabspine.operators.ordering import chronological_split, first_by_hash, first_by_key, global_row_number
from tabspine.operators.spine import label_spine
from tabspine.plans.data import feature_job, publish_features, seeded_rows
from tabspine.sources.records import read_first_available
from tabspine.sources.scratch import scratch_path
from tabspine.sources.tables import VersionedTable, replace_table, require_table

# Cleaned census values as SQL over the text records.
_TOKEN = "CASE WHEN trim({0}) IN ('nan', 'None', '?', '') THEN NULL ELSE trim({0}) END"
_CLEAN_SQL = ", ".join(
    [f"""CASE WHEN regexp_full_match(trim("{c}"), '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?') THEN TRY_CAST("{c}" AS DOUBLE) END AS {c.replace("-", "_")}""" for c in
     ("age", "fnlwgt", "education-num", "capital-gain", "capital-loss", "hours-per-week")]
    + [_TOKEN.format(f'"{c}"') + f' AS {c.replace("-", "_")}' for c in
       ("workclass", "education", "marital-status", "occupation", "relationship", "race", "sex", "native-country")]
    + ["CASE WHEN lower(replace(trim(income), '.', '')) = '>50k' THEN 1 ELSE 0 END AS income_gt_50k"]
)


@query(
    f"""WITH {RECORDS_SQL} SELECT CASE WHEN trim(education) = 'F' THEN 'train' ELSE 'holdout' END AS split, {_CLEAN_SQL},
    row_number() OVER (ORDER BY trim(education) <> 'F', row_id) AS row_id FROM records"""
)
def csv_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headerless train and holdout files, read, normalised, united and keyed 1..N in the order of their lines, between malformed ones."""
    folder = scratch_path(spark, "csv")
    rows = records(spark, sf_dir)
    is_train = F.trim("education") == "F"
    for split, part in (("train", is_train), ("holdout", ~is_train)):
        lines = rows.filter(part).select("row_id", F.concat_ws(",", *[F.coalesce(f"`{c}`", F.lit("")) for c in CSV_COLUMNS]).alias("line"))
        broken = lines.filter("row_id % 997 = 3").withColumn("line", F.concat("line", F.lit(",one more")))
        ordered = lines.unionByName(broken.withColumn("row_id", F.col("row_id") - 0.5)).orderBy("row_id")
        ordered.select("line").write.text(f"{folder}/{split}")
    return seeded_rows(spark, f"{folder}/train", f"{folder}/holdout", quarantine=1_000_000)


@query("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def first_available(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first source that opens wins."""
    candidates = [f"{sf_dir}/absent.parquet", f"{sf_dir}/orders.parquet"]
    return read_first_available(spark, candidates).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("SELECT c_mktsegment, count(*) AS n, min(c_custkey) AS first_key FROM customer GROUP BY c_mktsegment")
def replaced_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced with another schema, then read behind an existence check."""
    stored = VersionedTable(spark, scratch_path(spark, "replaced"))
    customers = table(spark, sf_dir, "customer")
    stored.replace(customers.select("c_custkey"))
    stored.replace(customers.select("c_custkey", "c_mktsegment"))
    return stored.read().groupBy("c_mktsegment").agg(
        F.count("*").alias("n"), F.min("c_custkey").alias("first_key")
    )


@query(
    "SELECT o_orderkey, nullif(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' ELSE o_orderpriority END, '') AS priority, "
    "replace(replace(lower(o_orderpriority), '-', '_'), ' ', '_') AS priority_name FROM orders"
)
def clean_categoricals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trimmed categories with missing tokens as null."""
    orders = table(spark, sf_dir, "orders")
    padded = F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit("  "))
    return orders.select(
        "o_orderkey",
        null_if_missing(padded, ("4-NOT SPECIFIED", "")).alias("priority"),
        snake_value(padded).alias("priority_name"),
    )


@query(f"WITH {RECORDS_SQL} SELECT row_id, {_CLEAN_SQL} FROM records")
def normalized_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text records as typed rows: names, aliases, missing tokens, numbers, label."""
    renamed = records(spark, sf_dir).withColumnsRenamed({"income": "class", "education-num": "EducationNum"})
    return normalize_records(renamed, extra=["row_id"])


@query(f"WITH {RECORDS_SQL} SELECT row_id, CASE WHEN income LIKE '% >50%' THEN 1 ELSE 0 END AS label FROM records")
def encoded_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).select("row_id", encode_label(F.col("income")).alias("label"))


@query(
    "SELECT DISTINCT replace(trim(p_name), '.', '') AS label_text FROM part ORDER BY label_text LIMIT 8"
)
def label_offenders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First eight distinct texts that are not class names."""
    return unknown_labels(table(spark, sf_dir, "part"), "p_name")


@query(
    "SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) END AS k "
    "FROM events"
)
def coerced_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number text as double, other text as null."""
    number = F.regexp_extract("props", "[0-9]+", 0)
    text = F.when(F.col("event_type").isin("view", "click"), number).otherwise(F.concat(F.lit("x"), number))
    return table(spark, sf_dir, "events").select("event_id", to_number(text).alias("k"))


@query(
    f"WITH {CENSUS_SQL}, {FEATURES_SQL} SELECT * REPLACE (round(log_fnlwgt, 6) AS log_fnlwgt) FROM features"
)
def engineered_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(feature_frame(census(spark, sf_dir)))


@query(
    f"WITH {CENSUS_SQL}, {FEATURES_SQL} SELECT row_id, capital_net, hours_over_40, round(log_fnlwgt, 6) AS log_fnlwgt, "
    "education_num_sq, workclass FROM features"
)
def published_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature table published after its key, leakage and contract checks, and read back."""
    features = VersionedTable(spark, scratch_path(spark, "features"))
    publish_features(census(spark, sf_dir), features)
    return rounded(
        features.read().select("row_id", "capital_net", "hours_over_40", "log_fnlwgt", "education_num_sq", "workclass")
    )


@query(
    f"""WITH {CENSUS_SQL}, {FEATURES_SQL},
    spine AS (SELECT row_id, CASE WHEN split IN ('train', 'holdout') THEN split ELSE 'holdout' END AS split, income_gt_50k FROM raw)
    SELECT split, count(*) AS n, CAST(sum(income_gt_50k) AS BIGINT) AS positives, CAST(sum(capital_net) AS BIGINT) AS capital_net,
           CAST(sum(hours_over_40) AS BIGINT) AS hours_over_40
    FROM spine JOIN features USING (row_id) GROUP BY split"""
)
def feature_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature job: split, spine and feature tables, summarised by split."""
    spine = VersionedTable(spark, scratch_path(spark, "spine"))
    features = VersionedTable(spark, scratch_path(spark, "features"))
    feature_job(census(spark, sf_dir), spine, features)
    return (
        spine.read().join(features.read(), "row_id").groupBy("split").agg(
            F.count("*").alias("n"), F.sum("income_gt_50k").alias("positives"),
            F.sum("capital_net").alias("capital_net"), F.sum("hours_over_40").alias("hours_over_40"),
        )
    )


@query(
    "SELECT o_orderkey, CASE WHEN CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 10 < 8 "
    "THEN 'train' ELSE 'holdout' END AS split FROM orders"
)
def split_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", hash_split(F.col("o_orderkey")).alias("split"))


@query(
    "SELECT event_id, user_id, CASE WHEN row_number() OVER (ORDER BY ts, event_id) <= floor(0.8 * count(*) OVER ()) "
    "THEN 'train' ELSE 'holdout' END AS split FROM events"
)
def split_chrono(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return chronological_split(events, "ts", "event_id").drop("ts")


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN row_number() OVER (ORDER BY l_returnflag, l_shipdate, l_orderkey, "
    "l_linenumber, l_partkey, l_suppkey, l_extendedprice) <= floor(0.8 * count(*) OVER ()) THEN 1 ELSE 0 END AS early "
    "FROM lineitem"
)
def ranked_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A split at 80% by global row number, where the leading order column holds a third of the rows per value."""
    order = ["l_returnflag", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    lines = table(spark, sf_dir, "lineitem").select(*order)
    cut = int(lines.count() * 0.8)
    ranked = global_row_number(lines, order, "_n")
    return ranked.select("l_orderkey", "l_linenumber", "l_partkey", (F.col("_n") <= cut).cast("int").alias("early"))


@query(
    "SELECT doc_id, CASE WHEN lang = 'en' THEN 'train' WHEN lang = 'de' THEN 'holdout' ELSE 'holdout' END AS split FROM documents"
)
def split_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = F.when(F.col("lang") == "en", "train").when(F.col("lang") == "de", "holdout").when(F.col("lang") == "fr", "test")
    return table(spark, sf_dir, "documents").select("doc_id", normal_split(named).alias("split"))


@query(
    "SELECT o_orderkey, row_number() OVER (ORDER BY CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END, o_orderkey) AS row_id "
    "FROM orders"
)
def dense_row_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys 1..N over the union of a train and a holdout part, train first."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    train = orders.filter("o_orderstatus = 'F'").withColumn("_part", F.lit(0))
    holdout = orders.filter("o_orderstatus <> 'F'").withColumn("_part", F.lit(1))
    return global_row_number(train.unionByName(holdout), ["_part", "o_orderkey"], "row_id").select("o_orderkey", "row_id")


@query(f"WITH {CENSUS_SQL} SELECT row_id, split, income_gt_50k FROM raw")
def label_spine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_spine(census(spark, sf_dir))


@query(
    "SELECT CAST(s_suppkey AS BIGINT) AS s_suppkey, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_name, s_acctbal FROM supplier"
)
def widened_integers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return widen_integers(table(spark, sf_dir, "supplier"))


@query("SELECT event_id, CASE WHEN value >= 50 THEN 1 ELSE 0 END AS class FROM events")
def threshold_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", threshold(F.col("value") / 100).alias("class"))


@query("SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 20")
def smoke_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_by_key(table(spark, sf_dir, "orders"), "o_orderkey", 20)


@query(
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 200"
)
def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A repeatable sample of 200 rows."""
    return first_by_hash(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 200)


@query(
    "SELECT doc_id, lang FROM documents ORDER BY md5(concat(doc_id, '|42')), doc_id LIMIT 50"
)
def seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A repeatable sample of 50 rows under a seed."""
    return first_by_hash(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", 50, salt=42)


_FINGERPRINT = (
    "SELECT CAST('0x' || substr(md5(concat("
    + ", ".join(f"coalesce(CAST(length(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("o_orderkey", "o_custkey", "status", "o_orderpriority"))
    + ")), 1, 8) AS BIGINT) AS h "
    "FROM (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN concat(o_orderstatus, '|', o_orderkey % 3) END AS status FROM orders)"
)


@query(
    f"SELECT count(*) AS rows, bit_xor(h) AS hash_xor, CAST(sum(h) AS BIGINT) AS hash_sum FROM ({_FINGERPRINT})"
)
def fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count and order-free hash of a table version, some fields null and some with marks in them."""
    columns = ["o_orderkey", "o_custkey", "status", "o_orderpriority"]
    status = F.expr("CASE WHEN o_orderstatus <> 'P' THEN concat(o_orderstatus, '|', o_orderkey % 3) END")
    printed = table_fingerprint(table(spark, sf_dir, "orders").withColumn("status", status), columns, portable=True)
    return printed.withColumn("hash_sum", F.col("hash_sum").cast("long"))


@query(
    "SELECT event_id, event_type IN ('view', 'click') AS truthy, "
    "CASE WHEN event_type = 'error' THEN 1 WHEN event_type = 'view' THEN 3 ELSE 2 END AS members, "
    "event_type IN ('error', 'view') AS listed, "
    "concat('scorer-', user_id) AS served_name, concat('main.', event_type, '.scorer') AS full_name FROM events"
)
def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truthy text, comma lists, membership, dotted names."""
    kind = F.col("event_type")
    flag = F.when(kind == "view", " YES ").when(kind == "click", "1").when(kind == "error", "off")
    members = (
        F.when(kind == "error", " error ,,")
        .when(kind == "view", "a, view ,b,")
        .otherwise(F.lit("x,y"))
    )
    full_name = dotted(F.lit("main"), kind, F.lit("scorer"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        is_truthy(flag).alias("truthy"),
        F.size(split_list(members)).alias("members"),
        in_list(kind, members).alias("listed"),
        served_name(full_name, F.col("user_id")).alias("served_name"),
        full_name.alias("full_name"),
    )


@query(
    "SELECT event_id, strftime(ts, '%d%m%y-%H%M%S') AS stamp, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso FROM events"
)
def time_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", run_stamp(F.col("ts")).alias("stamp"), iso_text(F.col("ts")).alias("iso")
    )


@query(
    "SELECT CAST('0x' || substr(md5(CAST(o_custkey AS VARCHAR)), 1, 8) AS BIGINT) % 16 AS bucket, count(*) AS n, "
    "min(md5(CAST(o_custkey AS VARCHAR))) AS first_hash FROM orders GROUP BY 1"
)
def key_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per portable hash bucket."""
    bucket = F.pmod(md5_int(F.col("o_custkey")), F.lit(16)).alias("bucket")
    first = F.min(sample_order(F.col("o_custkey"))).alias("first_hash")
    return table(spark, sf_dir, "orders").groupBy(bucket).agg(F.count("*").alias("n"), first)


@query("SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand")
def catalog_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table fully replaced and read behind its existence check."""
    part = table(spark, sf_dir, "part")
    path = scratch_path(spark, "part")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    replace_table(part.select("p_partkey"), name, path=path)
    replace_table(part.select("p_partkey", "p_brand"), name, path=path)
    return require_table(spark, name).groupBy("p_brand").agg(F.count("*").alias("n"))
