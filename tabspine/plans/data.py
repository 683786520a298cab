"""Jobs from raw files to feature table and label spine."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabspine.config import Config, Roles
from tabspine.functions.keys import hash_split
from tabspine.operators.checks import key_check, require, require_schema, table_checks
from tabspine.operators.clean import normalize_records, normalize_split, raw_columns, require_known_labels
from tabspine.operators.engineer import feature_frame
from tabspine.operators.ordering import chronological_split
from tabspine.operators.profile import table_profile
from tabspine.operators.spine import label_spine
from tabspine.sources.changelog import ChangeLog
from tabspine.sources.records import load_records, require_few_malformed
from tabspine.sources.scratch import materialize
from tabspine.sources.tables import VersionedTable


def seeded_rows(
    spark: SparkSession, train_paths: str | Sequence[str], holdout_paths: str | Sequence[str], roles: Roles = Roles(), quarantine: int = 0
) -> DataFrame:
    """Normalised train and holdout files as one raw table, keys 1..N in train-then-holdout line order.

    Lines are parsed once and numbered where they lie. Lines with too few or too many fields are no rows: ``quarantine`` tells how
    many of them are borne, none by default. Unknown class names are looked for in the written rows.
    """

    def parse(lines: DataFrame, part: int) -> DataFrame:
        extra = [c for c in lines.columns if c.startswith("_")]
        return normalize_records(lines, roles, ("train", "holdout")[part], extra=[*extra, "income"], strict=False)

    found = load_records(spark, [train_paths, holdout_paths], parse=parse)
    require_few_malformed(found.malformed, quarantine)
    keyed = found.rows.withColumnRenamed("_number", roles.id_col)
    return raw_columns(require_known_labels(keyed, "income"), roles)


def seed_job(
    spark: SparkSession,
    train_paths: str | Sequence[str],
    holdout_paths: str | Sequence[str],
    raw: VersionedTable,
    roles: Roles = Roles(),
    quarantine: int = 0,
) -> int:
    """Replace the raw table from files; returns its version."""
    return raw.replace(seeded_rows(spark, train_paths, holdout_paths, roles, quarantine))


def check_job(raw: DataFrame, config: Config = Config(), as_of: datetime | str | None = None) -> DataFrame:
    """Raise unless the raw table passes every check; returns the check rows."""
    checks = table_checks(raw, config.roles, config.limits, as_of)
    require(checks)
    return checks


def profile_job(raw: DataFrame, profile: VersionedTable, roles: Roles = Roles(), approximate: bool = False) -> int:
    """Replace the profile table."""
    return profile.replace(table_profile(raw, roles, approximate).coalesce(1))


def with_split(raw: DataFrame, config: Config = Config()) -> DataFrame:
    """An existing split is normalised; else rows are split by event time if there is one, else by key hash."""
    roles = config.roles
    if roles.split_col in raw.columns:
        return normalize_split(raw, roles)
    if roles.event_time_col:
        return chronological_split(
            raw, roles.event_time_col, roles.id_col, config.limits.train_fraction, roles.split_col
        )
    return raw.withColumn(roles.split_col, hash_split(F.col(roles.id_col)))


def publish_features(raw: DataFrame, features: VersionedTable, roles: Roles = Roles(), feed: ChangeLog | None = None) -> int:
    """Replace the feature table after refusing duplicate keys, a leaked label, or a broken contract.

    With a ``feed``, the changes from the version it was fed last are staged first, so that a crash loses none.
    """
    frame = feature_frame(raw, roles)
    require_schema(frame, roles)
    require(key_check(raw, roles.id_col))
    if feed is None:
        return features.replace(frame)
    feed.catch_up(features)
    if not features.exists():
        version = features.replace(frame)
        feed.start(version)
        return version
    frame = materialize(frame, "features")
    version = features.reserve()
    feed.stage(features.read(), frame, version)
    features.replace(frame, number=version)
    feed.settle(features)
    return version


def feature_job(
    raw: DataFrame,
    spine: VersionedTable,
    features: VersionedTable,
    feed: ChangeLog | None = None,
    config: Config = Config(),
) -> None:
    """Label spine by split, feature table, and the changes from the feature version before, appended to the feed."""
    roles = config.roles
    split = with_split(raw, config)
    spine.replace(label_spine(split, roles), partition_by=[roles.split_col])
    publish_features(split, features, roles, feed)
