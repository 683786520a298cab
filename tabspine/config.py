"""Column roles, limits and model parameters, passed explicitly to every operator."""

from __future__ import annotations

from dataclasses import dataclass, field

# The census record layout, class names and missing tokens.
CSV_COLUMNS = (
    "age", "workclass", "fnlwgt", "education", "education-num", "marital-status", "occupation", "relationship",
    "race", "sex", "capital-gain", "capital-loss", "hours-per-week", "native-country", "income",
)
NUMERIC = ("age", "fnlwgt", "education_num", "capital_gain", "capital_loss", "hours_per_week")
CATEGORICAL = (
    "workclass", "education", "marital_status", "occupation", "relationship", "race", "sex", "native_country",
)
ENGINEERED = ("capital_net", "hours_over_40", "log_fnlwgt", "education_num_sq")
POSITIVE_CLASS = ">50K"
NEGATIVE_CLASS = "<=50K"
MISSING_TOKENS = ("nan", "None", "?", "")
SPLITS = ("train", "holdout")


@dataclass(frozen=True)
class Roles:
    """Which column plays which part in a supervised table."""

    id_col: str = "row_id"
    label_col: str = "income_gt_50k"
    split_col: str = "split"
    numeric: tuple[str, ...] = NUMERIC
    categorical: tuple[str, ...] = CATEGORICAL
    engineered: tuple[str, ...] = ENGINEERED
    event_time_col: str | None = None
    dataset: str = "census income"
    target_definition: str = "income_gt_50k is 1 if the class is >50K, 0 if it is <=50K"
    positive_class: str = POSITIVE_CLASS
    negative_class: str = NEGATIVE_CLASS

    @property
    def features(self) -> tuple[str, ...]:
        return self.numeric + self.categorical

    @property
    def model_numeric(self) -> tuple[str, ...]:
        return self.numeric + self.engineered

    @property
    def model_features(self) -> tuple[str, ...]:
        return self.features + self.engineered

    @property
    def contract(self) -> dict[str, str]:
        """Model feature name to logical type, in model order."""
        return {c: "double" if c in self.model_numeric else "string" for c in self.model_features}


@dataclass(frozen=True)
class Limits:
    """Thresholds of the fail-closed gates."""

    min_table_rows: int = 200
    min_eval_rows: int = 200
    max_null_rate: float = 0.4
    min_roc_auc: float = 0.70
    threshold: float = 0.5
    train_fraction: float = 0.8
    compare_metric: str = "roc_auc"
    higher_is_better: bool = True
    compare_margin: float = 0.0


@dataclass(frozen=True)
class TreeParams:
    """Boosted tree settings."""

    trees: int = 80
    depth: int = 4
    rate: float = 0.1
    row_sample: float = 0.9
    column_sample: float = 0.9
    seed: int = 42


@dataclass(frozen=True)
class Config:
    roles: Roles = field(default_factory=Roles)
    limits: Limits = field(default_factory=Limits)
    trees: TreeParams = field(default_factory=TreeParams)
