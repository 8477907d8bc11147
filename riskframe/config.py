"""Column groups, contracts and job settings: typed, immutable, passed as arguments."""

from __future__ import annotations

from dataclasses import dataclass, field

KEY = "account_id"
TARGET = "default_flag"

# The column names of the account table and of its label.
PAY_COLUMNS = ("PAY_0", "PAY_2", "PAY_3", "PAY_4", "PAY_5", "PAY_6")
BILL_COLUMNS = tuple(f"BILL_AMT{m}" for m in range(1, 7))
PAYMENT_COLUMNS = tuple(f"PAY_AMT{m}" for m in range(1, 7))
NUMERIC_FEATURES = ("LIMIT_BAL", "AGE", *BILL_COLUMNS, *PAYMENT_COLUMNS)
CATEGORICAL_FEATURES = ("SEX", "EDUCATION", "MARRIAGE", *PAY_COLUMNS)
TARGET_SOURCE_NAMES = ("default payment next month", "default.payment.next.month", "Y")
RAW_KEY = "ID"

INPUT_COLUMNS = (
    "LIMIT_BAL", "SEX", "EDUCATION", "MARRIAGE", "AGE",
    *PAY_COLUMNS, *BILL_COLUMNS, *PAYMENT_COLUMNS,
)


@dataclass(frozen=True)
class ColumnRule:
    """What one column must look like; ``kind`` is ``int`` or ``float``."""

    column: str
    kind: str
    minimum: float | None = None
    maximum: float | None = None
    allowed: tuple[int, ...] | None = None


@dataclass(frozen=True)
class Contract:
    """A named rule set plus the thresholds that decide the overall verdict."""

    name: str
    rules: tuple[ColumnRule, ...]
    max_missing_pct: float = 5.0
    max_duplicate_pct: float = 1.0
    drift_threshold: float = 0.1
    outlier_threshold: float = 3.0

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(rule.column for rule in self.rules)

    def without(self, *columns: str) -> "Contract":
        kept = tuple(r for r in self.rules if r.column not in columns)
        return Contract(self.name, kept, self.max_missing_pct, self.max_duplicate_pct,
                        self.drift_threshold, self.outlier_threshold)


# The bounds and code sets of the account contract.
TARGET_RULE = ColumnRule(TARGET, "int", allowed=(0, 1))
TRAINING_CONTRACT = Contract(
    "training",
    (
        ColumnRule("LIMIT_BAL", "int", 10000, 1000000),
        ColumnRule("SEX", "int", allowed=(1, 2)),
        ColumnRule("EDUCATION", "int", allowed=(0, 1, 2, 3, 4, 5, 6)),
        ColumnRule("MARRIAGE", "int", allowed=(0, 1, 2, 3)),
        ColumnRule("AGE", "int", 18, 100),
        *(ColumnRule(c, "int", -2, 8) for c in PAY_COLUMNS),
        ColumnRule("BILL_AMT1", "float", -165580, 964511),
        ColumnRule("BILL_AMT2", "float", -69777, 983931),
        ColumnRule("BILL_AMT3", "float", -157264, 1664089),
        ColumnRule("BILL_AMT4", "float", -170000, 891586),
        ColumnRule("BILL_AMT5", "float", -81334, 927171),
        ColumnRule("BILL_AMT6", "float", -339603, 961664),
        ColumnRule("PAY_AMT1", "float", 0, 873552),
        ColumnRule("PAY_AMT2", "float", 0, 1684259),
        ColumnRule("PAY_AMT3", "float", 0, 896040),
        ColumnRule("PAY_AMT4", "float", 0, 621000),
        ColumnRule("PAY_AMT5", "float", 0, 426529),
        ColumnRule("PAY_AMT6", "float", 0, 528666),
        TARGET_RULE,
    ),
)
# The stricter bounds applied to records that arrive one by one.
SERVING_CONTRACT = Contract(
    "serving",
    (
        ColumnRule("LIMIT_BAL", "int", 10000, 1000000),
        ColumnRule("SEX", "int", 1, 2),
        ColumnRule("EDUCATION", "int", 1, 6),
        ColumnRule("MARRIAGE", "int", 1, 3),
        ColumnRule("AGE", "int", 18, 100),
        *(ColumnRule(c, "int", -2, 8) for c in PAY_COLUMNS),
        *(ColumnRule(c, "float") for c in BILL_COLUMNS),
        *(ColumnRule(c, "float", 0) for c in PAYMENT_COLUMNS),
    ),
)
CONTRACTS = {c.name: c for c in (TRAINING_CONTRACT, SERVING_CONTRACT)}


@dataclass(frozen=True)
class RiskBands:
    """Ascending cut points and one label per interval.

    ``closed="left"`` puts a value equal to a cut into the upper band, ``"right"``
    leaves it in the lower one. A missing probability falls into the last band.
    """

    cuts: tuple[float, ...]
    labels: tuple[str, ...]
    closed: str = "left"

    def __post_init__(self) -> None:
        if len(self.labels) != len(self.cuts) + 1:
            raise ValueError("one label more than cuts is needed")
        if self.closed not in ("left", "right"):
            raise ValueError("closed must be 'left' or 'right'")


# The cut points and labels of the three published band sets.
DEFAULT_BANDS = RiskBands((0.3, 0.6), ("Low Risk", "Medium Risk", "High Risk"))
EXPLAIN_BANDS = RiskBands((0.4, 0.7), ("Low", "Medium", "High"), closed="right")
DOCUMENTED_BANDS = RiskBands((0.3, 0.7), ("LOW RISK", "MEDIUM RISK", "HIGH RISK"))


@dataclass(frozen=True)
class SplitConfig:
    test_share: float = 0.2
    seed: int = 42
    stratify: bool = True


@dataclass(frozen=True)
class FeatureConfig:
    ratios: bool = True
    payments: bool = True
    balances: bool = True


@dataclass(frozen=True)
class AlgorithmConfig:
    """One classifier of the leaderboard: a name, a family and its parameter grid."""

    name: str
    family: str
    grid: dict[str, tuple] = field(default_factory=dict)


# The published parameter grids, and the smaller ones used when none is configured.
LOGISTIC_GRID = {"C": (0.01, 0.1, 1.0, 10.0), "penalty": ("l1", "l2"), "solver": ("liblinear", "saga")}
FOREST_GRID = {"n_estimators": (100, 200, 300), "max_depth": (10, 20, 30), "min_samples_split": (2, 5, 10), "min_samples_leaf": (1, 2, 4)}
BOOSTING_GRID = {"n_estimators": (100, 200), "learning_rate": (0.01, 0.1, 0.2), "max_depth": (3, 5, 7)}
EXTREME_BOOSTING_GRID = {
    "n_estimators": (100, 200, 300),
    "max_depth": (3, 5, 7),
    "learning_rate": (0.01, 0.1, 0.2),
    "subsample": (0.8, 0.9, 1.0),
    "colsample_bytree": (0.8, 0.9, 1.0),
}
FALLBACK_GRIDS = {
    "Logistic Regression": {"C": (0.1, 1.0, 10.0), "penalty": ("l2",)},
    "Random Forest": {"n_estimators": (100, 200), "max_depth": (10, 20), "min_samples_leaf": (1, 2)},
    "Gradient Boosting": {"n_estimators": (100, 200), "learning_rate": (0.01, 0.1), "max_depth": (3, 5)},
    "XGBClassifier": {"n_estimators": (100, 200), "max_depth": (3, 5), "learning_rate": (0.01, 0.1), "subsample": (0.8, 1.0)},
}
FAMILIES = {"Logistic Regression": "logistic", "Random Forest": "forest", "Gradient Boosting": "boosting",
            "XGBClassifier": "extreme"}


def algorithm(name: str, grid: dict[str, tuple] | None = None) -> AlgorithmConfig:
    """An algorithm by name; without a configured grid it gets the built-in one."""
    return AlgorithmConfig(name, FAMILIES[name], FALLBACK_GRIDS[name] if grid is None else grid)


LOGISTIC = algorithm("Logistic Regression", LOGISTIC_GRID)
RANDOM_FOREST = algorithm("Random Forest", FOREST_GRID)
GRADIENT_BOOSTING = algorithm("Gradient Boosting", BOOSTING_GRID)
EXTREME_BOOSTING = algorithm("XGBClassifier", EXTREME_BOOSTING_GRID)


@dataclass(frozen=True)
class TrainerConfig:
    algorithms: tuple[AlgorithmConfig, ...] = (LOGISTIC,)
    folds: int = 5
    seed: int = 42
    max_iter: int = 1000
    tolerance: float = 1e-4
    parallelism: int = 8
    select_by: str = "cv"
    max_points: int | None = None
    within: dict[str, tuple] = field(default_factory=dict)
    warn_below: float = 0.6


@dataclass(frozen=True)
class ExplainConfig:
    sample_rows: int = 1000
    background_rows: int = 100
    top_features: int = 10
    permutations: int = 10
    seed: int = 42
    #: Tree models: ``cover`` lets an unknown feature follow the training cover, ``background`` compares with background rows.
    trees: str = "cover"
    #: Other classifiers: ``permutations`` of the features, or ``kernel``-weighted coalitions, at most so many.
    others: str = "permutations"
    coalitions: int = 2048


@dataclass(frozen=True)
class JobConfig:
    split: SplitConfig = SplitConfig()
    features: FeatureConfig = FeatureConfig()
    trainer: TrainerConfig = TrainerConfig()
    explain: ExplainConfig = ExplainConfig()
    contract: Contract = TRAINING_CONTRACT
    gate: bool = True
