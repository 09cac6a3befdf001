"""Pipeline parameters.

Every operator takes these as arguments; the values here are only defaults.
"""

from __future__ import annotations

from dataclasses import dataclass
from statistics import NormalDist

# ---------------------------------------------------------------------------
# Fixed values. These must equal the behaviour being reproduced, so they are
# stated plainly and together.
# ---------------------------------------------------------------------------
RANDOM_SEED = 42
HOLDOUT_WEEKS = 12
LAGS = (1, 2, 4, 12)
ROLLING_WINDOWS = (4, 12)
MOVING_AVERAGE_WINDOW = 4
RIDGE_ALPHA = 1.0

TREE_N_ESTIMATORS = 500
TREE_LEARNING_RATE = 0.05
TREE_NUM_LEAVES = 31
TREE_MAX_DEPTH = -1  # no limit
TREE_MIN_CHILD_SAMPLES = 20
TREE_COLSAMPLE = 0.8
EARLY_STOPPING_ROUNDS = 50
VALIDATION_FRACTION = 0.1

LEAD_TIME_WEEKS = 2.0
REVIEW_PERIOD_WEEKS = 4.0
SERVICE_LEVEL = 0.95
HOLDING_COST_PCT = 0.20
UNIT_VALUE = 25.00
ORDERING_COST = 150.0
WEEKS_PER_YEAR = 52
ALERT_THRESHOLD = 1.10
MAPE_EPS = 1e-6

TYPE_CODES = {"A": 0, "B": 1, "C": 2}

TIME_FEATURES = [
    "trend", "week_sin", "week_cos", "month_sin", "month_cos",
    "quarter", "is_month_end", "IsHoliday",
]
STORE_FEATURES = ["type_code", "size_norm"]
LAG_FEATURES = [
    "sales_lag_1", "sales_lag_2", "sales_lag_4", "sales_lag_12",
    "sales_roll_4", "sales_roll_12",
]
LINEAR_FEATURES = TIME_FEATURES + STORE_FEATURES
TREE_FEATURES = TIME_FEATURES + STORE_FEATURES + LAG_FEATURES

NAIVE_NAME = "Naive (Last Value)"
RIDGE_NAME = "Ridge Regression"
TREES_NAME = "Gradient Boosted Trees"
# ---------------------------------------------------------------------------


def z_score(service_level: float = SERVICE_LEVEL) -> float:
    """Inverse standard normal CDF at the service level, rounded to 4 digits."""
    return round(NormalDist().inv_cdf(service_level), 4)


def moving_average_name(window: int) -> str:
    return f"Moving Average ({window}w)"


@dataclass(frozen=True)
class InventoryParams:
    lead_time_weeks: float = LEAD_TIME_WEEKS
    service_level: float = SERVICE_LEVEL
    z_score: float | None = None  # given, it takes the place of the service level's
    ordering_cost: float = ORDERING_COST
    unit_value: float = UNIT_VALUE
    holding_cost_pct: float = HOLDING_COST_PCT
    review_period_weeks: float = REVIEW_PERIOD_WEEKS
    alert_threshold: float = ALERT_THRESHOLD

    def __post_init__(self) -> None:
        if self.z_score is None:
            object.__setattr__(self, "z_score", z_score(self.service_level))


@dataclass(frozen=True)
class TreeParams:
    max_iter: int = TREE_N_ESTIMATORS
    step_size: float = TREE_LEARNING_RATE
    # Spark grows trees level by level; depth 5 holds at most 32 leaves,
    # the closest match to a 31-leaf leaf-wise tree.
    max_depth: int = 5
    min_instances_per_node: int = TREE_MIN_CHILD_SAMPLES
    feature_subset: float = TREE_COLSAMPLE
    # Row subsampling without a bagging frequency has no effect in the
    # original learner, so it is off here too.
    subsampling_rate: float = 1.0
    early_stopping_rounds: int = EARLY_STOPPING_ROUNDS
    validation_fraction: float = VALIDATION_FRACTION
    validation_mode: str = "chronological"
    seed: int = RANDOM_SEED
    # Split candidates per feature; the original learner's default is 255.
    max_bins: int = 128
    # Size of the training partitions: it fixes their number for given rows.
    rows_per_partition: int = 32_768
    checkpoint_interval: int = 10


@dataclass(frozen=True)
class LeafTreeParams:
    """Trees grown leaf by leaf, with the original learner's settings."""

    n_estimators: int = TREE_N_ESTIMATORS
    learning_rate: float = TREE_LEARNING_RATE
    num_leaves: int = TREE_NUM_LEAVES
    max_depth: int = TREE_MAX_DEPTH
    min_child_samples: int = TREE_MIN_CHILD_SAMPLES
    colsample_bytree: float = TREE_COLSAMPLE
    max_bins: int = 255
    early_stopping_rounds: int = EARLY_STOPPING_ROUNDS
    validation_fraction: float = VALIDATION_FRACTION
    validation_mode: str = "chronological"
    seed: int = RANDOM_SEED
    # Rows that the driver takes to find the cut points. Where there are more,
    # the cut points of all rows are found by passes over them.
    bin_sample_rows: int = 200_000
    # A task's share of the rows, and how many tasks share the work at most
    # (every task gets every other's histograms).
    rows_per_task: int = 500_000
    max_tasks: int = 32
    # Rounds that one job fits; what a lost executor costs at most.
    rounds_per_job: int = 200


#: A few trees of one split each, on features of few values.
STUMPS = LeafTreeParams(n_estimators=4, learning_rate=0.5, num_leaves=2, colsample_bytree=1.0)
STUMP_FEATURES = ["quarter", "type_code", "IsHoliday", "is_month_end"]
