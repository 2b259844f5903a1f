"""Configuration: feature lists, validation rules, split sizes, model settings.

The values under "fixed values" must equal the behaviour being reproduced,
so they are stated once, plainly, here and imported everywhere else.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# fixed values (feature configuration)
# ---------------------------------------------------------------------------
DATE_FEATURES = (
    "year", "month", "day", "dayofweek", "quarter", "weekofyear", "is_weekend", "is_holiday",
)
LAGS = (1, 2, 3, 7, 14, 21, 30)
ROLLING_WINDOWS = (3, 7, 14, 21, 30)
ROLLING_FUNCS = ("mean", "std", "min", "max", "median")
CYCLICAL = (("month", 12), ("day", 31), ("dayofweek", 7))

# advanced features (exponentially weighted means, ratios)
EWM_SPANS = (7, 14)
RATIO_WINDOWS = (7, 30)
TARGET_ENCODING_SMOOTHING = 1.0

# ---------------------------------------------------------------------------
# fixed values (validation configuration)
# ---------------------------------------------------------------------------
REQUIRED_COLUMNS = ("date", "total_revenue", "store_id", "product_id")
DATA_TYPES = {
    "date": "date",
    "total_revenue": "double",
    "store_id": "string",
    "product_id": "string",
}
VALUE_RANGES = {"total_revenue": (0.0, 1_000_000.0)}
IQR_MULTIPLIER = 1.5
ZSCORE_LIMIT = 3.0
DRIFT_STD_MULTIPLIER = 3.0
KS_THRESHOLD = 0.1
RMSE_ALERT = 1000.0

# file-level checks run by the ingest step
SALES_REQUIRED = ("date", "store_id", "product_id", "quantity_sold", "revenue")
ISSUE_PREVIEW = 5

# ---------------------------------------------------------------------------
# fixed values (training / inference configuration)
# ---------------------------------------------------------------------------
TEST_SIZE = 0.2
VALIDATION_SIZE = 0.1
ENSEMBLE_MIN_WEIGHT = 0.2
FORECAST_HORIZON = 30
FORECAST_BAND = 0.10
CONFIDENCE_LEVELS = (0.8, 0.95)
HISTORY_TAIL = 30
# defaults used when a forecast input lacks a column
MISSING_COLUMN_DEFAULTS = {
    "quantity_sold": 100,
    "profit": 1000,
    "has_discount": 0,
    "customer_traffic": 500,
    "is_holiday": 0,
}
# basic feature set used when no trained feature list is known
FALLBACK_FEATURES = (
    "year", "month", "day", "dayofweek", "quarter", "is_weekend",
    "total_revenue_lag_1", "total_revenue_lag_7",
    "total_revenue_rolling_7_mean", "total_revenue_rolling_7_std",
)
TOP_FEATURES = 20
HISTOGRAM_BINS = 50

# boosted-tree settings (model A: depth-wise, model B: leaf-limited)
MODEL_A = {"maxIter": 100, "maxDepth": 6, "stepSize": 0.1, "seed": 42}
MODEL_B = {"maxIter": 100, "maxDepth": 5, "stepSize": 0.05, "seed": 42}  # 31 leaves ~ depth 5
SEARCH_SPACE_A = {
    "maxIter": (50, 300), "maxDepth": (3, 10), "stepSize": (0.01, 0.3),
    "subsamplingRate": (0.6, 1.0), "featureSubset": (0.6, 1.0), "minInfoGain": (0.0, 0.5),
}
SEARCH_SPACE_B = {
    "numLeaves": (20, 100), "stepSize": (0.01, 0.3), "maxIter": (50, 300),
    "minInstancesPerNode": (10, 50), "subsamplingRate": (0.6, 1.0), "featureSubset": (0.6, 1.0),
}
SEARCH_TRIALS = 50
EARLY_STOP_ROUNDS = 50


@dataclass(frozen=True)
class FeatureConfig:
    """Feature switches; defaults reproduce the training feature frame."""

    target: str = "total_revenue"
    date_col: str = "date"
    group_cols: tuple[str, ...] = ("store_id",)
    lags: tuple[int, ...] = LAGS
    windows: tuple[int, ...] = ROLLING_WINDOWS
    funcs: tuple[str, ...] = ROLLING_FUNCS
    # rolling frames include the current row (training parity); shift=1 is leak-free
    shift: int = 0
    min_periods: int = 1
