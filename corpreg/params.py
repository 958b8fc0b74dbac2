"""Run parameters of the resolution pipeline.

Every operator takes its knobs from a :class:`Params` instance instead of
reading a config file, so one session can run several configurations.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, replace

# ---------------------------------------------------------------------------
# Fixed values. These must stay equal to the behaviour being reproduced,
# otherwise ids, matches, tags and verdicts change.
# ---------------------------------------------------------------------------
SUFFIX_REGEX = r"(?i)\b(inc|llc|corp|incorporated|group|co|ltd|international)\b|[.,_]"
LEVENSHTEIN_THRESHOLD = 2
HISTORICAL_MATCH_RATE_PCT = 65.0
MATCH_RATE_DEVIATION_PCT = 15.0
MIN_AVG_REVENUE = 10000.0
PROFIT_THRESHOLD = 100000.0
DELIVERY_TARGET_PCT = 99.9
BASELINE_ACCURACY = 0.85
LR_MAX_ITER = 10
TRAIN_FRACTION = 0.8
SPLIT_SEED = 42
DEFAULT_MODEL_VERSION = "v1.0.0"
RISK_KEYWORDS = ("fine", "breach", "fraud")
RISK_PREFIX = "Flagged Local Risk Scan: "
RISK_NONE = "None Identified"
S1_NAME = "corporate_name_S1"
S2_NAME = "corporate_name_S2"
S1_COLUMNS = ("corporate_name_S1", "address", "activity_places", "top_suppliers")
S2_COLUMNS = ("corporate_name_S2", "main_customers", "revenue", "profit")
REGISTRY_COLUMNS = (
    "corporate_id",
    "corporate_name",
    "address",
    "activity_places",
    "top_suppliers",
    "main_customers",
    "revenue",
    "profit",
    "adverse_media_news",
)
NUMERIC_COLUMNS = ("revenue", "profit")
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Params:
    suffix_regex: str = SUFFIX_REGEX
    max_edits: int = LEVENSHTEIN_THRESHOLD
    # names shorter than this after normalization never match fuzzily;
    # 0 keeps the original behaviour where "" is within k of short names
    min_name_length: int = 0
    historical_match_rate_pct: float = HISTORICAL_MATCH_RATE_PCT
    match_rate_deviation_pct: float = MATCH_RATE_DEVIATION_PCT
    # drift against past runs: how many of them, and how many of their deviations
    history_runs: int = 10
    history_deviations: float = 3.0
    min_avg_revenue: float = MIN_AVG_REVENUE
    delivery_target_pct: float = DELIVERY_TARGET_PCT
    profit_threshold: float = PROFIT_THRESHOLD
    supplier_delimiter: str = ","
    feature_cols: tuple[str, ...] = ("revenue", "supplier_count")
    label_col: str = "high_profit_indicator"
    lr_max_iter: int = LR_MAX_ITER
    # "logistic": Spark ML's logistic regression, lr_max_iter steps;
    # "irls": iteratively reweighted least squares, run to convergence
    fit: str = "logistic"
    train_fraction: float = TRAIN_FRACTION
    split_seed: int = SPLIT_SEED
    baseline_accuracy: float = BASELINE_ACCURACY
    risk_keywords: tuple[str, ...] = RISK_KEYWORDS
    # split every fuzzy-join key this many ways up front (1 = leave hot keys
    # to AQE's skew-join split)
    segment_salt_buckets: int = 1


def params_from_config(config: dict | str, base: Params = Params()) -> Params:
    """Params from a thresholds config (a dict or a JSON file path) laid out as
    ``entity_resolution.{suffix_regex, levenshtein_threshold}``,
    ``drift_monitoring.{historical_average_pct, threshold_deviation_pct}``,
    ``data_quality.min_avg_revenue`` and ``ml_training.{lr_max_iterations,
    profit_threshold, feature_cols, target_col, baseline_accuracy,
    random_split_ratio, random_seed}``. Missing keys keep ``base``."""
    if isinstance(config, str):
        with open(config, encoding="utf-8") as f:
            config = json.load(f)
    er = config.get("entity_resolution", {})
    dm = config.get("drift_monitoring", {})
    dq = config.get("data_quality", {})
    ml = config.get("ml_training", {})
    changes = {
        "suffix_regex": er.get("suffix_regex"),
        "max_edits": er.get("levenshtein_threshold"),
        "historical_match_rate_pct": dm.get("historical_average_pct"),
        "match_rate_deviation_pct": dm.get("threshold_deviation_pct"),
        "min_avg_revenue": dq.get("min_avg_revenue"),
        "lr_max_iter": ml.get("lr_max_iterations"),
        "profit_threshold": ml.get("profit_threshold"),
        "feature_cols": tuple(ml["feature_cols"]) if "feature_cols" in ml else None,
        "label_col": ml.get("target_col"),
        "baseline_accuracy": ml.get("baseline_accuracy"),
        "train_fraction": ml["random_split_ratio"][0] if "random_split_ratio" in ml else None,
        "split_seed": ml.get("random_seed"),
    }
    return replace(base, **{k: v for k, v in changes.items() if v is not None})
