"""Run parameters.  All business constants live here, none in the operators."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from typing import Mapping

# ---------------------------------------------------------------------------
# They must equal the published ones for results to agree.
# ---------------------------------------------------------------------------
EXCLUDED_INVOICE_TYPES = ("S1", "S2", "S3", "S4")

SETTLED_CLAIM_STATUSES = (
    "Inspection Accepted",
    "Inspection Rejected",
    "AI : Inspection Rejected",
)

# Level map used for month-to-month movement (matched exactly).
MOVEMENT_LEVELS = {
    "Non Starter": 0,
    "Starter": 1,
    "Blue Club": 2,
    "Gold Plus Club": 3,
    "Platinum Club": 4,
    "Diamond Club": 5,
    "Acer Club": 6,
    "Chairman's Club": 7,
    "Chairman's Advisory Club": 8,
}

# Level map used for the model feature (matched after trim + upper case).
MODEL_LEVELS = {
    "NS": 0,
    "STARTER": 1,
    "BLUE CLUB": 2,
    "GOLD PLUS CLUB": 3,
    "PLATINUM CLUB": 4,
    "DIAMOND CLUB": 5,
    "ACER CLUB": 6,
    "CHAIRMAN'S CLUB": 7,
    "CHAIRMAN ADVISORY": 8,
}

# Monthly measures that are widened to one column per relative month.
PIVOT_MEASURES = (
    "total_sales",
    "total_invoices",
    "total_units",
    "avg_invoices",
    "avg_sales",
    "avg_units_purchased",
    "avg_sales_of_dealers_in_same_territory",
    "avg_orders_of_dealers_in_same_territory",
    "avg_units_of_dealers_in_same_territory",
    "avg_sales_of_dealers_in_same_dealer_club_category",
    "avg_orders_of_dealers_in_dealer_club_category",
    "avg_units_of_dealers_in_dealer_club_category",
    "sas_amount",
    "rotation",
    "terrwise_rotation",
    "dealerclub_wise_rotation",
    "exposure",
    "collection",
    "outstanding",
    "outstanding_0_30",
    "outstanding_30_45",
    "outstanding_45_60",
    "outstanding_60+",
    "total_credit_note_value",
    "avg_credit_note_value",
    "offline",
    "online",
    "total_orders",
    "unique_claims",
    "settled_claims",
    "active_claims",
    "visit_count",
)

# Boosted-tree defaults and the two search spaces.
TREE_DEFAULTS = {
    "n_estimators": 100,
    "max_depth": 6,
    "learning_rate": 0.1,
    "subsample": 0.8,
    "colsample": 0.8,
}

RANDOM_SPACE = {
    "n_estimators": [100, 200, 300, 500],
    "max_depth": [3, 4, 5, 6, 8, 10],
    "learning_rate": [0.001, 0.01, 0.05, 0.1, 0.2],
    "subsample": [0.6, 0.8, 1.0],
    "colsample": [0.6, 0.8, 1.0],
    "gamma": [0.0, 0.1, 0.2, 0.3],
    "min_child_weight": [1, 3, 5, 7],
}

GRID_SPACE = {
    "n_estimators": [200, 300],
    "max_depth": [4, 5, 6],
    "learning_rate": [0.05, 0.1],
    "subsample": [0.8, 1.0],
    "colsample": [0.8, 1.0],
}
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Settings:
    """Parameters of one run.

    ``as_of`` replaces the wall clock; when it is left empty the reference
    date found in the sales data is used, so a rerun gives the same rows.
    ``reference`` pins the reference moment and saves the scan that finds it.
    """

    group: str = "Z001"
    excluded_types: tuple[str, ...] = EXCLUDED_INVOICE_TYPES
    churn_days: int = 90
    window_months: int = 12
    min_window_end: dt.date = dt.date(2022, 12, 1)
    as_of: dt.date | None = None
    reference: dt.datetime | None = None
    settled_statuses: tuple[str, ...] = SETTLED_CLAIM_STATUSES
    movement_levels: Mapping[str, int] = field(default_factory=lambda: dict(MOVEMENT_LEVELS))
    model_levels: Mapping[str, int] = field(default_factory=lambda: dict(MODEL_LEVELS))
    unmoved_label: str = "no_change"
    relative_months: int = 12
    recent_days: int = 365
    severity_days: int = 120
    test_share: float = 0.2
    seed: int = 42
    unseen_codes: str = "error"
    confidence_floor: float = 1e-4
    decision_threshold: float = 0.5
    high_risk_threshold: float = 0.7
    top_features: int = 10
    top_global_features: int = 20
    stamp_zone: str = "Asia/Kolkata"
    cv_folds: int = 5
    search_draws: int = 20
    importance_percentile: float = 0.75
