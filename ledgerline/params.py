"""Tunable constants of the pipeline, one place for all of them."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

# Fixed values that must equal the reference pipeline's configuration:
# risk weights .35 / .25 / .25 / .15, alert threshold 0.60, velocity window
# 300 s with thresholds 5 transactions or 10,000 in amount, z-score 3,
# high-risk merchant codes 7995 6051 5993 4829, data-quality gate of
# 1000 rows per day, 0.1 % null ids and 98.5 % reconciliation accuracy,
# 30 minutes of grace for incremental extracts.
HIGH_RISK_MCC = ("7995", "6051", "5993", "4829")


@dataclass(frozen=True)
class RiskParams:
    w_velocity: float = 0.35
    w_high_risk_mcc: float = 0.25
    w_geo: float = 0.25
    w_outlier: float = 0.15
    alert_threshold: float = 0.60
    velocity_window_s: int = 300
    velocity_count: int = 5
    velocity_amount: int = 10000
    zscore: float = 3.0
    high_risk_mcc: tuple[str, ...] = field(default=HIGH_RISK_MCC)


@dataclass(frozen=True)
class DqParams:
    min_daily_rows: int = 1000
    max_null_rate_pct: float = 0.1
    recon_target_pct: float = 98.5


@dataclass(frozen=True)
class IncrementalParams:
    grace_minutes: int = 30
    source_system: str = "core_banking_extract"


# Reconciliation: amounts differing by more than this are mismatches.
RECON_TOLERANCE = "0.01"

# Run date used by the reports on the test data (last event day + 1).
AS_OF = _dt.date(2024, 1, 31)

# Tokenisation salt used by tests; production passes its own key material.
TEST_SALT = "bGVkZ2VybGluZS10ZXN0LWtleQ=="

# Estimated size (bytes of the optimised plan) up to which a dimension is broadcast.
DIM_BROADCAST_MAX_BYTES = 8 << 20
