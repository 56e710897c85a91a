"""Thresholds of the alert rules, one frozen dataclass per data family.

Fixed values: results must agree with the published operating thresholds.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Subsurface:
    slot_minutes: int = 30
    window_days: float = 3.0
    smooth_hours: float = 3.0
    window_ops: int = 2
    disp: float = 0.05
    vel2: float = 0.032
    vel3: float = 0.5
    axis_ratio: float = 0.1
    neighbours: int = 2
    stale_hours: int = 3
    lookback_days: int = 3
    position_hours: int = 4
    position_count: int = 7
    trend_hours: int = 3
    trend_count: int = 3

    @property
    def points(self) -> int:
        """Rows in one smoothing / regression frame."""
        return 1 + int(self.smooth_hours * 60 / self.slot_minutes)

    @property
    def lead_slots(self) -> int:
        """Slots before the window that feed its first smoothed velocity."""
        return self.window_ops * self.points - 1


@dataclass(frozen=True)
class Rainfall:
    slot_minutes: int = 30
    window_days: int = 10
    sum_days: int = 3
    near_share: float = 0.75
    gauges: int = 4


@dataclass(frozen=True)
class Surficial:
    v2: float = 0.25
    v3: float = 1.8
    min_cm: float = 1.0
    points: int = 10
    ci_slope: float = 1.49905955613175
    ci_intercept: float = -3.00263765777028
    ci_t_crit: float = 4.53047399738543
    ci_var_v_log: float = 215.515369339559
    ci_v_log_mean: float = 2.232839766
    ci_sum_res_square: float = 49.8880017417971
    ci_n: float = 30.0


SUBSURFACE = Subsurface()
RAINFALL = Rainfall()
SURFICIAL = Surficial()
EVALUATION_GAP = "90 minutes"
EVENT_GAP = "30 minutes"
