"""Evaluation windows derived for a whole table of end times."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.clock import half_hour, span
from ..settings import RAINFALL, SUBSURFACE, Rainfall, Subsurface


def evaluation_grid(ends: DataFrame, cfg: Subsurface = SUBSURFACE, end: str = "end_ts") -> DataFrame:
    """Half-hour end, window start, lead-in start and frame length per end time."""
    e = half_hour(end)
    start = e - span(mins=int(cfg.window_days * 1440))
    return ends.select(
        *[c for c in ends.columns if c != end],
        e.alias("end_ts"),
        start.alias("start_ts"),
        (start - span(mins=cfg.lead_slots * cfg.slot_minutes)).alias("offset_ts"),
        F.lit(cfg.points).alias("points"),
    )


def rain_grid(ends: DataFrame, cfg: Rainfall = RAINFALL, end: str = "end_ts") -> DataFrame:
    e = half_hour(end)
    start = e - span(days=cfg.window_days)
    return ends.select(
        *[c for c in ends.columns if c != end],
        e.alias("end_ts"),
        start.alias("start_ts"),
        (start - span(days=cfg.sum_days)).alias("offset_ts"),
    )
