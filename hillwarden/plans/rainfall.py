"""Rain gauges: cumulative rain, thresholds, and when to write the outcome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.clock import release_time, right_closed_slot, span
from ..operators.clean import drop_tagged
from ..settings import RAINFALL, Rainfall


def sum_or_null(value: str) -> Column:
    """Sum that is NULL, not zero, when there is nothing to add."""
    return F.sum(value)


def cumulative_at(rain: DataFrame, keys: list[str], end: Column, cfg: Rainfall = RAINFALL) -> DataFrame:
    """One-day and three-day totals up to ``end`` from slot-labelled rain."""
    t, v = F.col("ts"), F.col("rain")
    d = rain.filter((t > end - span(days=cfg.sum_days)) & (t <= end))
    any_ = F.count(v)
    one = F.coalesce(F.sum(F.when(t > end - span(days=1), v)), F.lit(0.0))
    return d.groupBy(*keys).agg(
        F.when(any_ > 0, one).alias("one_day"), F.sum(v).alias("three_day")
    )


def gauge_totals(rain: DataFrame, tags: DataFrame | None, end: Column, cfg: Rainfall = RAINFALL) -> DataFrame:
    """Totals of every gauge with data newer than a day; all gauges at once.

    Placeholder rows (-1) do not count as data; other negatives are dropped
    after the freshness check, as are tagged stretches.
    """
    lo = end - span(days=cfg.sum_days) - span(mins=cfg.slot_minutes)
    d = rain.filter((F.col("ts") > lo) & (F.col("ts") < end) & (F.col("rain") != -1))
    if tags is not None:
        d = drop_tagged(d, tags)
    slot = right_closed_slot("ts", cfg.slot_minutes)
    ok = F.col("rain") >= 0
    # A slot enters the window by its label, so the partial slot at the left edge stays out.
    in3 = ok & (slot > end - span(days=cfg.sum_days))
    in1 = ok & (slot > end - span(days=1))
    g = d.groupBy("rain_id").agg(
        F.max("ts").alias("latest"),
        F.count(F.when(ok & (slot >= lo), 1)).alias("__n"),
        F.sum(F.when(in1, F.col("rain"))).alias("__one"),
        F.sum(F.when(in3, F.col("rain"))).alias("__three"),
    )
    has = F.col("__n") > 0
    return g.filter(F.col("latest") > end - span(days=1)).select(
        "rain_id", "latest",
        F.when(has, F.coalesce("__one", F.lit(0.0))).alias("one_day"),
        F.when(has, F.coalesce("__three", F.lit(0.0))).alias("three_day"),
    )


def rainfall_alerts(
    rain: DataFrame, priorities: DataFrame, sites: DataFrame, end: Column, tags: DataFrame | None = None, cfg: Rainfall = RAINFALL
) -> DataFrame:
    """Level of every site from its nearest gauge that has fresh data.

    ``priorities``: site_id, rain_id, distance (a few gauges per site).
    Level 1 above either threshold, -1 without data, else 0.
    """
    tot = gauge_totals(rain, tags, end, cfg)
    best = (
        priorities.join(tot, "rain_id")
        .groupBy("site_id")
        .agg(F.min_by(F.struct("rain_id", "one_day", "three_day"), F.struct("distance", "rain_id")).alias("g"))
    )
    d = sites.select("site_id", "threshold_value").join(best, "site_id", "left")
    half, full = F.col("threshold_value") / 2, F.col("threshold_value")
    one, three = F.col("g.one_day"), F.col("g.three_day")
    hit = F.coalesce((one >= half) | (three >= full), F.lit(False))
    return d.select(
        "site_id", F.col("g.rain_id").alias("rain_id"), one.alias("one_day"), three.alias("three_day"),
        half.alias("half_max"), full.alias("full_max"),
        F.when(hit, 1).when(one.isNull(), -1).otherwise(0).alias("alert_level"),
    )


def rain_codes(summary: DataFrame, cfg: Rainfall = RAINFALL) -> DataFrame:
    """Rows to store: a (one day), b (three days), x (close to a threshold)."""
    one, three, half, full = (F.col(c) for c in ("one_day", "three_day", "half_max", "full_max"))
    item = lambda code, cum, thr: F.struct(F.lit(code).alias("rain_alert"), cum.alias("cumulative"), thr.alias("threshold"))
    near = F.when(one >= half * cfg.near_share, item("x", one, half)).when(three >= full * cfg.near_share, item("x", three, full))
    codes = F.when(
        F.col("alert_level") == 1, F.array(F.when(one >= half, item("a", one, half)), F.when(three >= full, item("b", three, full)))
    ).when(F.col("alert_level") == 0, F.array(near))
    return summary.select("site_id", "rain_id", "alert_level", F.explode(F.array_compact(codes)).alias("c")).select(
        "site_id", "rain_id", "alert_level", "c.*"
    )


def stored_codes(summary: DataFrame, gate: DataFrame, cfg: Rainfall = RAINFALL) -> DataFrame:
    """`rain_codes` that are really stored: a and b always, x only where the gate is open.

    ``gate``: site_id, write, as `rain_write_gate` gives it; a site without a
    row there is closed.
    """
    codes = rain_codes(summary, cfg)
    opened = gate.filter("write").select("site_id").distinct().withColumn("__open", F.lit(True))
    return codes.join(opened, "site_id", "left").filter((F.col("alert_level") == 1) | F.col("__open")).drop("__open")


def rain_write_gate(public_levels: DataFrame, starts: DataFrame, triggers: DataFrame, end: Column) -> DataFrame:
    """Sites whose x / no-alert outcome must be written at ``end``.

    ``public_levels``: site_id, alert_level at ``end``; ``starts``: site_id,
    event_start. The gate opens half an hour before the validity of the last
    positive trigger runs out (one day, two with a level-3 trigger).
    """
    raised = public_levels.filter("alert_level > 0").select("site_id")
    t = triggers.filter("alert_level > 0").join(starts, "site_id")
    t = t.filter((F.col("ts_updated") >= F.col("event_start")) & (F.col("ts_updated") <= end))
    last = t.groupBy("site_id").agg(F.max("ts_updated").alias("__u"), F.max((F.col("alert_level") == 3).cast("int")).alias("__l3"))
    validity = release_time("__u") + span(days=F.lit(1) + F.col("__l3"))
    return raised.join(last.select("site_id", validity.alias("validity")), "site_id").select(
        "site_id", "validity", (end + span(mins=30) >= F.col("validity")).alias("write")
    )
