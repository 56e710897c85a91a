"""Subsurface sensors: readings to node, sensor and site levels in one plan.

All sensors and all end times are evaluated together; (end, sensor, node) is
the series key. Readings shrink to one row per half-hour slot before any
window, so a series holds at most a few hundred rows per end time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.clock import clean_round, micros, span
from ..functions.scan import CHUNK, spread, with_halo
from ..operators.clean import orthogonal_filter, outlier_filter, range_filter
from ..operators.kinematics import linear_component, velocity
from ..operators.series import fill, resample_ffill, smooth
from ..settings import SUBSURFACE, Subsurface
from .windows import evaluation_grid

SERIES = ("end_ts", "tsm_id", "node_id")


def windowed_readings(readings: DataFrame, sensors: DataFrame, ends: DataFrame, cfg: Subsurface = SUBSURFACE) -> DataFrame:
    """Readings of existing nodes, copied to every end time they serve.

    ``part`` is 1 inside the window and 0 in the look-back before it; a reading
    on the border serves both.
    """
    grid = evaluation_grid(ends.select("end_ts").distinct(), cfg)
    first = F.col("offset_ts") - span(days=cfg.lookback_days)
    need = grid.select("*", F.explode(F.sequence(F.to_date(first), F.to_date("end_ts"))).alias("__day"))
    r = readings.join(sensors.select("tsm_id", "number_of_segments", "segment_length"), "tsm_id")
    r = r.filter(F.col("node_id") <= F.col("number_of_segments")).withColumn("__day", F.to_date("ts"))
    r = r.join(need, "__day").filter((F.col("ts") >= first) & (F.col("ts") <= F.col("end_ts")))
    parts = F.array_compact(
        F.array(
            F.when(F.col("ts") >= F.col("offset_ts"), 1),
            F.when(F.col("ts") <= F.col("offset_ts"), 0),
        )
    )
    return r.select("*", F.explode(parts).alias("part")).drop("__day")


def subsurface_kinematics(
    readings: DataFrame,
    sensors: DataFrame,
    ends: DataFrame,
    status: DataFrame | None = None,
    cfg: Subsurface = SUBSURFACE,
    tie: Sequence[str] = ("ts",),
) -> DataFrame:
    """Smoothed displacement and velocity of every node at every end time.

    Output: end_ts, tsm_id, node_id, ts, xz, xy, vel_xz, vel_xy, last_good.
    """
    # rows that no end time can use are not copied to any
    raw = windowed_readings(orthogonal_filter(range_filter(readings)), sensors, ends, cfg)
    clean = outlier_filter(raw, [*SERIES, "part"], tie)
    offset = F.col("end_ts") - span(mins=int(cfg.window_days * 1440) + cfg.lead_slots * cfg.slot_minutes)

    node = W.partitionBy(*SERIES)
    d = clean.withColumns(
        {
            "__init": F.max(F.when((F.col("part") == 1) & (F.col("ts") == offset), 1)).over(node),
            "__back": F.max(F.when(F.col("part") == 0, F.col("ts"))).over(node),
        }
    ).filter("part = 1 OR (__init IS NULL AND ts = __back)")
    if status is not None:
        bad = status.filter("status = 4").select("tsm_id", "node_id", "date_identified")
        bad = bad.groupBy("tsm_id", "node_id").agg(F.min("date_identified").alias("__since"))
        d = d.join(bad, ["tsm_id", "node_id"], "left").filter(F.col("__since").isNull() | (F.col("__since") > offset))

    d = d.withColumn("last_good", F.max("ts").over(node)).withColumn("ts", F.greatest("ts", offset))
    d = d.join(sensors.select("tsm_id", "segment_length"), "tsm_id")
    d = d.select(*SERIES, "ts", "last_good", linear_component("z", "segment_length").alias("xz"), linear_component("y", "segment_length").alias("xy"))

    every = _all_nodes(sensors, ends)
    have = d.select(*SERIES).distinct()
    null = F.lit(None).cast("double")
    empty = every.join(have, list(SERIES), "left_anti").select(
        *SERIES, offset.alias("ts"), F.lit(None).cast("timestamp_ntz").alias("last_good"), null.alias("xz"), null.alias("xy")
    )
    d = d.unionByName(empty)
    d = resample_ffill(d, SERIES, ["xz", "xy", "last_good"], offset, F.col("end_ts"))
    d = d.withColumn("last_good", F.max("last_good").over(node))
    d = smooth(fill(d, SERIES, ["xz", "xy"]), SERIES, ["xz", "xy"], cfg.points)
    return velocity(d, SERIES, cfg.points).filter(
        F.col("ts") >= F.col("end_ts") - span(mins=int(cfg.window_days * 1440))
    )


def _all_nodes(sensors: DataFrame, ends: DataFrame) -> DataFrame:
    """Node registry for each end time: the result must hold them all.

    The end times enter as one array, so each sensor expands in place.
    """
    return sensors.sparkSession.sql(
        """SELECT end_ts, tsm_id, explode(sequence(1, number_of_segments)) AS node_id FROM
        (SELECT tsm_id, number_of_segments, explode((SELECT collect_set(end_ts) FROM {ends})) AS end_ts FROM {sensors})""",
        ends=ends, sensors=sensors,
    )


# --- levels ----------------------------------------------------------------


def _ends_of(kin: DataFrame) -> DataFrame:
    first, last = F.min_by, F.max_by
    return kin.groupBy(*SERIES).agg(
        *[first(c, "ts").alias(f"{c}_0") for c in ("xz", "xy")],
        *[last(c, "ts").alias(f"{c}_1") for c in ("xz", "xy", "vel_xz", "vel_xy")],
        F.max("last_good").alias("last_good"),
    )


def _mm(c: Column) -> Column:
    """Difference of 4-digit numbers to 3 digits, ties away from zero."""
    return F.round(F.round(c, 4), 3) + F.lit(0.0)


def node_alerts(kin: DataFrame, cfg: Subsurface = SUBSURFACE, mode: str = "axes") -> DataFrame:
    """Displacement and velocity level of every node.

    ``mode``: 'axes' (levels 0 / 2 / 3), 'net' (net distance and velocity) or
    'noadj' (levels 0 / 1 / 2 with strict lower comparisons).
    """
    d = _ends_of(kin)
    fresh = F.coalesce(F.col("last_good") >= F.col("end_ts") - span(hours=cfg.stale_hours), F.lit(False))
    if mode == "net":
        net = lambda i: F.sqrt(F.col(f"xz_{i}") * F.col(f"xz_{i}") + F.col(f"xy_{i}") * F.col(f"xy_{i}"))
        vel = F.sqrt(F.col("vel_xz_1") * F.col("vel_xz_1") + F.col("vel_xy_1") * F.col("vel_xy_1"))
        d = d.withColumns({"disp": clean_round(net(1) - net(0), 3), "net_vel": clean_round(vel, 4)})
        da = F.when(F.abs("disp") > cfg.disp, 2).otherwise(0)
        v = F.abs("net_vel")
        va = F.when(v <= cfg.vel2, 0).when(v <= cfg.vel3, 2).otherwise(3)
        show = ["disp", "net_vel"]
    else:
        d = d.withColumns({"xz_disp": _mm(F.col("xz_1") - F.col("xz_0")), "xy_disp": _mm(F.col("xy_1") - F.col("xy_0"))})
        a, b = F.abs("xz_disp"), F.abs("xy_disp")
        vz, vy = F.abs("vel_xz_1"), F.abs("vel_xy_1")
        d = d.withColumns({"min_vel": F.least(vz, vy), "max_vel": F.greatest(vz, vy)})
        share_d = F.try_divide(F.least(a, b), F.greatest(a, b))
        share_v = F.try_divide(F.col("min_vel"), F.col("max_vel"))
        moved = (a > cfg.disp) | (b > cfg.disp)
        if mode == "axes":
            da = F.when(moved & (share_d > cfg.axis_ratio), 2).otherwise(0)
            m = F.col("max_vel")
            va = F.when(share_v > cfg.axis_ratio, F.when(m >= cfg.vel3, 3).when(m >= cfg.vel2, 2).otherwise(0)).otherwise(0)
        else:
            da = F.when(moved & ~F.coalesce(share_d < cfg.axis_ratio, F.lit(False)), 1).otherwise(0)
            m = F.col("max_vel")
            va = (
                F.when(F.coalesce(share_v < cfg.axis_ratio, F.lit(False)), 0)
                .when(m <= cfg.vel2, 0).when(m <= cfg.vel3, 1).otherwise(2)
            )
        show = ["xz_disp", "xy_disp", "min_vel", "max_vel"]
    d = d.withColumns(
        {
            "nd": F.when(fresh, 1).otherwise(0),
            "disp_alert": F.when(fresh, da).otherwise(-1),
            "vel_alert": F.when(fresh, va).otherwise(-1),
        }
    )
    return d.select(*SERIES, *show, "nd", "disp_alert", "vel_alert", F.greatest("disp_alert", "vel_alert").alias("node_alert"))


def validate_adjacent(nodes: DataFrame, k: int = 2, cfg: Subsurface = SUBSURFACE) -> DataFrame:
    """Confirm a moving node by its neighbours, nearest first.

    Scan order i-1, i+1, i-2, i+2, ...; neighbours without data are skipped and
    the first with data decides. Each node offers itself to at most 2k others,
    so the join is on equality of the node id. The nodes, one row each and end
    time, are stored first: all later steps would derive the kinematics again.
    """
    from ..session import cut_lineage

    nodes = cut_lineage(nodes)
    offer = nodes.filter("nd = 1").select(
        "end_ts", "tsm_id", F.col("node_id").alias("__from"), F.col("max_vel").alias("__mv"),
        F.explode(F.array(*[F.lit(s) for i in range(1, k + 1) for s in (i, -i)])).alias("__step"),
    ).withColumn("node_id", F.col("__from") + F.col("__step"))
    # step +d means the neighbour sits d above the node (i - d): scanned first
    rank = F.abs("__step") * 2 + F.when(F.col("__step") > 0, 0).otherwise(1)
    best = offer.groupBy(*SERIES).agg(
        F.min_by(F.struct(F.abs("__step").alias("d"), F.col("__mv").alias("mv")), rank).alias("__n")
    )
    d = nodes.join(best, list(SERIES), "left")
    need = lambda c: F.col("__n.mv") >= F.abs(c) / F.pow(F.lit(2.0), F.col("__n.d"))
    level = (
        F.when(F.col("vel_alert") <= 0, F.col("node_alert"))
        .when(F.col("__n").isNull(), -1)
        .when(need("max_vel"), F.col("node_alert"))
        .when((F.col("min_vel") >= cfg.vel3) & need("min_vel"), 2)
        .when((F.col("min_vel") >= cfg.vel2) & need("min_vel"), 1)
        .when(F.col("disp_alert") > 0, F.col("disp_alert"))
        .otherwise(0)
    )
    return d.withColumn("col_alert", level).drop("__n")


def trending(
    history: DataFrame, keys: Sequence[str], level: str = "node_alert", cfg: Subsurface = SUBSURFACE
) -> DataFrame:
    """Level held only if positive at more than three evaluations in three hours.

    Evaluated at every row; frames are bounded in time, so each series is cut
    into days with three hours copied over.
    """
    back = cfg.trend_hours * 3_600_000_000
    d = with_halo(history, micros("ts"), 86_400_000_000, back)
    w = W.partitionBy(*keys, CHUNK).orderBy(micros("ts")).rangeBetween(-back, 0)
    hot = F.count(F.when(F.col(level) > 0, 1)).over(w)
    return (
        d.withColumn("trend", F.when(hot > cfg.trend_count, F.max(level).over(w)).otherwise(0))
        .filter("__own").drop("__own", CHUNK)
    )


def trending_at(history: DataFrame, keys: Sequence[str], end: Column, level: str = "node_alert", cfg: Subsurface = SUBSURFACE) -> DataFrame:
    """Trending level of each key at one end time."""
    d = history.filter((F.col("ts") >= end - span(hours=cfg.trend_hours)) & (F.col("ts") <= end))
    n = F.count(F.when(F.col(level) > 0, 1))
    return d.groupBy(*keys).agg(F.when(n > cfg.trend_count, F.max(level)).otherwise(0).alias("trend"))


def mode_pick(df: DataFrame, keys: Sequence[str], value: str, pick: str = "max", out: str = "mode") -> DataFrame:
    """Most frequent value per key, ties to the largest (or smallest)."""
    c = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    v = F.col(value) if pick == "max" else -F.col(value)
    return c.groupBy(*keys).agg(F.max_by(value, F.struct("__n", v)).alias(out))


def sensor_alerts(
    nodes: DataFrame, history: DataFrame, bad: DataFrame | None = None, level: str = "col_alert", pick: str = "max"
) -> DataFrame:
    """Sensor level per end time: trending level if any node is positive, else the mode."""
    valid = nodes if bad is None else nodes.join(bad, ["tsm_id", "node_id"], "left_anti")
    hot = valid.filter(F.col(level) > 0).select(*SERIES)
    past = history.join(hot, ["tsm_id", "node_id"]).filter(
        (F.col("ts") >= F.col("end_ts") - span(hours=SUBSURFACE.trend_hours)) & (F.col("ts") <= F.col("end_ts"))
    )
    n = F.count(F.when(F.col("node_alert") > 0, 1))
    per_node = past.groupBy(*SERIES).agg(F.when(n > SUBSURFACE.trend_count, F.max("node_alert")).otherwise(0).alias("__t"))
    trend = per_node.groupBy("end_ts", "tsm_id").agg(F.max("__t").alias("__trend"))
    base = mode_pick(valid, ["end_ts", "tsm_id"], level, pick)
    any_hot = hot.select("end_ts", "tsm_id").distinct().withColumn("__hot", F.lit(1))
    return (
        base.join(any_hot, ["end_ts", "tsm_id"], "left")
        .join(trend, ["end_ts", "tsm_id"], "left")
        .select(
            F.col("end_ts").alias("ts"), "tsm_id",
            F.when(F.col("__hot") == 1, F.coalesce("__trend", F.lit(0))).otherwise(F.col("mode")).alias("alert_level"),
            F.col("end_ts").alias("ts_updated"),
        )
    )


def site_trigger(sensor_intervals: DataFrame, sensors: DataFrame, at: Column) -> DataFrame:
    """Highest level over the sensors live at ``at``, per site."""
    live = sensor_intervals.filter((F.col("ts") <= at) & (F.col("ts_updated") >= at))
    return live.join(sensors.select("tsm_id", "site_id"), "tsm_id").groupBy("site_id").agg(F.max("alert_level").alias("alert_level"))


# Codes of the two older rule sets.
NET_CODES = {-1: "VN", 0: "V0", 2: "V2", 3: "V3"}
NOADJ_CODES = {-1: "ND", 0: "L0", 1: "L2", 2: "L3"}


def code_of(level: str, codes: dict[int, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in codes.items() for x in kv])[F.col(level)]


# --- column shape ----------------------------------------------------------


def column_position(kin: DataFrame, sensors: DataFrame, fix: str = "bottom", cfg: Subsurface = SUBSURFACE) -> DataFrame:
    """Cumulative column shape at a few times before each end.

    The fixed end adds an anchor node; depth is accumulated from the surface
    down and, with a fixed bottom, all shapes share the deepest base.
    """
    step = cfg.position_hours * 60
    back = F.timestamp_diff("MINUTE", F.col("ts"), F.col("end_ts"))
    d = kin.filter((back % step == 0) & (back < step * cfg.position_count)).select(*SERIES, "ts", "xz", "xy")
    d = d.join(sensors.select("tsm_id", "segment_length", "number_of_segments"), "tsm_id")
    L = F.col("segment_length")
    rest = L * L - F.col("xz") * F.col("xz") - F.col("xy") * F.col("xy")
    d = d.withColumn("seg", F.coalesce(F.when(rest >= 0, F.sqrt(F.greatest(rest, F.lit(0.0)))), L))
    base = d.select("end_ts", "tsm_id", "ts", "segment_length", "number_of_segments").distinct()
    zero = F.lit(0.0)
    anchor = base.withColumns(
        {
            "node_id": (F.col("number_of_segments") + 1).cast("int") if fix == "bottom" else F.lit(0),
            "xz": zero, "xy": zero,
            "seg": F.col("segment_length") if fix == "bottom" else zero,
        }
    )
    cols = ["end_ts", "tsm_id", "ts", "node_id", "xz", "xy", "seg"]
    d = d.select(*cols).unionByName(anchor.select(*cols))
    shape = W.partitionBy("end_ts", "tsm_id", "ts")
    far = F.col("node_id").desc() if fix == "bottom" else F.col("node_id").asc()
    run = shape.orderBy(far).rowsBetween(W.unboundedPreceding, 0)
    down = shape.orderBy("node_id").rowsBetween(W.unboundedPreceding, 0)
    d = d.withColumns(
        {
            "cs_xz": clean_round(F.sum("xz").over(run), 4),
            "cs_xy": clean_round(F.sum("xy").over(run), 4),
            "__cum": F.sum(F.round("seg", 4)).over(down),
        }
    )
    d = d.withColumn("depth", F.round(F.col("__cum") - F.min("__cum").over(shape), 4))
    if fix == "bottom":
        deepest = F.max("depth").over(W.partitionBy("end_ts", "tsm_id"))
        d = d.withColumn("depth", F.col("depth") + deepest - F.max("depth").over(shape))
    return d.select("end_ts", "tsm_id", "ts", "node_id", "cs_xz", "cs_xy", clean_round(-F.col("depth"), 4).alias("depth"))


def plot_offset(kin: DataFrame, how: str = "mean") -> DataFrame:
    """One spacing per (end, sensor): max / mean / min of the nodes' xz range."""
    per = kin.groupBy(*SERIES).agg((F.max("xz") - F.min("xz")).alias("__r"))
    f = {"max": F.max, "mean": F.avg, "min": F.min}[how]
    return per.groupBy("end_ts", "tsm_id").agg(f("__r").alias("plot_offset"))


def disp_offset(kin: DataFrame, sensors: DataFrame, how: str = "mean", digits: int = 4) -> DataFrame:
    """Series zeroed at the window start and spread apart by node."""
    first = kin.groupBy(*SERIES).agg(F.min_by("xz", "ts").alias("__xz"), F.min_by("xy", "ts").alias("__xy"))
    d = kin.join(first, list(SERIES)).join(plot_offset(kin, how), ["end_ts", "tsm_id"])
    d = d.join(sensors.select("tsm_id", "number_of_segments"), "tsm_id")
    lift = (F.col("number_of_segments") - F.col("node_id")) * F.col("plot_offset")
    return d.select(
        *SERIES, "ts",
        *[clean_round(F.round(F.col(c) - F.col(f"__{c}"), 4) + lift, digits).alias(c) for c in ("xz", "xy")],
    )


def cumulative_surface(kin: DataFrame, sensors: DataFrame, how: str = "mean", digits: int = 4) -> DataFrame:
    """Sum over nodes per time, zeroed at the window start, lifted above all nodes."""
    tot = kin.groupBy("end_ts", "tsm_id", "ts").agg(F.sum("xz").alias("xz"), F.sum("xy").alias("xy"))
    first = tot.groupBy("end_ts", "tsm_id").agg(F.min_by("xz", "ts").alias("__xz"), F.min_by("xy", "ts").alias("__xy"))
    d = tot.join(first, ["end_ts", "tsm_id"]).join(plot_offset(kin, how), ["end_ts", "tsm_id"])
    d = d.join(sensors.select("tsm_id", "number_of_segments"), "tsm_id")
    lift = F.col("plot_offset") * F.col("number_of_segments")
    return d.select("end_ts", "tsm_id", "ts", *[clean_round(F.col(c) - F.col(f"__{c}") + lift, digits).alias(c) for c in ("xz", "xy")])


def classify_velocity(kin: DataFrame, cfg: Subsurface = SUBSURFACE) -> DataFrame:
    """Axis velocities in the level-2 or level-3 band, in long form."""
    long = kin.select(*SERIES, "ts", "vel_xz", "vel_xy").unpivot([*SERIES, "ts"], ["vel_xz", "vel_xy"], "axis", "velocity")
    v = F.abs("velocity")
    return long.withColumn("level", F.when(v > cfg.vel3, 3).when(v > cfg.vel2, 2)).filter("level IS NOT NULL")


def noise_band(kin: DataFrame, value: str, bin_width: float = 0.001, sigma: float = 2.0, peak_share: float = 0.05) -> DataFrame:
    """Lowest and highest density mode of each node's values.

    Our definition: values fall into fixed bins, each bin spreads gaussian
    weight over the bins within three sigma, and the local maxima of at least
    ``peak_share`` of the tallest are the modes. A single mode gives NULLs.
    """
    reach = int(3 * sigma)
    b = F.round(F.col(value) / bin_width).cast("long")
    h = kin.groupBy(*SERIES, b.alias("__b")).agg(F.count(F.lit(1)).alias("__n"))
    s = h.select(*SERIES, "__b", "__n", F.explode(F.sequence(F.lit(-reach), F.lit(reach))).alias("__o"))
    wgt = F.exp(-(F.col("__o") * F.col("__o")) / F.lit(2.0 * sigma * sigma))
    dens = s.groupBy(*SERIES, (F.col("__b") + F.col("__o")).alias("bin")).agg(F.round(F.sum(F.col("__n") * wgt), 6).alias("dens"))
    w = W.partitionBy(*SERIES).orderBy("bin")
    # bins never reached have no row: a jump in bin number means zero density
    left = F.when(F.lag("bin").over(w) == F.col("bin") - 1, F.lag("dens").over(w)).otherwise(0.0)
    right = F.when(F.lead("bin").over(w) == F.col("bin") + 1, F.lead("dens").over(w)).otherwise(0.0)
    p = dens.withColumns({"__l": left, "__r": right, "__top": F.max("dens").over(W.partitionBy(*SERIES))})
    p = p.filter((F.col("dens") > F.col("__l")) & (F.col("dens") >= F.col("__r")) & (F.col("dens") >= F.col("__top") * peak_share))
    m = p.groupBy(*SERIES).agg(F.min("bin").alias("__lo"), F.max("bin").alias("__hi"))
    one = F.col("__lo") == F.col("__hi")
    return m.select(
        *SERIES,
        F.when(~one, clean_round(F.col("__lo") * bin_width, 6)).alias("low"),
        F.when(~one, clean_round(F.col("__hi") * bin_width, 6)).alias("high"),
    )


def cumulative_band(band: DataFrame) -> DataFrame:
    """Band summed from the deepest node up."""
    w = W.partitionBy("end_ts", "tsm_id").orderBy(F.col("node_id").desc()).rowsBetween(W.unboundedPreceding, 0)
    return band.withColumns({c: clean_round(F.sum(c).over(w), 6) for c in ("low", "high")})


def noise_envelope(kin: DataFrame, band: DataFrame, sensors: DataFrame, value: str = "xz", how: str = "mean", digits: int = 4) -> DataFrame:
    """Band re-based to the window start and lifted like the plotted series."""
    first = kin.groupBy(*SERIES).agg(F.min_by(value, "ts").alias("__0"))
    d = band.join(first, list(SERIES)).join(plot_offset(kin, how), ["end_ts", "tsm_id"])
    d = d.join(sensors.select("tsm_id", "number_of_segments"), "tsm_id")
    lift = (F.col("number_of_segments") - F.col("node_id")) * F.col("plot_offset")
    return d.select(*SERIES, *[clean_round(F.col(c) - F.col("__0") + lift, digits).alias(c) for c in ("low", "high")])


def bundle(kin: DataFrame, sensors: DataFrame, fix: str = "bottom", how: str = "mean", digits: int = 4, velocity_hours: int = 3, cfg: Subsurface = SUBSURFACE) -> DataFrame:
    """Everything a displacement page shows of a sensor, one nested row per (end, sensor).

    ``c`` column positions; ``d`` the zeroed, spread displacement, both axes'
    annotations, the cumulative surface and its base; ``v`` the nodes whose
    velocity is in the level-2 or level-3 band within the last hours, by axis.
    xz is downslope, xy latslope.

    The kinematics is stored once and its parts are derived from that; they
    meet as tagged rows in one aggregate. A sensor's slots and nodes within a
    window are limited, and so are its arrays.
    """
    from ..operators.stats import annotations
    from ..session import cut_lineage

    kin = cut_lineage(kin)
    end = ["end_ts", "tsm_id"]
    kinds = {"ts": "timestamp_ntz", "node_id": "int", "down": "double", "lat": "double", "depth": "double", "level": "int", "axis": "string", "down_text": "string", "lat_text": "string"}

    def tagged(d: DataFrame, part: str, **cols) -> DataFrame:
        pick = {**({c: c for c in ("ts", "node_id") if c in d.columns}), **cols}
        return d.select(*end, F.lit(part).alias("part"), *[(F.col(pick[c]) if c in pick else F.lit(None)).cast(t).alias(c) for c, t in kinds.items()])

    base = plot_offset(kin, how).join(sensors.select("tsm_id", "number_of_segments"), "tsm_id").withColumn("base", clean_round(F.col("plot_offset") * F.col("number_of_segments"), digits))
    recent = kin.filter(F.col("ts") >= F.col("end_ts") - span(hours=velocity_hours))
    rows = [
        tagged(column_position(kin, sensors, fix, cfg), "column", down="cs_xz", lat="cs_xy", depth="depth"),
        tagged(disp_offset(kin, sensors, how, digits), "disp", down="xz", lat="xy"),
        tagged(cumulative_surface(kin, sensors, how, digits), "cumulative", down="xz", lat="xy"),
        tagged(base, "base", down="base"),
        tagged(annotations(kin, SERIES, ("xz", "xy")), "annotation", down_text="text_xz", lat_text="text_xy"),
        tagged(classify_velocity(recent, cfg), "velocity", level="level", axis="axis"),
    ]
    every = rows[0]
    for d in rows[1:]:
        every = every.unionByName(d)

    def listed(part: str, *fields, also=None):
        hit = F.col("part") == part
        named = [F.col(f).alias(n) for f, n in fields]
        return F.sort_array(F.collect_list(F.when(hit if also is None else hit & also, F.struct(*named))))

    at, slope = [("ts", "ts"), ("node_id", "node_id")], [("down", "downslope"), ("lat", "latslope")]
    moving = lambda axis, level: listed("velocity", *at, also=(F.col("axis") == axis) & (F.col("level") == level)).alias(f"L{level}")
    return every.groupBy(*end).agg(
        F.struct(*[F.struct(moving(f"vel_{a}", 2), moving(f"vel_{a}", 3)).alias(n) for a, n in (("xz", "downslope"), ("xy", "latslope"))]).alias("v"),
        listed("column", *at, ("depth", "depth"), ("lat", "latslope"), ("down", "downslope")).alias("c"),
        F.struct(
            listed("disp", *at, *slope).alias("disp"),
            listed("annotation", ("node_id", "node_id"), ("down_text", "downslope_annotation"), ("lat_text", "latslope_annotation")).alias("annotation"),
            listed("cumulative", ("ts", "ts"), *slope).alias("cumulative"),
            F.max(F.when(F.col("part") == "base", F.col("down"))).alias("cml_base"),
        ).alias("d"),
    )


def bundle_json(bundles: DataFrame) -> DataFrame:
    """The nested rows as one JSON text each."""
    return bundles.select("end_ts", "tsm_id", F.to_json(F.struct("v", "c", "d")).alias("series"))


def backfill(readings: DataFrame, sensors: DataFrame, start: str, end: str, minutes: int = 30, done: DataFrame | None = None,
             status: DataFrame | None = None, cfg: Subsurface = SUBSURFACE, tie: Sequence[str] = ("ts",)) -> DataFrame:
    """Node levels at every step of a period, skipping what ``done`` already holds.

    A sensor is evaluated at a step only if it has data at or after it, and
    resumes one step after its own latest stored evaluation.
    """
    spark = readings.sparkSession
    steps = spark.sql(
        f"SELECT explode(sequence(TIMESTAMP_NTZ'{start}', TIMESTAMP_NTZ'{end}', INTERVAL '{minutes}' MINUTE)) AS end_ts"
    )
    last = readings.groupBy("tsm_id").agg(F.max("ts").alias("__last"))
    nodes = node_alerts(subsurface_kinematics(readings, sensors, steps, status, cfg, tie), cfg)
    nodes = nodes.join(last, "tsm_id").filter(F.col("__last") >= F.col("end_ts")).drop("__last")
    if done is not None:
        seen = done.groupBy("tsm_id").agg(F.max("ts").alias("__seen"))
        nodes = nodes.join(seen, "tsm_id", "left").filter(
            F.col("__seen").isNull() | (F.col("end_ts") > F.col("__seen"))
        ).drop("__seen")
    return nodes


# --- research set -----------------------------------------------------------


def resultant_alerts(series: DataFrame, disp: float = 0.05, vel: float = 0.032, trend: float = 0.6) -> DataFrame:
    """Level 2 where a node moves fast or far and steadily in one direction.

    Steady means a rank correlation with time beyond ``trend`` over three days.
    """
    from ..operators.kinematics import linreg_displacement, rolling_spearman

    key = ["tsm_id", "node_id"]
    d = velocity(linreg_displacement(series, key, "xz"), key)
    d = rolling_spearman(d, "xz", keys=key, keep=("displacement", "vel_xz"))
    steady = F.coalesce(F.abs("rho") > trend, F.lit(False))
    level = lambda c, lim: F.when(F.coalesce(F.abs(c) > lim, F.lit(False)) & steady, 2).otherwise(0)
    return d.select(*key, "ts", "displacement", "vel_xz", "rho", level("displacement", disp).alias("disp_alert"), level("vel_xz", vel).alias("vel_alert"))


def drift_weeks(
    readings: DataFrame, keys: Sequence[str], tie: Sequence[str] = ("ts",), min_count: int = 84, min_acc: float = 3e-6, min_r2: float = 0.7
) -> DataFrame:
    """Weeks in which a sensor's gravity magnitude drifts steadily.

    Slots hold the first reading of each axis, so a series is bounded by its
    time span. Only slots with readings are sorted; the empty ones between them
    come up where they are summed. Steps: unwrap below -2048, magnitude on the 30-minute grid, whose
    weekly count is ``n``, then (0.5, 3.0), the centred 12-row three-sigma cut
    and linear interpolation, where cut slots stay as empty rows and the last
    value holds to the end; then six-hour means, empty where the mean deviation
    from both neighbours is over 0.05, and their differences of first and second order
    with weekly means. ``r2`` relates the means to the grid's row numbers.
    Thresholds are compared before rounding.
    """
    from ..functions.clock import floor_to
    from ..operators.clean import slot_first
    from ..operators.series import week_ending_sunday

    f = spread(slot_first(readings, keys, ["x", "y", "z"], tie), *keys)
    f = f.withColumns({a: F.when(F.col(a) < -2048, F.col(a) + 4096).otherwise(F.col(a)).cast("double") / 1024.0 for a in ("x", "y", "z")})
    whole = W.partitionBy(*keys)
    row = (micros("ts") - micros(F.min("ts").over(whole))) / F.lit(30 * 60_000_000) + 1
    f = f.select(*keys, "ts", F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y") + F.col("z") * F.col("z")).alias("raw"), row.alias("__k"))
    f = f.withColumn("mag", F.when((F.col("raw") <= 3.0) & (F.col("raw") >= 0.5), F.col("raw")))
    # frames of grid rows, found by their numbers
    near = whole.orderBy("__k").rangeBetween(-6, 5)
    full = F.count("mag").over(near) == 12
    f = f.withColumns({"__m": F.when(full, F.avg("mag").over(near)), "__s": F.when(full, F.stddev_samp("mag").over(near))})
    far = (F.abs(F.col("mag") - F.col("__m")) > 3 * F.col("__s")) & (F.col("__s") != 0)
    f = f.withColumn("mag", F.when(F.coalesce(far, F.lit(False)), None).otherwise(F.col("mag")))
    # a cut slot loses its row number too, an unread one keeps it
    f = f.withColumn("__i", F.when(F.col("mag").isNotNull() | F.col("raw").isNull(), F.col("__k")))
    item = F.when(F.col("mag").isNotNull(), F.struct("__k", "mag"))
    f = f.select(*keys, "ts", "raw", "mag", "__k", "__i", F.last(item, ignorenulls=True).over(whole.orderBy("__k").rowsBetween(W.unboundedPreceding, 0)).alias("__p"))
    back = whole.orderBy(F.desc("__k"))
    f = f.withColumns({"__n": F.last(item, ignorenulls=True).over(back.rowsBetween(W.unboundedPreceding, -1)), "__end": F.coalesce(F.lag("__k").over(back) - 1, F.col("__k"))})
    # first and last row number that is kept, unread slots included
    unread = F.col("__end") > F.col("__k")
    f = f.withColumns({
        "__i0": F.min(F.coalesce("__i", F.when(unread, F.col("__k") + 1))).over(whole),
        "__i1": F.max(F.when(unread, F.col("__end")).otherwise(F.col("__i"))).over(whole),
    })
    # only now a row spreads itself over the unread slots behind it, on its way into an aggregate
    f = f.withColumn("__slot", F.explode(F.sequence(F.col("__end").cast("long"), F.col("__k").cast("long"))))
    f = f.withColumns({"__at": F.col("__slot").cast("double"), "__own": F.col("__slot") == F.col("__k")})
    share = F.try_divide(F.col("__at") - F.col("__p.__k"), F.col("__n.__k") - F.col("__p.__k"))
    kept = (F.col("__at") >= F.col("__i0")) & (F.col("__at") <= F.col("__i1"))
    f = f.select(
        *keys, (F.col("ts") + span(mins=30 * (F.col("__slot") - F.col("__k").cast("long")).cast("int"))).alias("ts"), F.when(F.col("__own"), F.col("raw")).alias("raw"),
        F.coalesce(F.when(F.col("__own"), F.col("mag")), F.col("__p.mag") + (F.col("__n.mag") - F.col("__p.mag")) * share, F.col("__p.mag")).alias("mag"),
        F.when(kept, F.col("__at")).otherwise(F.when(F.col("__at") > F.col("__i1"), F.col("__i1"))).alias("__i"),
    )
    h = f.groupBy(*keys, floor_to("ts", 360).alias("slot")).agg(F.avg("mag").alias("mag"), F.avg("__i").alias("__i"), F.count("raw").alias("n"))
    hw = W.partitionBy(*keys).orderBy("slot")
    # deviation of two values: their distance over the square root of 2
    sd = (F.abs(F.col("mag") - F.lag("mag").over(hw)) + F.abs(F.lead("mag").over(hw) - F.col("mag"))) / (2 * F.sqrt(F.lit(2.0)))
    h = h.withColumn("__quiet", F.coalesce(sd <= 0.05, F.lit(True)))
    h = h.withColumn("mag", F.when(F.col("__quiet"), F.col("mag")))
    h = h.withColumn("__i", F.when(F.col("mag").isNotNull(), F.col("__i")))
    h = h.withColumn("vel", F.col("mag") - F.lag("mag").over(hw))
    h = h.withColumn("acc", F.col("vel") - F.lag("vel").over(hw)).withColumn("week_end", week_ending_sunday("slot"))
    k = h.groupBy(*keys, "week_end").agg(
        F.avg("vel").alias("vel"), F.avg("acc").alias("acc"), F.sum("n").alias("n"),
        F.try_divide(F.covar_pop("mag", "__i"), F.stddev_pop("mag") * F.stddev_pop("__i")).alias("__r"),
    )
    k = k.withColumn("r2", F.col("__r") * F.col("__r")).filter((F.col("r2") > min_r2) & (F.abs("acc") > min_acc) & (F.col("n") >= min_count))
    return k.select(*keys, "week_end", clean_round(F.col("vel"), 8).alias("vel"), clean_round(F.col("acc"), 8).alias("acc"), "n", clean_round(F.col("r2"), 6).alias("r2"))


def drifting(weeks: DataFrame, keys: Sequence[str], min_days: int = 28, max_gap: int = 14) -> DataFrame:
    """Runs of weeks with the same direction, at most ``max_gap`` days apart."""
    w = W.partitionBy(*keys).orderBy("week_end")
    sign = F.signum("vel")
    new = (F.lag(sign).over(w) != sign) | (F.datediff("week_end", F.lag("week_end").over(w)) > max_gap)
    d = weeks.withColumn("__new", F.when(F.coalesce(new, F.lit(True)), 1).otherwise(0))
    d = d.withColumn("__run", F.sum("__new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    r = d.groupBy(*keys, "__run").agg(F.min("week_end").alias("since"), F.max("week_end").alias("until"), F.count(F.lit(1)).alias("weeks"))
    return r.filter(F.datediff("until", "since") >= min_days).drop("__run")
