"""Surface markers: movement levels, trend test, histories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.clock import clean_round, micros, release_time, seconds_between
from ..functions.scan import CHUNK, previous, row_index, running_sum, scan, time_chunk, with_halo
from ..settings import SURFICIAL, Surficial

HOUR = 3600.0
DAY = 86400.0


# --- trend -----------------------------------------------------------------


def trend_expr(points: Column, cfg: Surficial = SURFICIAL) -> Column:
    """1 if the last acceleration fits the critical band of the last velocity.

    ``points``: array of struct(t in days, m), oldest first, at most a handful.
    Our definition: velocity and acceleration come from the least-squares
    parabola through the points.
    """
    def s(f):
        return F.aggregate(points, F.lit(0.0), lambda acc, p: acc + f(p["t"], p["m"]))

    sums = F.struct(
        s(lambda t, m: F.lit(1.0)).alias("n"), s(lambda t, m: t).alias("t1"), s(lambda t, m: t * t).alias("t2"),
        s(lambda t, m: t * t * t).alias("t3"), s(lambda t, m: t * t * t * t).alias("t4"),
        s(lambda t, m: m).alias("m0"), s(lambda t, m: t * m).alias("m1"), s(lambda t, m: t * t * m).alias("m2"),
        F.element_at(points, -1)["t"].alias("end"),
    )
    # Bind the sums once; a lambda over a one-element array acts as a let.
    return F.element_at(F.transform(F.array(sums), lambda k: _band(k, cfg)), 1)


def _band(k: Column, cfg: Surficial) -> Column:
    n, t1, t2, t3, t4 = (k[x] for x in ("n", "t1", "t2", "t3", "t4"))
    m0, m1, m2 = k["m0"], k["m1"], k["m2"]
    det = n * (t2 * t4 - t3 * t3) - t1 * (t1 * t4 - t2 * t3) + t2 * (t1 * t3 - t2 * t2)
    b = F.try_divide(n * (m1 * t4 - t3 * m2) - m0 * (t1 * t4 - t2 * t3) + t2 * (t1 * m2 - m1 * t2), det)
    c = F.try_divide(n * (t2 * m2 - m1 * t3) - t1 * (t1 * m2 - m1 * t2) + m0 * (t1 * t3 - t2 * t2), det)
    v1 = F.abs(b + c * 2.0 * k["end"])
    acc = F.abs(c * 2.0)
    ln = F.log(F.when(v1 > 0, v1))
    width = F.lit(cfg.ci_t_crit) * F.sqrt(
        F.abs(
            F.lit(1 / cfg.ci_n)
            - F.lit(2 * cfg.ci_sum_res_square) * (F.lit(1 / cfg.ci_n) + (ln - cfg.ci_v_log_mean) * (ln - cfg.ci_v_log_mean) / cfg.ci_var_v_log)
        )
    )
    crit = F.lit(cfg.ci_slope) * ln + F.lit(cfg.ci_intercept)
    la = F.log(F.when(acc > 0, acc))
    inside = (la >= crit - width) & (la <= crit + width) & (b * c > 0)
    return F.when(F.coalesce(inside, F.lit(False)), 1).otherwise(0)


def _level(disp: Column, hours: Column, n: Column, trend: Column, cfg: Surficial) -> Column:
    v = F.coalesce(F.try_divide(disp, hours), F.lit(float("inf")))
    t = F.when(n < cfg.points, 1).otherwise(trend)
    return (
        F.when(n < 2, 0).when(disp < cfg.min_cm, 0).when(v < cfg.v2, 0).when(v < cfg.v3, t + 1).otherwise(3)
    )


def marker_alerts(obs: DataFrame, at: Column, cfg: Surficial = SURFICIAL) -> DataFrame:
    """Level of every marker at one time from its latest observations.

    The rank filter is applied before the shuffle as well, so at most
    ``cfg.points`` rows per marker and task travel.
    """
    w = W.partitionBy("site_id", "marker_id").orderBy(F.col("ts").desc(), F.col("data_id").desc())
    top = obs.filter(F.col("ts") <= at).withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= cfg.points)
    g = top.groupBy("site_id", "marker_id").agg(
        F.array_sort(F.collect_list(F.struct("ts", "data_id", F.col("measurement").alias("m")))).alias("p")
    )
    return _from_history(g, at, cfg).select("site_id", "marker_id", "data_id", "displacement", "time_delta", "alert_level")


def _from_history(g: DataFrame, at: Column, cfg: Surficial) -> DataFrame:
    """Level from ``p``: array of struct(ts, data_id, m), oldest first."""
    last, before = F.element_at("p", -1), F.try_element_at(F.col("p"), F.lit(-2))
    g = g.withColumns({"__last": last, "__bef": before, "__n": F.size("p")})
    disp = clean_round(F.abs(F.col("__last.m") - F.col("__bef.m")), 4)
    hours = seconds_between("__bef.ts", "__last.ts") / HOUR
    t0 = F.element_at("p", 1)["ts"]
    pts = F.transform("p", lambda x: F.struct((seconds_between(t0, x["ts"]) / DAY).alias("t"), x["m"].alias("m")))
    fresh = ~(release_time("__last.ts") < release_time(at))
    level = F.when(~fresh, -1).otherwise(_level(disp, hours, F.col("__n"), trend_expr(pts, cfg), cfg))
    return g.withColumns(
        {
            "data_id": F.col("__last.data_id"),
            "displacement": F.when(fresh, disp),
            "time_delta": F.when(fresh, clean_round(hours, 4)),
            "alert_level": level,
        }
    )


def marker_histories(obs: DataFrame, n: int = 10, chunk_rows: int = 4096) -> DataFrame:
    """Each observation with the last ``n`` of its marker up to itself (array ``p``).

    Rows are numbered with a chunked scan and framed by row number, so a
    marker with very many observations is spread over tasks.
    """
    keys = ["site_id", "marker_id"]
    d = scan(obs, keys, ["ts", "data_id"], {"__i": row_index()})
    d = with_halo(d, F.col("__i"), chunk_rows, n - 1)
    w = W.partitionBy(*keys, CHUNK).orderBy("__i").rowsBetween(1 - n, 0)
    item = F.struct("ts", "data_id", F.col("measurement").alias("m"))
    return d.withColumn("p", F.collect_list(item).over(w)).filter("__own").drop("__own", CHUNK, "__i")


def recompute_markers(obs: DataFrame, todo: DataFrame | None = None, cfg: Surficial = SURFICIAL) -> DataFrame:
    """Level at every observation (or those in ``todo``), each as of its own time."""
    h = marker_histories(obs, cfg.points)
    if todo is not None:
        h = h.join(todo.select("data_id").distinct(), "data_id", "left_semi")
    h = h.drop("data_id").withColumn("__at", F.col("ts"))
    return _from_history(h, F.col("__at"), cfg).select("data_id", "site_id", "marker_id", "ts", "displacement", "time_delta", "alert_level")


def site_level(marker_levels: DataFrame) -> DataFrame:
    return marker_levels.groupBy("site_id").agg(F.max("alert_level").alias("alert_level"))


def lookback(obs: DataFrame, n: int, start: Column) -> DataFrame:
    """Per site the earlier of ``start`` and the time of its n-th latest observation time."""
    times = obs.groupBy("site_id", "ts").agg(F.count(F.lit(1)).alias("__c"))
    w = W.partitionBy("site_id").orderBy(F.col("ts").desc())
    top = times.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n)
    return top.groupBy("site_id").agg(F.least(F.min("ts"), start).alias("since"))


# --- histories -------------------------------------------------------------


def current_names(hist: DataFrame) -> DataFrame:
    """Newest add or rename per marker."""
    return hist.filter(F.col("event").isin("add", "rename")).groupBy("marker_id").agg(
        F.max_by("marker_name", F.struct("ts", "hist_id")).alias("marker_name")
    )


def marker_displacement(obs: DataFrame, hist: DataFrame, hide_muted: bool = True) -> DataFrame:
    """Step and cumulative movement under current names.

    Muted observations are removed; the step onto a repositioned observation
    is zero.
    """
    on = ["marker_id", "ts"]
    if hide_muted:
        obs = obs.join(hist.filter("event = 'mute'").select(*on).distinct(), on, "left_anti")
    moved = hist.filter("event = 'reposition'").select(*on).distinct().withColumn("__rep", F.lit(1))
    d = obs.join(moved, on, "left")
    d = scan(d, ["marker_id"], ["ts", "data_id"], {"__pm": previous(F.col("measurement"))}, time_chunk("ts"))
    step = F.when(F.col("__rep") == 1, 0.0).otherwise(F.coalesce(F.col("measurement") - F.col("__pm"), F.lit(0.0)))
    d = d.withColumn("step", clean_round(step, 4)).drop("__pm", "__rep")
    d = scan(d, ["marker_id"], ["ts", "data_id"], {"cumulative": running_sum(F.col("step"))}, time_chunk("ts"))
    return d.withColumn("cumulative", clean_round("cumulative", 4)).join(current_names(hist), "marker_id", "left")


def reconcile_markers(obs: DataFrame, registry: DataFrame) -> DataFrame:
    """Reported markers against the registry: ok, unknown or not reported."""
    a = obs.withColumn("__o", F.lit(1))
    b = registry.withColumn("__r", F.lit(1))
    return a.join(b, ["site_id", "marker_id"], "full_outer").withColumn(
        "status",
        F.when(F.col("__o").isNull(), "not reported").when(F.col("__r").isNull(), "unknown").otherwise("ok"),
    ).drop("__o", "__r")


def unpivot_observations(wide: DataFrame, keys: Sequence[str], marker_cols: dict[str, int]) -> DataFrame:
    """Observation sheet with a column per marker -> one row per measurement."""
    long = wide.unpivot(list(keys), list(marker_cols), "marker_name", "measurement").filter(F.col("measurement").isNotNull())
    ids = F.create_map(*[F.lit(x) for kv in marker_cols.items() for x in kv])
    return long.withColumn("marker_id", ids[F.col("marker_name")])
