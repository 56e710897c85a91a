"""Queries over subsurface readings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.clock import at, clean_round, span
from ..operators import clean as C, kinematics as K, series as S
from ..plans import subsurface as P
from ..plans.windows import evaluation_grid
from .registry import query

NODE = list(C.NODE)
TIE = ("ts", "event_id")
END = "2024-01-20 12:00:00"


def R(e: str, n: int) -> str:
    return f"(round({e}, {n}) + 0.0)"


# --- cleaning --------------------------------------------------------------

FIX = """rng AS (SELECT * REPLACE (CASE WHEN abs(x) <= 1126 THEN x END AS x, CASE WHEN abs(y) <= 1126 THEN y END AS y, CASE WHEN abs(z) <= 1126 THEN z END AS z) FROM
  (SELECT * REPLACE (CASE WHEN x > -3072 AND x < -2970 THEN x + 4096 ELSE x END AS x, CASE WHEN y > -3072 AND y < -2970 THEN y + 4096 ELSE y END AS y, CASE WHEN z > -3072 AND z < -2970 THEN z + 4096 ELSE z END AS z) FROM {src})
  WHERE abs(x) <= 1126),
ort AS (SELECT * FROM (SELECT *, sqrt((x / 1024.0) * (x / 1024.0) + (y / 1024.0) * (y / 1024.0) + (z / 1024.0) * (z / 1024.0)) AS mag FROM rng) WHERE mag > 0.92 AND mag < 1.08)"""


def clean_sql(src: str, key: str) -> str:
    """CTE chain ending in ``cln``: cleaned slots per ``key``."""
    stats = ", ".join(
        f"avg({a}) OVER w AS m{a}, stddev_samp({a}) OVER w AS s{a}" for a in "xyz"
    )
    ok = " AND ".join(f"NOT coalesce({a} > m{a} + 3.0 * s{a} OR {a} < m{a} - 3.0 * s{a}, false)" for a in "xyz")
    return (
        FIX.replace("{src}", src)
        + f""",
slt AS (SELECT {key}, time_bucket(INTERVAL 30 MINUTE, ts) AS slot, first(x ORDER BY ts, event_id) AS x, first(y ORDER BY ts, event_id) AS y, first(z ORDER BY ts, event_id) AS z FROM ort GROUP BY {key}, slot),
cln AS (SELECT {key}, slot AS ts, x, y, z FROM (SELECT *, {stats} FROM slt WINDOW w AS (PARTITION BY {key} ORDER BY slot RANGE BETWEEN INTERVAL 1410 MINUTE PRECEDING AND CURRENT ROW)) WHERE {ok})"""
    )


LIN = f"""lin AS (SELECT tsm_id, node_id, ts, {R('segment_length * z / sqrt(x::DOUBLE*x + y::DOUBLE*y + z::DOUBLE*z)', 4)} AS xz, {R('segment_length * y / sqrt(x::DOUBLE*x + y::DOUBLE*y + z::DOUBLE*z)', 4)} AS xy FROM cln JOIN {{sensors}} USING (tsm_id))"""
GRID = """grd AS (SELECT tsm_id, node_id, unnest(generate_series(min(ts), max(ts), INTERVAL 30 MINUTE)) AS ts FROM lin GROUP BY tsm_id, node_id),
ff AS (SELECT g.tsm_id, g.node_id, g.ts, last_value(xz IGNORE NULLS) OVER w AS xz, last_value(xy IGNORE NULLS) OVER w AS xy FROM grd g LEFT JOIN lin l ON g.tsm_id = l.tsm_id AND g.node_id = l.node_id AND g.ts = l.ts
  WINDOW w AS (PARTITION BY g.tsm_id, g.node_id ORDER BY g.ts ROWS UNBOUNDED PRECEDING))"""
SMOOTH = f"""smo AS (SELECT tsm_id, node_id, ts, {R('mz', 4)} AS xz, {R('my', 4)} AS xy FROM (SELECT *, avg(xz) OVER w AS mz, avg(xy) OVER w AS my, row_number() OVER (PARTITION BY tsm_id, node_id ORDER BY ts) AS n, count(*) OVER (PARTITION BY tsm_id, node_id) AS c FROM ff
  WINDOW w AS (PARTITION BY tsm_id, node_id ORDER BY ts ROWS 6 PRECEDING)) WHERE n >= 7 OR c = 1)"""
SERIES_SQL = f"{clean_sql('{readings}', 'tsm_id, node_id')},\n{LIN},\n{GRID},\n{SMOOTH}"


@query("range_repair", "F1", f"WITH {FIX.replace('{src}', '{readings}')} SELECT event_id, tsm_id, node_id, ts, x, y, z FROM rng")
def _(i):
    return C.range_filter(i.readings).select("event_id", *NODE, "ts", "x", "y", "z")


@query("unit_gravity", "F2", f"WITH {FIX.replace('{src}', '{readings}')} SELECT event_id, tsm_id, node_id, ts, x, y, z FROM ort")
def _(i):
    return C.orthogonal_filter(C.range_filter(i.readings)).select("event_id", *NODE, "ts", "x", "y", "z")


@query("clean_readings", "F3,F4", f"WITH {clean_sql('{readings}', 'tsm_id, node_id')} SELECT * FROM cln")
def _(i):
    return C.apply_filters(i.readings, NODE, TIE).select(*NODE, "ts", "x", "y", "z")


@query("clean_unfiltered_slots", "F3", """WITH slt AS (SELECT tsm_id, node_id, time_bucket(INTERVAL 30 MINUTE, ts) AS slot, first(x ORDER BY ts, event_id) AS x, first(y ORDER BY ts, event_id) AS y, first(z ORDER BY ts, event_id) AS z FROM {readings} GROUP BY ALL)
SELECT tsm_id, node_id, slot AS ts, x, y, z FROM (SELECT *, avg(x) OVER w AS mx, stddev_samp(x) OVER w AS sx, avg(y) OVER w AS my, stddev_samp(y) OVER w AS sy, avg(z) OVER w AS mz, stddev_samp(z) OVER w AS sz FROM slt WINDOW w AS (PARTITION BY tsm_id, node_id ORDER BY slot RANGE BETWEEN INTERVAL 1410 MINUTE PRECEDING AND CURRENT ROW))
WHERE NOT coalesce(abs(x - mx) > 3 * sx, false) AND NOT coalesce(abs(y - my) > 3 * sy, false) AND NOT coalesce(abs(z - mz) > 3 * sz, false)""")
def _(i):
    return C.apply_filters(i.readings, NODE, TIE, range_=False, ortho=False).select(*NODE, "ts", "x", "y", "z")


@query("voltage_limits", "F5", """SELECT event_id, tsm_id, node_id, batt FROM (SELECT r.event_id, r.tsm_id, r.node_id, CASE WHEN batt >= 56 THEN (batt + 200) / 100 ELSE batt END AS batt, voltage_min, voltage_max FROM {readings} r JOIN {accelerometers} a ON r.tsm_id = a.tsm_id AND r.node_id = a.node_id AND a.accel_number = 1)
WHERE batt = 2 OR (batt >= voltage_min AND batt <= voltage_max)""")
def _(i):
    d = i.readings.withColumn("accel_number", F.lit(1))
    return C.volt_filter(d, i.accelerometers).select("event_id", *NODE, "batt")


TYPED = "(SELECT *, CAST(CASE WHEN event_id % 5 = 0 THEN 12 WHEN event_id % 5 = 1 THEN 99 ELSE 11 END AS INT) AS type_num FROM {readings})"
NUMBERED = f"(SELECT *, CASE WHEN type_num IN (32, 11, 41) OR type_num IS NULL THEN 1 WHEN type_num IN (33, 12, 42) THEN 2 ELSE 0 END AS accel_number FROM {TYPED})"


def _typed(i):
    e = F.col("event_id") % 5
    return i.readings.withColumn("type_num", F.when(e == 0, 12).when(e == 1, 99).otherwise(11))


@query("accelerometer_choice", "F6", f"""WITH j AS (SELECT n.event_id, n.tsm_id, n.node_id, n.accel_number, a.in_use FROM {NUMBERED} n JOIN {{accelerometers}} a ON n.tsm_id = a.tsm_id AND n.node_id = a.node_id AND n.accel_number = a.accel_number),
t AS (SELECT tsm_id, max(in_use) AS anyuse, max(accel_number) AS top FROM j GROUP BY tsm_id)
SELECT event_id, tsm_id, node_id, accel_number FROM j JOIN t USING (tsm_id) WHERE CASE WHEN anyuse = 1 THEN in_use = 1 ELSE accel_number = top END""")
def _(i):
    return C.select_accel(_typed(i), i.accelerometers).select("event_id", *NODE, "accel_number")


@query("accelerometer_in_use", "F6", f"""SELECT n.event_id, n.tsm_id, n.node_id FROM {NUMBERED} n JOIN {{accelerometers}} a ON n.tsm_id = a.tsm_id AND n.node_id = a.node_id AND n.accel_number = a.accel_number WHERE in_use = 1""")
def _(i):
    return C.select_accel(_typed(i), i.accelerometers, analysis=True).select("event_id", *NODE)


@query("working_nodes", "F7", """SELECT event_id, tsm_id, node_id, ts FROM {readings} r WHERE NOT EXISTS (SELECT 1 FROM {node_status} s WHERE s.tsm_id = r.tsm_id AND s.node_id = r.node_id AND status = 4 AND date_identified <= TIMESTAMP '2024-01-20 12:00:00')""")
def _(i):
    return C.drop_bad_nodes(i.readings, i.node_status, at(END)).select("event_id", *NODE, "ts")


@query("tilt_to_linear", "F9", f"WITH {clean_sql('{readings}', 'tsm_id, node_id')}, {LIN} SELECT * FROM lin")
def _(i):
    d = C.apply_filters(i.readings, NODE, TIE).join(i.sensors, "tsm_id")
    return K.to_linear(d).select(*NODE, "ts", "xz", "xy")


@query("segment_depth", "F10", f"""WITH {clean_sql('{readings}', 'tsm_id, node_id')}, {LIN} SELECT tsm_id, node_id, ts, {R('CASE WHEN c.x < 0 THEN -1.0 ELSE 1.0 END * coalesce(CASE WHEN 1 - xz*xz - xy*xy >= 0 THEN sqrt(1 - xz*xz - xy*xy) END, 1.0)', 6)} AS depth, {R('sqrt(xz*xz + xy*xy)', 6)} AS net FROM lin JOIN cln c USING (tsm_id, node_id, ts)""")
def _(i):
    d = K.to_linear(C.apply_filters(i.readings, NODE, TIE).join(i.sensors, "tsm_id"))
    return K.depth_net(d).select(*NODE, "ts", clean_round("depth", 6).alias("depth"), clean_round("net", 6).alias("net"))


@query("resultant_vector", "F11", f"""WITH {FIX.replace('{src}', '{readings}')}, f AS (SELECT tsm_id, node_id, first(x ORDER BY ts, event_id) AS x0, first(y ORDER BY ts, event_id) AS y0, first(z ORDER BY ts, event_id) AS z0 FROM ort GROUP BY tsm_id, node_id),
d AS (SELECT *, x - x0 AS dx, y - y0 AS dy, z - z0 AS dz FROM ort JOIN f USING (tsm_id, node_id))
SELECT event_id, tsm_id, node_id, {R('sqrt(dx*dx + dy*dy + dz*dz) * 1.0 / 1024.0', 6)} AS resultant, CASE WHEN dy*dy + dz*dz > 0 THEN {R('acos(dy / sqrt(dy*dy + dz*dz))', 6)} END AS angle, {R('acos(x / sqrt(x*x + y*y + z*z))', 6)} AS beta FROM d""")
def _(i):
    d = C.orthogonal_filter(C.range_filter(i.readings)).join(i.sensors, "tsm_id")
    r = K.resultant(d, NODE, tie=TIE)
    return r.select("event_id", *NODE, *[clean_round(c, 6).alias(c) for c in ("resultant", "angle", "beta")])


def _moisture(i):
    r, e = i.readings, F.col("event_id")
    d = r.select(
        "event_id", *NODE, (e % 500 + 1).cast("double").alias("mval1"), (e % 331).cast("double").alias("mval2"),
        F.element_at(F.array(*[F.lit(x) for x in (21, 26, 10, 13, 110, 111)]), (e % 6 + 1).cast("int")).alias("type_num"),
        F.when(F.col("tsm_id") % 5 == 0, "probe").otherwise("other").alias("tsm_name"),
    )
    s = i.sensors.withColumn("version", F.when(F.col("tsm_id") % 2 == 0, 2).otherwise(3)).withColumn("number_of_segments", F.lit(9))
    return d, s


MOIST = """(SELECT event_id, tsm_id, node_id, CAST(event_id % 500 + 1 AS DOUBLE) AS mval1, CAST(event_id % 331 AS DOUBLE) AS mval2, CASE event_id % 6 WHEN 0 THEN 21 WHEN 1 THEN 26 WHEN 2 THEN 10 WHEN 3 THEN 13 WHEN 4 THEN 110 ELSE 111 END AS type_num, CASE WHEN tsm_id % 2 = 0 THEN 2 ELSE 3 END AS version FROM {readings})"""


@query("moisture_calibration", "F12", f"""SELECT event_id, {R("CASE WHEN version = 2 THEN CASE WHEN mval2 <> 0 THEN ((k / mval1) - (k / mval2)) * 4 / 10 END ELSE mval1 END", 4)} AS mval1 FROM (SELECT *, CASE WHEN tsm_id % 5 = 0 THEN 8000000.0::DOUBLE ELSE 20000000.0::DOUBLE END AS k FROM {MOIST})""")
def _(i):
    d, s = _moisture(i)
    return C.soms_calibrate(d, s, {"probe": 8_000_000.0}).select("event_id", clean_round("mval1", 4).alias("mval1"))


@query("moisture_types", "F13", f"""SELECT event_id, CASE WHEN node_id > 9 THEN 'node' WHEN version = 2 AND type_num NOT IN (21, 26, 112, 111) OR version = 3 AND type_num NOT IN (110, 113, 10, 13) THEN 'type' END AS reject FROM {MOIST}""")
def _(i):
    d, s = _moisture(i)
    return C.soms_validate(d, s).select("event_id", "reject")


@query("pore_pressure", "F14", f"""SELECT event_id, {R('c0 + c1 * f + c2 * t + c3 * f * f + c4 * f * t + c5 * t * t', 4)} AS kpa FROM (SELECT event_id, CAST(2000 + x AS DOUBLE) AS f, CAST(20 + z % 10 AS DOUBLE) AS t, CAST(tsm_id AS DOUBLE) AS c0, 0.5::DOUBLE AS c1, 0.25::DOUBLE AS c2, 0.125::DOUBLE AS c3, 0.0625::DOUBLE AS c4, 0.03125::DOUBLE AS c5 FROM {{readings}})""")
def _(i):
    d = i.readings.select("event_id", "tsm_id", (F.lit(2000) + F.col("x")).cast("double").alias("frequency_shift"), (F.lit(20) + F.col("z") % 10).cast("double").alias("temperature"))
    co = i.sensors.select("tsm_id", F.col("tsm_id").cast("double").alias("c0"), *[F.lit(v).alias(f"c{n}") for n, v in enumerate((0.5, 0.25, 0.125, 0.0625, 0.03125), 1)])
    return C.freq_to_kpa(d, co, "tsm_id").select("event_id", clean_round("kpa", 4).alias("kpa"))


# --- series ----------------------------------------------------------------


def _lin(i):
    return K.to_linear(C.apply_filters(i.readings, NODE, TIE).join(i.sensors, "tsm_id"))


@query("node_grid_ffill", "W1", f"WITH {clean_sql('{readings}', 'tsm_id, node_id')}, {LIN}, {GRID} SELECT * FROM ff")
def _(i):
    return S.resample_ffill(_lin(i), NODE, ["xz", "xy"])


@query("node_grid_window", "W1", f"""WITH {clean_sql('{readings}', 'tsm_id, node_id')}, {LIN}, w AS (SELECT * FROM lin WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts <= TIMESTAMP '2024-01-12 00:00:00'),
g AS (SELECT tsm_id, node_id, unnest(generate_series(TIMESTAMP '2024-01-10 00:00:00', TIMESTAMP '2024-01-12 00:00:00', INTERVAL 30 MINUTE)) AS ts FROM (SELECT DISTINCT tsm_id, node_id FROM w))
SELECT g.tsm_id, g.node_id, g.ts, last_value(xz IGNORE NULLS) OVER (PARTITION BY g.tsm_id, g.node_id ORDER BY g.ts ROWS UNBOUNDED PRECEDING) AS xz FROM g LEFT JOIN w ON g.tsm_id = w.tsm_id AND g.node_id = w.node_id AND g.ts = w.ts""")
def _(i):
    a, b = at("2024-01-10 00:00:00"), at("2024-01-12 00:00:00")
    return S.resample_ffill(_lin(i).filter(F.col("ts").between(a, b)), NODE, ["xz"], a, b)


@query("resample_first", "W3", """SELECT tsm_id, node_id, time_bucket(INTERVAL 30 MINUTE, ts) AS slot, first(x ORDER BY ts, event_id) AS x FROM {readings} GROUP BY ALL""")
def _(i):
    return C.slot_first(i.readings, NODE, ["x"], TIE).withColumnRenamed("ts", "slot")


@query("resample_six_hours", "W3", f"""SELECT tsm_id, node_id, time_bucket(INTERVAL 6 HOUR, ts) AS slot, {R('avg(x)', 4)} AS x FROM {{readings}} GROUP BY ALL""")
def _(i):
    return S.resample(i.readings, NODE, 360, [clean_round(F.avg("x"), 4).alias("x")]).withColumnRenamed("ts", "slot")


@query("resample_weekly", "W3", f"""SELECT tsm_id, node_id, CAST(date_trunc('week', ts) AS DATE) + 6 AS week_end, {R('avg(z)', 4)} AS z, count(z) AS n FROM {{readings}} GROUP BY ALL""")
def _(i):
    return i.readings.groupBy(*NODE, S.week_ending_sunday().alias("week_end")).agg(clean_round(F.avg("z"), 4).alias("z"), F.count("z").alias("n"))


SPARSE_SQL = f"""{clean_sql('{readings}', 'tsm_id, node_id')}, {LIN}, sp AS (SELECT tsm_id, node_id, ts, CASE WHEN node_id = 3 OR date_part('hour', ts) < 12 THEN NULL ELSE xz END AS xz FROM lin)"""


@query("fill_series", "W4", f"""WITH {SPARSE_SQL} SELECT tsm_id, node_id, ts, coalesce(last_value(xz IGNORE NULLS) OVER (PARTITION BY tsm_id, node_id ORDER BY ts ROWS UNBOUNDED PRECEDING), first_value(xz IGNORE NULLS) OVER (PARTITION BY tsm_id, node_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0.0) AS xz FROM sp""")
def _(i):
    d = _lin(i).select(*NODE, "ts", F.when((F.col("node_id") == 3) | (F.hour("ts") < 12), None).otherwise(F.col("xz")).alias("xz"))
    return S.fill(d, NODE, ["xz"])


def _nodes(i):
    return K.node_series(i.readings, i.sensors, TIE)


@query("smooth_series", "W5", f"WITH {SERIES_SQL} SELECT * FROM smo")
def _(i):
    return _nodes(i).select(*NODE, "ts", "xz", "xy")


VEL = f"""vel AS (SELECT tsm_id, node_id, ts, xz, xy, CASE WHEN n = 7 THEN {R('vz', 4)} END AS vel_xz, CASE WHEN n = 7 THEN {R('vy', 4)} END AS vel_xy FROM (SELECT *, count(*) OVER w AS n, regr_slope(xz, d) OVER w AS vz, regr_slope(xy, d) OVER w AS vy FROM (SELECT *, epoch_us(ts - min(ts) OVER (PARTITION BY tsm_id, node_id)) / 86400000000.0 AS d FROM smo)
  WINDOW w AS (PARTITION BY tsm_id, node_id ORDER BY ts ROWS 6 PRECEDING)))"""
VEL = VEL.replace("epoch_us(ts - min(ts) OVER (PARTITION BY tsm_id, node_id))", "date_diff('microsecond', min(ts) OVER (PARTITION BY tsm_id, node_id), ts)")


@query("node_velocity", "W6", f"WITH {SERIES_SQL}, {VEL} SELECT tsm_id, node_id, ts, vel_xz, vel_xy FROM vel")
def _(i):
    return K.velocity(_nodes(i)).select(*NODE, "ts", "vel_xz", "vel_xy")


@query("node_fit_displacement", "W7", f"""WITH {SERIES_SQL}, p AS (SELECT tsm_id, node_id, ts, CASE WHEN count(*) OVER w = 7 THEN {R('regr_slope(xz, k) OVER w * k + regr_intercept(xz, k) OVER w', 6)} END AS predicted FROM (SELECT *, row_number() OVER (PARTITION BY tsm_id, node_id ORDER BY ts)::DOUBLE AS k FROM smo) WINDOW w AS (PARTITION BY tsm_id, node_id ORDER BY ts ROWS 6 PRECEDING))
SELECT *, {R('predicted - lag(predicted, 144) OVER (PARTITION BY tsm_id, node_id ORDER BY ts)', 6)} AS displacement FROM p""")
def _(i):
    return K.linreg_displacement(_nodes(i), NODE, "xz", digits=6).select(*NODE, "ts", "predicted", "displacement")


DISP = f"dsp AS (SELECT tsm_id, node_id, ts, {R('abs(xz - lag(xz, 144) OVER w)', 4)} AS disp_xz, {R('abs(xy - lag(xy, 144) OVER w)', 4)} AS disp_xy FROM smo WINDOW w AS (PARTITION BY tsm_id, node_id ORDER BY ts))"


@query("node_three_day_shift", "W8", f"WITH {SERIES_SQL}, {DISP} SELECT * FROM dsp")
def _(i):
    return K.node_disp(_nodes(i)).select(*NODE, "ts", "disp_xz", "disp_xy")


def _fold(r: str) -> str:
    return f"CASE WHEN {r} > 0 AND {r} < 1 THEN {r} WHEN {r} <> 0 THEN 1.0 / {r} END"


@query("adjacent_ratio", "W9,J16", f"""WITH {SERIES_SQL}, {DISP}, n AS (SELECT tsm_id, node_id, ts, CASE WHEN lag(node_id) OVER w = node_id - 1 THEN greatest(lag(disp_xz) OVER w, lag(disp_xy) OVER w) END / least(nullif(disp_xz, 0), nullif(disp_xy, 0)) AS ru, CASE WHEN lead(node_id) OVER w = node_id + 1 THEN greatest(lead(disp_xz) OVER w, lead(disp_xy) OVER w) END / least(nullif(disp_xz, 0), nullif(disp_xy, 0)) AS rd
 FROM dsp WINDOW w AS (PARTITION BY tsm_id, ts ORDER BY node_id))
SELECT tsm_id, node_id, ts, {R(f'({_fold("ru")}) * 100', 4)} AS up_ratio, {R(f'({_fold("rd")}) * 100', 4)} AS down_ratio FROM n""")
def _(i):
    return K.adjacent_ratio(K.node_disp(_nodes(i)), ["disp_xz", "disp_xy"]).select(*NODE, "ts", "up_ratio", "down_ratio")


@query("adjacent_nodes", "J16", """WITH s AS (SELECT tsm_id, node_id, time_bucket(INTERVAL 30 MINUTE, ts) AS ts, first(x ORDER BY ts, event_id) AS x FROM {readings} GROUP BY ALL) SELECT a.tsm_id, a.node_id, a.ts, a.x, u.x AS up_x, d.x AS down_x FROM s a LEFT JOIN s u ON a.tsm_id = u.tsm_id AND a.ts = u.ts AND u.node_id = a.node_id - 1 LEFT JOIN s d ON a.tsm_id = d.tsm_id AND a.ts = d.ts AND d.node_id = a.node_id + 1""")
def _(i):
    return K.adjacent(C.slot_first(i.readings, NODE, ["x"], TIE), ["x"]).select(*NODE, "ts", "x", "up_x", "down_x")


@query("rolling_spearman", "W10")
def _(i):
    return K.rolling_spearman(_nodes(i), "xz")


@query("zero_to_first", "W18", """WITH f AS (SELECT tsm_id, node_id, first(x ORDER BY ts, event_id) AS x0 FROM {readings} GROUP BY ALL) SELECT event_id, x - x0 AS x FROM {readings} JOIN f USING (tsm_id, node_id)""")
def _(i):
    return S.zeroed(i.readings, NODE, ["x"], TIE).select("event_id", "x")


# --- evaluation at one end time ---------------------------------------------


def _ends(i, *ts):
    return i.spark.sql("SELECT explode(array(" + ", ".join(f"TIMESTAMP_NTZ'{t}'" for t in ts) + ")) AS end_ts")


def kin_sql(end: str, bad: str = "") -> str:
    e = f"TIMESTAMP '{end}'"
    off = f"({e} - INTERVAL 4710 MINUTE)"
    src = f"""src AS (SELECT event_id, tsm_id, node_id, ts, x, y, z, part FROM (SELECT *, unnest(CASE WHEN ts > {off} THEN [1] WHEN ts = {off} THEN [1, 0] ELSE [0] END) AS part FROM {{readings}} WHERE ts >= {off} - INTERVAL 3 DAY AND ts <= {e}))"""
    rnd = lambda a: R(f"{a} / sqrt(x::DOUBLE*x + y::DOUBLE*y + z::DOUBLE*z)", 4)
    return f"""{src}, {clean_sql('src', 'tsm_id, node_id, part')},
pick AS (SELECT * FROM (SELECT *, max(CASE WHEN part = 1 AND ts = {off} THEN 1 END) OVER (PARTITION BY tsm_id, node_id) AS ini, max(CASE WHEN part = 0 THEN ts END) OVER (PARTITION BY tsm_id, node_id) AS bk FROM cln) WHERE part = 1 OR (ini IS NULL AND ts = bk)),
good AS (SELECT * FROM pick p WHERE NOT EXISTS (SELECT 1 FROM {{node_status}} s WHERE s.tsm_id = p.tsm_id AND s.node_id = p.node_id AND status = 4 AND date_identified <= {off})),
pts AS (SELECT tsm_id, node_id, greatest(ts, {off}) AS ts, {rnd('z')} AS xz, {rnd('y')} AS xy FROM good),
lgd AS (SELECT tsm_id, node_id, max(ts) AS last_good FROM good GROUP BY tsm_id, node_id),
nodes AS (SELECT tsm_id, unnest(range(1, 11))::INT AS node_id FROM {{sensors}}),
gr AS (SELECT tsm_id, node_id, unnest(generate_series({off}, {e}, INTERVAL 30 MINUTE)) AS ts FROM nodes),
fl AS (SELECT g.tsm_id, g.node_id, g.ts, coalesce(last_value(xz IGNORE NULLS) OVER a, first_value(xz IGNORE NULLS) OVER b, 0.0) AS xz, coalesce(last_value(xy IGNORE NULLS) OVER a, first_value(xy IGNORE NULLS) OVER b, 0.0) AS xy FROM gr g LEFT JOIN pts p ON g.tsm_id = p.tsm_id AND g.node_id = p.node_id AND g.ts = p.ts
  WINDOW a AS (PARTITION BY g.tsm_id, g.node_id ORDER BY g.ts ROWS UNBOUNDED PRECEDING), b AS (PARTITION BY g.tsm_id, g.node_id ORDER BY g.ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
smo AS (SELECT tsm_id, node_id, ts, {R('mz', 4)} AS xz, {R('my', 4)} AS xy FROM (SELECT *, avg(xz) OVER w AS mz, avg(xy) OVER w AS my, row_number() OVER (PARTITION BY tsm_id, node_id ORDER BY ts) AS n FROM fl WINDOW w AS (PARTITION BY tsm_id, node_id ORDER BY ts ROWS 6 PRECEDING)) WHERE n >= 7),
{VEL},
kin AS (SELECT {e} AS end_ts, vel.*, last_good FROM vel LEFT JOIN lgd USING (tsm_id, node_id) WHERE ts >= {e} - INTERVAL 3 DAY)"""


KIN = kin_sql(END)


def _kin(i, *ends):
    return P.subsurface_kinematics(i.readings, i.sensors, _ends(i, *(ends or (END,))), i.node_status, tie=TIE)


@query("subsurface_kinematics", "P1,I1,J12,F7", f"WITH {KIN} SELECT end_ts, tsm_id, node_id, ts, xz, xy, vel_xz, vel_xy, last_good FROM kin")
def _(i):
    return _kin(i).select("end_ts", *NODE, "ts", "xz", "xy", "vel_xz", "vel_xy", "last_good")


@query("last_good_before", "J12,A1", f"""WITH {kin_sql(END)} SELECT tsm_id, node_id, bk AS ts, x, y, z FROM pick WHERE part = 0 AND ini IS NULL""")
def _(i):
    d = P.windowed_readings(i.readings, i.sensors, _ends(i, END))
    c = C.outlier_filter(C.orthogonal_filter(C.range_filter(d)), [*P.SERIES, "part"], TIE)
    offset = F.col("end_ts") - span(mins=4710)
    has = c.filter((F.col("part") == 1) & (F.col("ts") == offset)).select(*NODE)
    back = c.filter("part = 0").groupBy(*NODE).agg(F.max_by(F.struct("ts", "x", "y", "z"), "ts").alias("r"))
    return back.join(has, NODE, "left_anti").select(*NODE, "r.*")


ALERT = """al0 AS (SELECT end_ts, tsm_id, node_id, arg_min(xz, ts) AS z0, arg_max(xz, ts) AS z1, arg_min(xy, ts) AS y0, arg_max(xy, ts) AS y1, abs(arg_max(vel_xz, ts)) AS vz, abs(arg_max(vel_xy, ts)) AS vy, max(last_good) AS lg FROM kin GROUP BY ALL),
al1 AS (SELECT *, CAST(round((z1 - z0) * 10000) AS BIGINT) AS iz, CAST(round((y1 - y0) * 10000) AS BIGINT) AS iy FROM al0),
al2 AS (SELECT *, sign(iz) * ((abs(iz) + 5) // 10) / 1000.0 + 0.0 AS xz_disp, sign(iy) * ((abs(iy) + 5) // 10) / 1000.0 + 0.0 AS xy_disp, least(vz, vy) AS min_vel, greatest(vz, vy) AS max_vel, CASE WHEN lg >= end_ts - INTERVAL 3 HOUR THEN 1 ELSE 0 END AS nd FROM al1)"""
AXES_ALERT = ALERT + """,
al3 AS (SELECT *, CASE WHEN nd = 0 THEN -1 WHEN (abs(xz_disp) > 0.05 OR abs(xy_disp) > 0.05) AND least(abs(xz_disp), abs(xy_disp)) / greatest(abs(xz_disp), abs(xy_disp)) > 0.1 THEN 2 ELSE 0 END AS disp_alert,
 CASE WHEN nd = 0 THEN -1 WHEN max_vel > 0 AND min_vel / max_vel > 0.1 THEN CASE WHEN max_vel >= 0.5 THEN 3 WHEN max_vel >= 0.032 THEN 2 ELSE 0 END ELSE 0 END AS vel_alert FROM al2),
na AS (SELECT end_ts, tsm_id, node_id, xz_disp, xy_disp, min_vel, max_vel, nd, disp_alert, vel_alert, greatest(disp_alert, vel_alert) AS node_alert FROM al3)"""


@query("node_alerts", "P2", f"WITH {KIN}, {AXES_ALERT} SELECT * FROM na")
def _(i):
    return P.node_alerts(_kin(i))


@query("node_alerts_net", "P6", f"""WITH {KIN}, a AS (SELECT end_ts, tsm_id, node_id, arg_min(sqrt(xz*xz+xy*xy), ts) AS n0, arg_max(sqrt(xz*xz+xy*xy), ts) AS n1, arg_max(sqrt(vel_xz*vel_xz+vel_xy*vel_xy), ts) AS v, max(last_good) AS lg FROM kin GROUP BY ALL),
b AS (SELECT end_ts, tsm_id, node_id, {R('n1 - n0', 3)} AS disp, {R('v', 4)} AS net_vel, CASE WHEN lg >= end_ts - INTERVAL 3 HOUR THEN 1 ELSE 0 END AS nd FROM a),
c AS (SELECT *, CASE WHEN nd = 0 THEN -1 WHEN abs(disp) > 0.05 THEN 2 ELSE 0 END AS disp_alert, CASE WHEN nd = 0 THEN -1 WHEN net_vel <= 0.032 THEN 0 WHEN net_vel <= 0.5 THEN 2 ELSE 3 END AS vel_alert FROM b)
SELECT *, greatest(disp_alert, vel_alert) AS node_alert, CASE greatest(disp_alert, vel_alert) WHEN -1 THEN 'VN' WHEN 0 THEN 'V0' WHEN 2 THEN 'V2' ELSE 'V3' END AS code FROM c""")
def _(i):
    return P.node_alerts(_kin(i), mode="net").withColumn("code", P.code_of("node_alert", P.NET_CODES))


@query("node_alerts_no_adjacency", "P7", f"""WITH {KIN}, {ALERT}, c AS (SELECT end_ts, tsm_id, node_id, xz_disp, xy_disp, min_vel, max_vel, nd, CASE WHEN nd = 0 THEN -1 WHEN (abs(xz_disp) > 0.05 OR abs(xy_disp) > 0.05) AND NOT (least(abs(xz_disp), abs(xy_disp)) / greatest(abs(xz_disp), abs(xy_disp)) < 0.1) THEN 1 ELSE 0 END AS disp_alert,
 CASE WHEN nd = 0 THEN -1 WHEN max_vel > 0 AND min_vel / max_vel < 0.1 THEN 0 WHEN max_vel <= 0.032 THEN 0 WHEN max_vel <= 0.5 THEN 1 ELSE 2 END AS vel_alert FROM al2)
SELECT *, greatest(disp_alert, vel_alert) AS node_alert, CASE greatest(disp_alert, vel_alert) WHEN -1 THEN 'ND' WHEN 0 THEN 'L0' WHEN 1 THEN 'L2' ELSE 'L3' END AS code FROM c""")
def _(i):
    return P.node_alerts(_kin(i), mode="noadj").withColumn("code", P.code_of("node_alert", P.NOADJ_CODES))


ADJ = """adj AS (SELECT n.*, b.d AS bd, b.mv AS bmv FROM na n LEFT JOIN (SELECT * FROM (SELECT i.tsm_id, i.node_id, abs(j.node_id - i.node_id) AS d, j.max_vel AS mv, row_number() OVER (PARTITION BY i.tsm_id, i.node_id ORDER BY abs(j.node_id - i.node_id), j.node_id) AS rn FROM na i JOIN na j ON i.tsm_id = j.tsm_id AND j.nd = 1 AND abs(j.node_id - i.node_id) BETWEEN 1 AND 2) WHERE rn = 1) b ON n.tsm_id = b.tsm_id AND n.node_id = b.node_id),
val AS (SELECT end_ts, tsm_id, node_id, node_alert, CASE WHEN vel_alert <= 0 THEN node_alert WHEN bmv IS NULL THEN -1 WHEN bmv >= abs(max_vel) / (2.0 ** bd) THEN node_alert WHEN min_vel >= 0.5 AND bmv >= abs(min_vel) / (2.0 ** bd) THEN 2 WHEN min_vel >= 0.032 AND bmv >= abs(min_vel) / (2.0 ** bd) THEN 1 WHEN disp_alert > 0 THEN disp_alert ELSE 0 END AS col_alert FROM adj)"""


@query("validate_adjacent_nodes", "P3", f"WITH {KIN}, {AXES_ALERT}, {ADJ} SELECT * FROM val")
def _(i):
    return P.validate_adjacent(P.node_alerts(_kin(i))).select("end_ts", *NODE, "node_alert", "col_alert")


# evaluation history: four earlier half-hours derived from the same readings
HIST = """hist AS (SELECT na.tsm_id, na.node_id, end_ts - INTERVAL 30 MINUTE * k AS ts, node_alert FROM na CROSS JOIN (VALUES (0), (1), (2), (3)) AS v(k) WHERE NOT (na.tsm_id % 3 = 1 AND k = 3))"""


def _history(n):
    return n.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(3)))).filter(
        ~((F.col("tsm_id") % 3 == 1) & (F.col("k") == 3))
    ).select(*NODE, (F.col("end_ts") - span(mins=F.col("k") * 30)).alias("ts"), "node_alert")


@query("sensor_alerts", "P5,A8", f"""WITH {KIN}, {AXES_ALERT}, {ADJ}, {HIST},
hot AS (SELECT tsm_id, node_id FROM val WHERE col_alert > 0),
tn AS (SELECT tsm_id, node_id, CASE WHEN count(*) FILTER (node_alert > 0) > 3 THEN max(node_alert) ELSE 0 END AS t FROM hist JOIN hot USING (tsm_id, node_id) WHERE ts >= TIMESTAMP '{END}' - INTERVAL 3 HOUR AND ts <= TIMESTAMP '{END}' GROUP BY ALL),
md AS (SELECT tsm_id, arg_max(col_alert, c * 100 + col_alert) AS m FROM (SELECT tsm_id, col_alert, count(*) AS c FROM val GROUP BY ALL) GROUP BY tsm_id)
SELECT TIMESTAMP '{END}' AS ts, md.tsm_id, CAST(CASE WHEN EXISTS (SELECT 1 FROM hot WHERE hot.tsm_id = md.tsm_id) THEN coalesce((SELECT max(t) FROM tn WHERE tn.tsm_id = md.tsm_id), 0) ELSE m END AS INT) AS alert_level, TIMESTAMP '{END}' AS ts_updated FROM md""")
def _(i):
    n = P.validate_adjacent(P.node_alerts(_kin(i)))
    return P.sensor_alerts(n, _history(n))


@query("trending_levels", "P4", """SELECT event_id, CAST(CASE WHEN count(*) FILTER (alert_level > 0) OVER w > 3 THEN max(alert_level) OVER w ELSE 0 END AS INT) AS trend FROM {evals} WINDOW w AS (PARTITION BY site_id, trigger_source ORDER BY ts RANGE BETWEEN INTERVAL 3 HOUR PRECEDING AND CURRENT ROW)""")
def _(i):
    return P.trending(i.evals, ["site_id", "trigger_source"], "alert_level").select("event_id", "trend")


@query("trending_at_end", "P4", f"""SELECT site_id, trigger_source, CAST(CASE WHEN count(*) FILTER (alert_level > 0) > 3 THEN max(alert_level) ELSE 0 END AS INT) AS trend FROM {{evals}} WHERE ts >= TIMESTAMP '{END}' - INTERVAL 3 HOUR AND ts <= TIMESTAMP '{END}' GROUP BY ALL""")
def _(i):
    return P.trending_at(i.evals, ["site_id", "trigger_source"], at(END), "alert_level")


@query("mode_of_levels", "A8", """WITH c AS (SELECT site_id, alert_level, count(*) AS n FROM {evals} GROUP BY ALL) SELECT site_id, alert_level AS mode FROM c QUALIFY row_number() OVER (PARTITION BY site_id ORDER BY n DESC, alert_level DESC) = 1""")
def _(i):
    return P.mode_pick(i.evals, ["site_id"], "alert_level")


@query("site_trigger", "P8,A9", """SELECT s.site_id, max(alert_level) AS alert_level FROM (SELECT CAST(site_id % 5 AS INT) AS tsm_id, ts, ts_updated, alert_level FROM {intervals}) i JOIN {sensors} s ON i.tsm_id = s.tsm_id WHERE ts <= TIMESTAMP '1997-06-01 00:20:00' AND ts_updated >= TIMESTAMP '1997-06-01 00:20:00' GROUP BY s.site_id""")
def _(i):
    d = i.intervals.withColumn("tsm_id", (F.col("site_id") % 5).cast("int")).drop("site_id")
    return P.site_trigger(d, i.sensors, at("1997-06-01 00:20:00"))


COLPOS = f"""cp0 AS (SELECT tsm_id, node_id, ts, xz, xy, coalesce(CASE WHEN 1 - xz*xz - xy*xy >= 0 THEN sqrt(1.0 - xz*xz - xy*xy) END, 1.0) AS seg FROM kin WHERE date_diff('minute', ts, end_ts) % 240 = 0 AND date_diff('minute', ts, end_ts) < 1680),
cp1 AS (SELECT * FROM cp0 UNION ALL SELECT DISTINCT tsm_id, 11 AS node_id, ts, 0.0, 0.0, 1.0 FROM cp0),
cp2 AS (SELECT *, {R('sum(xz) OVER d', 4)} AS cs_xz, {R('sum(xy) OVER d', 4)} AS cs_xy, sum(round(seg, 4)) OVER a AS cum FROM cp1 WINDOW d AS (PARTITION BY tsm_id, ts ORDER BY node_id DESC ROWS UNBOUNDED PRECEDING), a AS (PARTITION BY tsm_id, ts ORDER BY node_id ROWS UNBOUNDED PRECEDING)),
cp3 AS (SELECT *, round(cum - min(cum) OVER (PARTITION BY tsm_id, ts), 4) AS dep FROM cp2)"""


@query("column_position", "W19", f"""WITH {KIN}, {COLPOS} SELECT TIMESTAMP '{END}' AS end_ts, tsm_id, ts, node_id, cs_xz, cs_xy, {R('-(dep + max(dep) OVER (PARTITION BY tsm_id) - max(dep) OVER (PARTITION BY tsm_id, ts))', 4)} AS depth FROM cp3""")
def _(i):
    return P.column_position(_kin(i), i.sensors)


@query("column_position_top", "W19", f"""WITH {KIN}, c0 AS (SELECT tsm_id, node_id, ts, xz, xy, coalesce(CASE WHEN 1 - xz*xz - xy*xy >= 0 THEN sqrt(1.0 - xz*xz - xy*xy) END, 1.0) AS seg FROM kin WHERE date_diff('minute', ts, end_ts) % 240 = 0 AND date_diff('minute', ts, end_ts) < 1680),
c1 AS (SELECT * FROM c0 UNION ALL SELECT DISTINCT tsm_id, 0 AS node_id, ts, 0.0, 0.0, 0.0 FROM c0)
SELECT TIMESTAMP '{END}' AS end_ts, tsm_id, ts, node_id, {R('sum(xz) OVER a', 4)} AS cs_xz, {R('sum(xy) OVER a', 4)} AS cs_xy, {R('-(sum(round(seg, 4)) OVER a)', 4)} AS depth FROM c1 WINDOW a AS (PARTITION BY tsm_id, ts ORDER BY node_id ROWS UNBOUNDED PRECEDING)""")
def _(i):
    return P.column_position(_kin(i), i.sensors, fix="top")


OFFS = "po AS (SELECT tsm_id, avg(r) AS o FROM (SELECT tsm_id, node_id, max(xz) - min(xz) AS r FROM kin GROUP BY ALL) GROUP BY tsm_id)"


@query("plot_offset", "W20", f"""WITH {KIN}, r AS (SELECT tsm_id, node_id, max(xz) - min(xz) AS r FROM kin GROUP BY ALL) SELECT tsm_id, {R('max(r)', 6)} AS largest, {R('avg(r)', 6)} AS average, {R('min(r)', 6)} AS smallest FROM r GROUP BY tsm_id""")
def _(i):
    k = _kin(i)
    per = k.groupBy("tsm_id", "node_id").agg((F.max("xz") - F.min("xz")).alias("r"))
    return per.groupBy("tsm_id").agg(*[clean_round(f("r"), 6).alias(n) for f, n in ((F.max, "largest"), (F.avg, "average"), (F.min, "smallest"))])


@query("offset_displacement", "W20,W18", f"""WITH {KIN}, {OFFS}, f AS (SELECT tsm_id, node_id, arg_min(xz, ts) AS a, arg_min(xy, ts) AS b FROM kin GROUP BY ALL)
SELECT tsm_id, node_id, ts, {R('round(xz - a, 4) + (10 - node_id) * o', 6)} AS xz, {R('round(xy - b, 4) + (10 - node_id) * o', 6)} AS xy FROM kin JOIN f USING (tsm_id, node_id) JOIN po USING (tsm_id)""")
def _(i):
    d = P.disp_offset(_kin(i), i.sensors, digits=6)
    return d.select(*NODE, "ts", "xz", "xy")


@query("cumulative_surface", "W20", f"""WITH {KIN}, {OFFS}, t AS (SELECT tsm_id, ts, sum(xz) AS sz, sum(xy) AS sy FROM kin GROUP BY ALL), f AS (SELECT tsm_id, arg_min(sz, ts) AS a, arg_min(sy, ts) AS b FROM t GROUP BY tsm_id)
SELECT tsm_id, ts, {R('sz - a + o * 10', 6)} AS xz, {R('sy - b + o * 10', 6)} AS xy FROM t JOIN f USING (tsm_id) JOIN po USING (tsm_id)""")
def _(i):
    d = P.cumulative_surface(_kin(i), i.sensors, digits=6)
    return d.select("tsm_id", "ts", "xz", "xy")


@query("classify_velocity", "W21", f"""WITH {KIN}, l AS (SELECT end_ts, tsm_id, node_id, ts, 'vel_xz' AS axis, vel_xz AS velocity FROM kin UNION ALL SELECT end_ts, tsm_id, node_id, ts, 'vel_xy', vel_xy FROM kin) SELECT *, CASE WHEN abs(velocity) > 0.5 THEN 3 ELSE 2 END AS level FROM l WHERE abs(velocity) > 0.032""")
def _(i):
    return P.classify_velocity(_kin(i))


BAND = """hb AS (SELECT tsm_id, node_id, CAST(round(xz / 0.001::DOUBLE) AS BIGINT) AS b, count(*) AS n FROM kin GROUP BY ALL),
dn AS (SELECT tsm_id, node_id, b + o AS bin, round(sum(n * exp(-(o * o) / 8.0)), 6) AS dens FROM hb CROSS JOIN range(-6, 7) AS r(o) GROUP BY ALL),
pk AS (SELECT * FROM (SELECT *, CASE WHEN lag(bin) OVER w = bin - 1 THEN lag(dens) OVER w ELSE 0 END AS l, CASE WHEN lead(bin) OVER w = bin + 1 THEN lead(dens) OVER w ELSE 0 END AS r, max(dens) OVER (PARTITION BY tsm_id, node_id) AS top FROM dn WINDOW w AS (PARTITION BY tsm_id, node_id ORDER BY bin)) WHERE dens > l AND dens >= r AND dens >= top * 0.05),
bd AS (SELECT tsm_id, node_id, CASE WHEN min(bin) <> max(bin) THEN round(min(bin) * 0.001::DOUBLE, 6) END AS low, CASE WHEN min(bin) <> max(bin) THEN round(max(bin) * 0.001::DOUBLE, 6) END AS high FROM pk GROUP BY ALL)"""


@query("noise_band", "W22", f"WITH {KIN}, {BAND} SELECT tsm_id, node_id, low + 0.0 AS low, high + 0.0 AS high FROM bd")
def _(i):
    return P.noise_band(_kin(i), "xz").drop("end_ts")


@query("noise_band_cumulative", "W22", f"WITH {KIN}, {BAND} SELECT tsm_id, node_id, {R('sum(low) OVER w', 6)} AS low, {R('sum(high) OVER w', 6)} AS high FROM bd WINDOW w AS (PARTITION BY tsm_id ORDER BY node_id DESC ROWS UNBOUNDED PRECEDING)")
def _(i):
    return P.cumulative_band(P.noise_band(_kin(i), "xz")).drop("end_ts")


@query("noise_envelope", "W22", f"""WITH {KIN}, {BAND}, {OFFS}, f AS (SELECT tsm_id, node_id, arg_min(xz, ts) AS a FROM kin GROUP BY ALL) SELECT tsm_id, node_id, {R('low - a + (10 - node_id) * o', 6)} AS low, {R('high - a + (10 - node_id) * o', 6)} AS high FROM bd JOIN f USING (tsm_id, node_id) JOIN po USING (tsm_id)""")
def _(i):
    k = _kin(i)
    d = P.noise_envelope(k, P.noise_band(k, "xz"), i.sensors, digits=6)
    return d.select(*NODE, "low", "high")


def note_sql(axis: str) -> str:
    """CTEs r_, c_ and n_ of an axis: node, its rank correlation with time, its annotation."""
    return f"""r_{axis} AS (SELECT tsm_id, node_id, {axis} AS v, row_number() OVER (PARTITION BY tsm_id, node_id ORDER BY ts)::DOUBLE AS i, rank() OVER (PARTITION BY tsm_id, node_id ORDER BY {axis}) + (count(*) OVER (PARTITION BY tsm_id, node_id, {axis}) - 1) / 2.0 AS k FROM kin),
c_{axis} AS (SELECT tsm_id, node_id, CASE WHEN stddev_pop(k) > 0 THEN corr(i, k) END AS rho, max(v) - min(v) AS spread FROM r_{axis} GROUP BY ALL),
n_{axis} AS (SELECT tsm_id, node_id, node_id || CASE WHEN spread > 0.01 THEN repeat('+', least(CAST(CASE WHEN rho > 0.5 THEN floor(round((round_even(rho, 1) - 0.5) * 10, 6)) ELSE 0 END AS INT), 4)) ELSE '' END AS t FROM c_{axis})"""


PARTS = f"""{OFFS}, f AS (SELECT tsm_id, node_id, arg_min(xz, ts) AS a, arg_min(xy, ts) AS b FROM kin GROUP BY ALL), t AS (SELECT tsm_id, ts, sum(xz) AS sz, sum(xy) AS sy FROM kin GROUP BY ALL), f2 AS (SELECT tsm_id, arg_min(sz, ts) AS a, arg_min(sy, ts) AS b FROM t GROUP BY tsm_id), {note_sql('xz')}, {note_sql('xy')},
vl AS (SELECT tsm_id, node_id, ts, 'downslope' AS axis, abs(vel_xz) AS v FROM kin WHERE ts >= end_ts - INTERVAL 3 HOUR UNION ALL SELECT tsm_id, node_id, ts, 'latslope', abs(vel_xy) FROM kin WHERE ts >= end_ts - INTERVAL 3 HOUR)
SELECT 'column' AS part, tsm_id, ts, node_id, cs_xz AS downslope, cs_xy AS latslope, {R('-(dep + max(dep) OVER (PARTITION BY tsm_id) - max(dep) OVER (PARTITION BY tsm_id, ts))', 4)} AS depth, NULL AS text FROM cp3
UNION ALL SELECT 'disp', tsm_id, ts, node_id, {R('round(xz - a, 4) + (10 - node_id) * o', 6)}, {R('round(xy - b, 4) + (10 - node_id) * o', 6)}, NULL, NULL FROM kin JOIN f USING (tsm_id, node_id) JOIN po USING (tsm_id)
UNION ALL SELECT 'cumulative', tsm_id, ts, NULL, {R('sz - a + o * 10', 6)}, {R('sy - b + o * 10', 6)}, NULL, NULL FROM t JOIN f2 USING (tsm_id) JOIN po USING (tsm_id)
UNION ALL SELECT 'base', tsm_id, NULL, NULL, {R('o * 10', 6)}, NULL, NULL, NULL FROM po
UNION ALL SELECT 'annotation', tsm_id, NULL, node_id, NULL, NULL, NULL, n_xz.t || ' ' || n_xy.t FROM n_xz JOIN n_xy USING (tsm_id, node_id)
UNION ALL SELECT 'velocity', tsm_id, ts, node_id, NULL, NULL, NULL, axis || CASE WHEN v > 0.5 THEN ' L3' ELSE ' L2' END FROM vl WHERE v > 0.032"""


@query("displacement_bundle", "P22,A23,I13", f"WITH {KIN}, {COLPOS}, {PARTS}")
def _(i):
    b = P.bundle(_kin(i), i.sensors, digits=6)
    null = F.lit(None)
    row = lambda part, ts=null, node=null, down=null, lat=null, depth=null, text=null: F.struct(
        F.lit(part).alias("part"), ts.cast("timestamp_ntz").alias("ts"), node.cast("int").alias("node_id"), down.cast("double").alias("downslope"),
        lat.cast("double").alias("latslope"), depth.cast("double").alias("depth"), text.cast("string").alias("text"))
    moving = lambda axis, level: F.transform(F.col(f"v.{axis}.L{level}"), lambda x: row("velocity", x["ts"], x["node_id"], text=F.lit(f"{axis} L{level}")))
    parts = F.concat(
        F.transform("c", lambda x: row("column", x["ts"], x["node_id"], x["downslope"], x["latslope"], x["depth"])),
        F.transform("d.disp", lambda x: row("disp", x["ts"], x["node_id"], x["downslope"], x["latslope"])),
        F.transform("d.cumulative", lambda x: row("cumulative", x["ts"], down=x["downslope"], lat=x["latslope"])),
        F.array(row("base", down=F.col("d.cml_base"))),
        F.transform("d.annotation", lambda x: row("annotation", node=x["node_id"], text=F.concat_ws(" ", x["downslope_annotation"], x["latslope_annotation"]))),
        *[moving(a, n) for a in ("downslope", "latslope") for n in (2, 3)],
    )
    return b.select("tsm_id", F.explode(parts).alias("x")).select("tsm_id", "x.*")


B_ENDS = [f"2024-01-20 {h}:00" for h in ("11:00", "11:30", "12:00")]


def _one_end(e):
    return f"SELECT end_ts, tsm_id, node_id, disp_alert, vel_alert, node_alert FROM (WITH {kin_sql(e)}, {AXES_ALERT} SELECT * FROM na)"


@query("backfill_levels", "P23,F18", "SELECT a.* FROM (" + " UNION ALL ".join(_one_end(e) for e in B_ENDS) + ") a JOIN (SELECT tsm_id, max(ts) AS l FROM {readings} GROUP BY tsm_id) m ON a.tsm_id = m.tsm_id WHERE m.l >= a.end_ts AND (a.tsm_id % 2 = 0 OR a.end_ts > TIMESTAMP '2024-01-20 11:00:00')")
def _(i):
    done = i.sensors.filter("tsm_id % 2 = 1").select("tsm_id", F.lit("2024-01-20 11:00:00").cast("timestamp_ntz").alias("ts"))
    d = P.backfill(i.readings, i.sensors, B_ENDS[0], B_ENDS[-1], done=done, status=i.node_status, tie=TIE)
    return d.select("end_ts", *NODE, "disp_alert", "vel_alert", "node_alert")


@query("evaluation_windows", "F18", """SELECT event_id, time_bucket(INTERVAL 30 MINUTE, ts) AS end_ts, time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 3 DAY AS start_ts, time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 4710 MINUTE AS offset_ts, 7 AS points FROM {events}""")
def _(i):
    return evaluation_grid(i.events.select("event_id", F.col("ts").alias("end_ts")))
