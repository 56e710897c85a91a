"""Queries over rain, quakes, markers, alert intervals and statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clock as T, geo as G
from ..functions.clock import at, clean_round, span
from ..functions.scan import previous, row_index, scan
from ..operators import clean as C, intervals as I, series as S, stats as A
from ..plans import alerts as AL, earthquake as Q, rainfall as RF, surficial as SU
from ..plans.windows import rain_grid
from .registry import query
from .sensor_queries import END, FIX, NODE, R, TIE

E = f"TIMESTAMP '{END}'"

# --- rain -------------------------------------------------------------------

SLOT = "time_bucket(INTERVAL 30 MINUTE, ts - INTERVAL 1 MICROSECOND)"
RSUM = f"rs AS (SELECT rain_id, {SLOT} AS slot, sum(rain) AS rain FROM {{rain}} WHERE rain >= 0 GROUP BY ALL)"
RGRID = RSUM + """,
rg AS (SELECT g.rain_id, g.ts, rs.rain FROM (SELECT rain_id, unnest(generate_series(min(slot), max(slot), INTERVAL 30 MINUTE)) AS ts FROM rs GROUP BY rain_id) g LEFT JOIN rs ON g.rain_id = rs.rain_id AND g.ts = rs.slot)"""


def _rain_grid(i):
    s = S.resample_sum_right(i.rain.filter("rain >= 0"), ["rain_id"], "rain")
    return S.grid(s, ["rain_id"], ["rain"])


@query("rain_slots", "W2,A7", f"WITH {RSUM} SELECT rain_id, slot AS ts, rain FROM rs")
def _(i):
    return S.resample_sum_right(i.rain.filter("rain >= 0"), ["rain_id"], "rain")


@query("rain_rolling_totals", "W11", f"WITH {RGRID} SELECT rain_id, ts, rain, {R('sum(rain) OVER (PARTITION BY rain_id ORDER BY ts ROWS 47 PRECEDING)', 4)} AS day, {R('sum(rain) OVER (PARTITION BY rain_id ORDER BY ts ROWS 143 PRECEDING)', 4)} AS three_days FROM rg")
def _(i):
    return S.rolling_sums(_rain_grid(i), ["rain_id"], "rain", {"day": 48, "three_days": 144})


@query("rain_gaps", "W12", f"WITH {RGRID}, n AS (SELECT rain_id, ts, ts - INTERVAL 30 MINUTE * row_number() OVER (PARTITION BY rain_id ORDER BY ts) AS run FROM rg WHERE rain IS NULL) SELECT rain_id, min(ts) AS ts_start, max(ts) + INTERVAL 30 MINUTE AS ts_end FROM n GROUP BY rain_id, run")
def _(i):
    return S.gaps(_rain_grid(i), ["rain_id"], "rain")


@query("rain_cumulative", "A6", f"""WITH {RSUM} SELECT rain_id, coalesce(sum(rain) FILTER (slot > {E} - INTERVAL 1 DAY), 0.0) AS one_day, sum(rain) AS three_day FROM rs WHERE slot > {E} - INTERVAL 3 DAY AND slot <= {E} GROUP BY rain_id""")
def _(i):
    return RF.cumulative_at(S.resample_sum_right(i.rain.filter("rain >= 0"), ["rain_id"], "rain"), ["rain_id"], at(END))


@query("untagged_rain", "F8", """SELECT event_id, rain_id, ts, rain FROM {rain} r WHERE NOT EXISTS (SELECT 1 FROM {tags} t WHERE t.rain_id = r.rain_id AND r.ts > t.ts_start AND r.ts < coalesce(t.ts_end, t.ts_start + INTERVAL 1 DAY))""")
def _(i):
    return C.drop_tagged(i.rain, i.tags)


HAV = "2 * 6371.0 * atan2(sqrt(h), sqrt(greatest(0.0, 1 - h)))"


def hav(a1, o1, a2, o2):
    s1, s2 = f"sin((radians({a2}) - radians({a1})) / 2)", f"sin(radians({o2} - {o1}) / 2)"
    return f"({s1} * {s1} + cos(radians({a1})) * cos(radians({a2})) * {s2} * {s2})"


NEAR = f"""nr AS (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY d, rain_id) AS rank FROM (SELECT site_id, rain_id, {HAV} AS d FROM (SELECT s.site_id, g.rain_id, {hav('s.latitude', 's.longitude', 'g.latitude', 'g.longitude')} AS h FROM {{sites}} s CROSS JOIN {{gauges}} g WHERE g.active)))"""


@query("nearest_gauges", "J5,A4,F19", f"WITH {NEAR} SELECT site_id, rain_id, {R('d', 2)} AS distance, CAST(rank AS INT) AS rank FROM nr WHERE rank <= 4")
def _(i):
    return Q.nearest_gauges(i.sites, i.gauges)


@query("gauge_priorities", "J6", f"""WITH {NEAR}, f AS (SELECT site_id, rain_id, {R('d', 2)} AS distance FROM nr WHERE rank <= 4) SELECT p.priority_id, f.site_id, f.rain_id, f.distance FROM f LEFT JOIN (SELECT site_id, rain_id, site_id * 1000 + rain_id AS priority_id FROM {{sites}} CROSS JOIN {{gauges}} WHERE (site_id + rain_id) % 3 = 0) p ON f.site_id = p.site_id AND f.rain_id = p.rain_id""")
def _(i):
    fresh = Q.nearest_gauges(i.sites, i.gauges)
    stored = fresh.filter((F.col("site_id") + F.col("rain_id")) % 3 == 0).select("site_id", "rain_id", (F.col("site_id") * 1000 + F.col("rain_id")).alias("priority_id"))
    return Q.update_priorities(stored, fresh)


RAINAL = f"""{NEAR}, cl AS (SELECT * FROM {{rain}} r WHERE ts > {E} - INTERVAL 4350 MINUTE AND ts < {E} AND rain <> -1 AND NOT EXISTS (SELECT 1 FROM {{tags}} t WHERE t.rain_id = r.rain_id AND r.ts > t.ts_start AND r.ts < coalesce(t.ts_end, t.ts_start + INTERVAL 1 DAY))),
tt AS (SELECT rain_id, max(ts) AS latest, sum(rain) FILTER (rain >= 0 AND {SLOT} > {E} - INTERVAL 1 DAY) AS one, sum(rain) FILTER (rain >= 0 AND {SLOT} > {E} - INTERVAL 3 DAY) AS three, count(*) FILTER (rain >= 0 AND {SLOT} >= {E} - INTERVAL 4350 MINUTE) AS n FROM cl GROUP BY rain_id HAVING max(ts) > {E} - INTERVAL 1 DAY),
bs AS (SELECT * FROM (SELECT nr.site_id, tt.*, row_number() OVER (PARTITION BY nr.site_id ORDER BY round(d, 2), nr.rain_id) AS k FROM nr JOIN tt USING (rain_id) WHERE rank <= 4) WHERE k = 1),
ra AS (SELECT s.site_id, b.rain_id, CASE WHEN n > 0 THEN coalesce(one, 0.0) END AS one_day, CASE WHEN n > 0 THEN coalesce(three, 0.0) END AS three_day, threshold_value / 2 AS half_max, threshold_value AS full_max FROM {{sites}} s LEFT JOIN bs b ON s.site_id = b.site_id),
rl AS (SELECT *, CASE WHEN one_day >= half_max OR three_day >= full_max THEN 1 WHEN one_day IS NULL THEN -1 ELSE 0 END AS alert_level FROM ra)"""


def _rain_alerts(i):
    pr = Q.nearest_gauges(i.sites, i.gauges).select("site_id", "rain_id", "distance")
    return RF.rainfall_alerts(i.rain, pr, i.sites, at(END), i.tags)


@query("rainfall_alerts", "P9", f"WITH {RAINAL} SELECT * FROM rl")
def _(i):
    return _rain_alerts(i)


@query("rainfall_codes", "P9", f"""WITH {RAINAL} SELECT site_id, rain_id, alert_level, 'a' AS rain_alert, one_day AS cumulative, half_max AS threshold FROM rl WHERE alert_level = 1 AND one_day >= half_max
UNION ALL SELECT site_id, rain_id, alert_level, 'b', three_day, full_max FROM rl WHERE alert_level = 1 AND three_day >= full_max
UNION ALL SELECT site_id, rain_id, alert_level, 'x', CASE WHEN one_day >= half_max * 0.75 THEN one_day ELSE three_day END, CASE WHEN one_day >= half_max * 0.75 THEN half_max ELSE full_max END FROM rl WHERE alert_level = 0 AND (one_day >= half_max * 0.75 OR three_day >= full_max * 0.75)""")
def _(i):
    return RF.rain_codes(_rain_alerts(i))


PUB_AT = "TIMESTAMP '1997-06-01 00:20:00'"
PL = f"pl AS (SELECT site_id, arg_max(alert_level, (ts, public_id)) AS alert_level, max(ts) AS ts FROM {{public_alerts}} WHERE ts <= {PUB_AT} AND ts_updated >= {PUB_AT} - INTERVAL 30 MINUTE GROUP BY site_id)"
ES = """es AS (SELECT site_id, min(ts) AS event_start, max(ts_updated) AS event_end, count(*) AS links FROM (SELECT *, sum(new) OVER (PARTITION BY site_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS isl FROM (SELECT *, CASE WHEN coalesce(max(ts_updated) OVER (PARTITION BY site_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) >= ts - INTERVAL 30 MINUTE, false) THEN 0 ELSE 1 END AS new FROM {intervals})) GROUP BY site_id, isl)"""


@query("public_levels", "P19", f"WITH {PL} SELECT * FROM pl")
def _(i):
    return I.public_level(i.public_alerts, at("1997-06-01 00:20:00"))


@query("event_starts", "W15", f"WITH {ES} SELECT * FROM es")
def _(i):
    return I.event_sessions(i.intervals)


@query("event_starts_three_links", "W15", """WITH m AS (SELECT *, sum(new) OVER (PARTITION BY site_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS isl FROM (SELECT *, CASE WHEN coalesce(max(ts_updated) OVER (PARTITION BY site_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) >= ts - INTERVAL 30 MINUTE, false) THEN 0 ELSE 1 END AS new FROM {intervals})),
k AS (SELECT *, row_number() OVER (PARTITION BY site_id, isl ORDER BY ts DESC, event_id DESC) AS rn FROM m) SELECT site_id, min(ts) AS event_start, max(ts_updated) AS event_end, count(*) AS links FROM k WHERE rn <= 4 GROUP BY site_id, isl""")
def _(i):
    return I.event_sessions(i.intervals, max_links=3)


@query("rain_write_gate", "P10,F15", f"""WITH {PL}, {ES}, cur AS (SELECT site_id, max(event_start) AS event_start FROM es WHERE event_start <= {PUB_AT} GROUP BY site_id),
tr AS (SELECT o.site_id, max(ts_updated) AS u, max(CASE WHEN alert_level = 3 THEN 1 ELSE 0 END) AS l3 FROM {{intervals}} o JOIN cur USING (site_id) WHERE alert_level > 0 AND ts_updated >= event_start AND ts_updated <= {PUB_AT} GROUP BY o.site_id),
v AS (SELECT site_id, time_bucket(INTERVAL 4 HOUR, u) + INTERVAL 4 HOUR + INTERVAL 1 DAY * (1 + l3) AS validity FROM tr)
SELECT site_id, validity, {PUB_AT} + INTERVAL 30 MINUTE >= validity AS write FROM v JOIN pl USING (site_id) WHERE alert_level > 0""")
def _(i):
    t = at("1997-06-01 00:20:00")
    pl = I.public_level(i.public_alerts, t)
    st = I.event_sessions(i.intervals).filter(F.col("event_start") <= t).groupBy("site_id").agg(F.max("event_start").alias("event_start"))
    return RF.rain_write_gate(pl, st, i.intervals, t)


WATCHED = "(SELECT trigger_id AS event_id, trigger_id AS public_id, site_id, ts, ts_updated, alert_level FROM {triggers})"
GATE = f"""wt AS {WATCHED}, gp AS (SELECT site_id, arg_max(alert_level, (ts, public_id)) AS alert_level FROM wt WHERE ts <= {E} AND ts_updated >= {E} - INTERVAL 30 MINUTE GROUP BY site_id),
gs AS (SELECT site_id, min(ts) AS event_start FROM (SELECT *, sum(new) OVER (PARTITION BY site_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS isl FROM (SELECT *, CASE WHEN coalesce(max(ts_updated) OVER (PARTITION BY site_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) >= ts - INTERVAL 30 MINUTE, false) THEN 0 ELSE 1 END AS new FROM wt)) GROUP BY site_id, isl),
gc AS (SELECT site_id, max(event_start) AS event_start FROM gs WHERE event_start <= {E} GROUP BY site_id),
gt AS (SELECT wt.site_id, max(ts_updated) AS u, max(CASE WHEN alert_level = 3 THEN 1 ELSE 0 END) AS l3 FROM wt JOIN gc USING (site_id) WHERE alert_level > 0 AND ts_updated >= event_start AND ts_updated <= {E} GROUP BY wt.site_id),
gate AS (SELECT gt.site_id, {E} + INTERVAL 30 MINUTE >= time_bucket(INTERVAL 4 HOUR, u) + INTERVAL 4 HOUR + INTERVAL 1 DAY * (1 + l3) AS write FROM gt JOIN gp USING (site_id) WHERE gp.alert_level > 0)"""


@query("stored_rain_codes", "P9,P10", f"""WITH {RAINAL}, {GATE} SELECT site_id, rain_id, alert_level, 'a' AS rain_alert, one_day AS cumulative, half_max AS threshold FROM rl WHERE alert_level = 1 AND one_day >= half_max
UNION ALL SELECT site_id, rain_id, alert_level, 'b', three_day, full_max FROM rl WHERE alert_level = 1 AND three_day >= full_max
UNION ALL SELECT site_id, rain_id, alert_level, 'x', CASE WHEN one_day >= half_max * 0.75 THEN one_day ELSE three_day END, CASE WHEN one_day >= half_max * 0.75 THEN half_max ELSE full_max END FROM rl JOIN gate USING (site_id) WHERE write AND alert_level = 0 AND (one_day >= half_max * 0.75 OR three_day >= full_max * 0.75)""")
def _(i):
    t = at(END)
    w = i.triggers.select(F.col("trigger_id").alias("event_id"), F.col("trigger_id").alias("public_id"), "site_id", "ts", "ts_updated", "alert_level")
    started = I.event_sessions(w).filter(F.col("event_start") <= t).groupBy("site_id").agg(F.max("event_start").alias("event_start"))
    return RF.stored_codes(_rain_alerts(i), RF.rain_write_gate(I.public_level(w, t), started, w, t))


@query("rain_windows", "F18", "SELECT event_id, time_bucket(INTERVAL 30 MINUTE, ts) AS end_ts, time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 10 DAY AS start_ts, time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 13 DAY AS offset_ts FROM {events}")
def _(i):
    return rain_grid(i.events.select("event_id", F.col("ts").alias("end_ts")))


@query("gaussian_smooth", "W23", f"""WITH n AS (SELECT marker_id, measurement AS m, row_number() OVER (PARTITION BY marker_id ORDER BY ts, data_id) AS i, count(*) OVER (PARTITION BY marker_id) AS c FROM {{markers}}),
o AS (SELECT n.marker_id, n.i, n.c, k.o, exp(-(k.o * k.o) / 18.0) AS w, ((n.i + k.o - 1) % (2 * c) + 2 * c) % (2 * c) AS q FROM n CROSS JOIN range(-19, 20) AS k(o)),
r AS (SELECT marker_id, i, o, w, CASE WHEN q < c THEN q + 1 ELSE 2 * c - q END AS src FROM o),
m1 AS (SELECT r.marker_id, r.i, sum(w * n.m) / sum(w) AS mean FROM r JOIN n ON n.marker_id = r.marker_id AND n.i = r.src GROUP BY ALL),
sq AS (SELECT n.marker_id, n.i, (n.m - mean) * (n.m - mean) AS s FROM n JOIN m1 ON n.marker_id = m1.marker_id AND n.i = m1.i),
m2 AS (SELECT r.marker_id, r.i, sum(w * s) / sum(w) AS variance FROM r JOIN sq ON sq.marker_id = r.marker_id AND sq.i = r.src GROUP BY ALL)
SELECT marker_id, m1.i AS idx, {R('mean', 6)} AS mean, {R('variance', 6)} AS variance FROM m1 JOIN m2 USING (marker_id, i)""")
def _(i):
    d = scan(i.markers, ["marker_id"], ["ts", "data_id"], {"idx": row_index()})
    g = S.gaussian_smooth(d.select("marker_id", "idx", "measurement"), ["marker_id"], "idx", "measurement")
    return g.select("marker_id", "idx", clean_round("mean", 6).alias("mean"), clean_round("variance", 6).alias("variance"))


# --- times ------------------------------------------------------------------


@query("release_times", "F15", "SELECT event_id, time_bucket(INTERVAL 4 HOUR, ts) + INTERVAL 4 HOUR AS release_ts FROM {events}")
def _(i):
    return i.events.select("event_id", T.release_time("ts").alias("release_ts"))


@query("half_hours", "F16", "SELECT event_id, time_bucket(INTERVAL 30 MINUTE, ts) AS slot FROM {events}")
def _(i):
    return i.events.select("event_id", T.half_hour("ts").alias("slot"))


@query("shifts", "F17", """SELECT event_id, s AS shift_ts, s + INTERVAL 12 HOUR AS next_shift, date_trunc('quarter', ts) AS quarter_start, date_trunc('quarter', ts) + INTERVAL 3 MONTH AS quarter_end, date_trunc('day', ts) + CASE WHEN event_id % 2 = 0 THEN INTERVAL 8 HOUR ELSE INTERVAL 20 HOUR END AS roster_ts FROM (SELECT *, time_bucket(INTERVAL 12 HOUR, ts - INTERVAL 8 HOUR) + INTERVAL 8 HOUR AS s FROM {events})""")
def _(i):
    half = F.when(F.col("event_id") % 2 == 0, "am").otherwise("PM")
    return i.events.select(
        "event_id", T.shift_of("ts").alias("shift_ts"), T.next_shift("ts").alias("next_shift"), T.quarter_start("ts").alias("quarter_start"),
        T.quarter_end("ts").alias("quarter_end"), T.roster_shift(F.to_date("ts"), half).alias("roster_ts"),
    )


# --- quakes -----------------------------------------------------------------

CRIT = "29.027 * magnitude * magnitude - 251.89 * magnitude + 547.97"
QPAIR = f"qp AS (SELECT *, {HAV} AS d, {CRIT.replace('29.027', '29.027::DOUBLE').replace('251.89', '251.89::DOUBLE').replace('547.97', '547.97::DOUBLE')} AS crit FROM (SELECT q.eq_id, q.ts, q.magnitude, q.depth, s.site_id, {hav('q.latitude', 'q.longitude', 's.latitude', 's.longitude')} AS h FROM {{quakes}} q CROSS JOIN {{sites}} s))"


@query("quake_alerts", "J7,F19,F20", f"WITH {QPAIR} SELECT eq_id, ts, site_id, magnitude, {R('crit', 6)} AS critical_distance, {R('d', 3)} AS distance FROM qp WHERE magnitude >= 4 AND d <= crit")
def _(i):
    return Q.quake_alerts(i.quakes, i.sites).withColumns({"critical_distance": clean_round("critical_distance", 6), "distance": clean_round("distance", 3)})


@query("quakes_processed", "J7", "SELECT eq_id, CASE WHEN isfinite(magnitude::DOUBLE) AND isfinite(latitude::DOUBLE) AND isfinite(longitude::DOUBLE) THEN 1 ELSE -1 END AS processed FROM {quakes}")
def _(i):
    return Q.mark_processed(i.quakes)


@query("quake_triggers", "P14", f"WITH {QPAIR} SELECT DISTINCT site_id, ts, ts AS ts_updated, 'earthquake' AS trigger_source, 1 AS alert_level FROM qp WHERE magnitude >= 4 AND d <= crit")
def _(i):
    return Q.quake_triggers(Q.quake_alerts(i.quakes, i.sites))


@query("quake_site_distance", "J8,F19", f"WITH {QPAIR} SELECT DISTINCT ts, site_id, magnitude, depth, {R('d', 3)} AS distance, {R('sqrt(round(d, 3) * round(d, 3) + depth * depth)', 3)} AS hypocentral FROM qp")
def _(i):
    return Q.quake_site_distance(i.quakes, i.sites)


@query("geo_expressions", "F19,F20", f"""SELECT s_suppkey AS id, {R('6371.01 * acos(greatest(-1.0, least(1.0, sin(radians(latitude)) * sin(radians(12.5)) + cos(radians(latitude)) * cos(radians(12.5)) * cos(radians(longitude - 121.0)))))', 4)} AS cosines_km, {R('s_acctbal / 111.0', 6)} AS degrees FROM {{supplier}} JOIN {{gauges}} ON s_suppkey = rain_id""")
def _(i):
    d = i.supplier.join(i.gauges, F.col("s_suppkey") == F.col("rain_id"))
    return d.select(F.col("s_suppkey").alias("id"), clean_round(G.law_of_cosines("latitude", "longitude", F.lit(12.5), F.lit(121.0)), 4).alias("cosines_km"), clean_round(G.km_to_degrees("s_acctbal"), 6).alias("degrees"))


MOVES = "(SELECT event_id, CAST(user_id % 50 AS BIGINT) AS site_id, ts FROM {events} WHERE event_type = 'purchase')"
EQS = "(SELECT event_id AS eq_id, CAST(user_id % 50 AS BIGINT) AS site_id, ts FROM {events} WHERE event_type = 'error')"


def _moves(i):
    return i.events.filter("event_type = 'purchase'").select("event_id", (F.col("user_id") % 50).alias("site_id"), "ts")


@query("movement_after_quake", "J9", f"""SELECT q.eq_id, q.site_id, q.ts, min(m.ts) AS movement_ts FROM {EQS} q LEFT JOIN {MOVES} m ON q.site_id = m.site_id AND m.ts >= q.ts AND m.ts <= q.ts + INTERVAL 3 DAY GROUP BY ALL""")
def _(i):
    q = i.events.filter("event_type = 'error'").select(F.col("event_id").alias("eq_id"), (F.col("user_id") % 50).alias("site_id"), "ts")
    return I.movement_after(q, _moves(i), 3)


@query("rain_confounded", "J10", f"""SELECT event_id, site_id, ts FROM {MOVES} m WHERE EXISTS (SELECT 1 FROM {{events}} r WHERE r.event_type = 'view' AND r.value > 80 AND r.user_id % 50 = m.site_id AND r.ts <= m.ts AND r.ts >= m.ts - INTERVAL 3 DAY)""")
def _(i):
    r = i.events.filter("event_type = 'view' AND value > 80").select((F.col("user_id") % 50).alias("site_id"), "ts")
    return I.rain_confounded(_moves(i), r)


# --- intervals --------------------------------------------------------------

MERGE = """SELECT {k}, min(ts) AS ts, max(ts) AS ts_updated, max({l}) AS {l} FROM (SELECT *, sum(new) OVER (PARTITION BY {k} ORDER BY ts ROWS UNBOUNDED PRECEDING) AS isl FROM (SELECT *, CASE WHEN lag({l}) OVER w = {l} AND lag(ts) OVER w >= ts - INTERVAL {g} MINUTE THEN 0 ELSE 1 END AS new FROM ({src}) WINDOW w AS (PARTITION BY {k} ORDER BY ts))) GROUP BY {k}, isl"""


def merge_sql(src, k, level, gap):
    return MERGE.replace("{src}", src).replace("{k}", k).replace("{l}", level).replace("{g}", str(gap))


@query("merge_alert_intervals", "W13", merge_sql("SELECT site_id, ts, first(alert_level ORDER BY event_id) AS alert_level FROM {evals} GROUP BY site_id, ts", "site_id", "alert_level", 90))
def _(i):
    return I.merge_alerts(i.evals, ["site_id"], "alert_level", ["event_id"])


@query("merge_by_source", "W13", merge_sql("SELECT site_id, trigger_source, ts, first(alert_level ORDER BY event_id) AS alert_level FROM {evals} GROUP BY site_id, trigger_source, ts", "site_id, trigger_source", "alert_level", 90))
def _(i):
    return I.merge_alerts(i.evals, ["site_id", "trigger_source"], "alert_level", ["event_id"])


@query("override_levels", "W14", """WITH u AS (SELECT trigger_id, site_id, trigger_source, ts, ts_updated, 3 AS alert_level FROM {triggers} WHERE trigger_id % 5 = 0 UNION ALL SELECT trigger_id + 10000000, site_id, trigger_source, ts + INTERVAL 7 SECOND, ts_updated, 1 FROM {triggers} WHERE trigger_id % 11 = 0)
SELECT coalesce(t.trigger_id, u.trigger_id) AS trigger_id, coalesce(t.site_id, u.site_id) AS site_id, coalesce(t.trigger_source, u.trigger_source) AS trigger_source, coalesce(t.ts, u.ts) AS ts, coalesce(t.ts_updated, u.ts_updated) AS ts_updated, coalesce(u.alert_level, t.alert_level) AS alert_level FROM {triggers} t FULL JOIN u ON t.site_id = u.site_id AND t.ts = u.ts AND t.trigger_source = u.trigger_source""")
def _(i):
    t = i.triggers.select("trigger_id", "site_id", "trigger_source", "ts", "ts_updated", "alert_level")
    u = t.filter("trigger_id % 5 = 0").withColumn("alert_level", F.lit(3))
    n = t.filter("trigger_id % 11 = 0").withColumns({"trigger_id": F.col("trigger_id") + 10000000, "ts": F.col("ts") + span(secs=7), "alert_level": F.lit(1)})
    return I.override_symbol(t, u.unionByName(n), ["site_id", "ts", "trigger_source"], "alert_level")


@query("overlapping_events", "J13", f"SELECT event_id, site_id, ts, ts_updated FROM {{intervals}} WHERE ts <= TIMESTAMP '1997-06-05 00:00:00' AND ts_updated >= TIMESTAMP '1997-06-01 00:00:00'")
def _(i):
    return I.overlapping(i.intervals, at("1997-06-01 00:00:00"), at("1997-06-05 00:00:00")).select("event_id", "site_id", "ts", "ts_updated")


@query("event_context", "J14,A12", """SELECT r.event_id, count(e.trigger_id) FILTER (e.trigger_id IS NOT NULL) AS events, string_agg(DISTINCT e.trigger_source, ',' ORDER BY e.trigger_source) AS sources, min(e.trigger_id) AS first_trigger FROM (SELECT event_id, user_id % 50 AS site_id, ts FROM {events}) r LEFT JOIN (SELECT trigger_id, trigger_source, site_id, ts - INTERVAL 1 DAY AS a, ts_updated + INTERVAL 2 HOUR AS b FROM {triggers} WHERE alert_level = 3) e ON r.site_id = e.site_id AND e.a <= r.ts AND e.b > r.ts GROUP BY r.event_id""")
def _(i):
    r = i.events.select("event_id", (F.col("user_id") % 50).cast("int").alias("site_id"), "ts")
    e = i.triggers.filter("alert_level = 3").withColumn("validity", F.col("ts_updated") + span(hours=2))
    return I.event_context(r, e, ["site_id"], "event_id").select("event_id", F.coalesce("events", F.lit(0)).alias("events"), "sources", "first_trigger")


@query("on_duty", "J11", """SELECT release_id, (SELECT arg_max(mt, r.ts) FROM {roster} r WHERE r.ts < s.data_ts) AS mt, (SELECT max(r.ts) FROM {roster} r WHERE r.ts < s.data_ts) AS state_ts FROM {schedule} s""")
def _(i):
    e = i.schedule.select("release_id", F.col("data_ts").alias("ts"))
    return I.as_of(e, i.roster, [], ["mt", "ct"], ["release_id"], size=30 * 86_400_000_000).select("release_id", "mt", "state_ts")


@query("without_downtime", "J15", """SELECT release_id, site_id, data_ts FROM {schedule} s WHERE NOT EXISTS (SELECT 1 FROM {downtime} d WHERE s.data_ts - INTERVAL 150 MINUTE BETWEEN d.start_ts AND d.end_ts)""")
def _(i):
    return I.remove_downtime(i.schedule, i.downtime, shift=span(mins=-150)).select("release_id", "site_id", "data_ts")


# --- markers ----------------------------------------------------------------

HISTS = """h AS (SELECT a.data_id AS at_id, a.site_id, a.marker_id, a.ts AS at_ts, b.data_id, b.ts, b.measurement AS m, a.rn - b.rn AS back, count(*) OVER (PARTITION BY a.data_id) AS n, min(b.ts) OVER (PARTITION BY a.data_id) AS t0 FROM mk a JOIN mk b ON a.site_id = b.site_id AND a.marker_id = b.marker_id AND b.rn BETWEEN a.rn - 9 AND a.rn),
p AS (SELECT at_id, site_id, marker_id, max(at_ts) AS at_ts, max(n) AS n, max(ts) FILTER (back = 0) AS l_ts, max(ts) FILTER (back = 1) AS p_ts, max(m) FILTER (back = 0) AS l_m, max(m) FILTER (back = 1) AS p_m,
 count(*)::DOUBLE AS s0, sum(t) AS t1, sum(t*t) AS t2, sum(t*t*t) AS t3, sum(t*t*t*t) AS t4, sum(m) AS m0, sum(t*m) AS m1, sum(t*t*m) AS m2, max(t) AS te FROM (SELECT *, date_diff('microsecond', t0, ts) / 1000000.0 / 86400.0 AS t FROM h) GROUP BY ALL),
d AS (SELECT *, s0*(t2*t4-t3*t3) - t1*(t1*t4-t2*t3) + t2*(t1*t3-t2*t2) AS det, s0*(m1*t4-t3*m2) - m0*(t1*t4-t2*t3) + t2*(t1*m2-m1*t2) AS db, s0*(t2*m2-m1*t3) - t1*(t1*m2-m1*t2) + m0*(t1*t3-t2*t2) AS dc FROM p),
v AS (SELECT *, CASE WHEN det <> 0 THEN db/det END AS b, CASE WHEN det <> 0 THEN dc/det END AS c FROM d),
l AS (SELECT *, CASE WHEN abs(b + c*2*te) > 0 THEN ln(abs(b + c*2*te)) END AS lv, CASE WHEN abs(c*2) > 0 THEN ln(abs(c*2)) END AS la, round(abs(l_m - p_m), 4) AS disp, date_diff('microsecond', p_ts, l_ts) / 1000000.0 / 3600.0 AS hrs FROM v),
w AS (SELECT *, 1.49905955613175::DOUBLE * lv - 3.00263765777028::DOUBLE AS cr, 4.53047399738543::DOUBLE * sqrt(abs(1/30.0 - 2*49.8880017417971::DOUBLE*(1/30.0 + (lv - 2.232839766)*(lv - 2.232839766)/215.515369339559::DOUBLE))) AS wd FROM l),
lev AS (SELECT *, CASE WHEN n < 2 THEN 0 WHEN disp < 1 THEN 0 WHEN hrs > 0 AND disp/hrs < 0.25 THEN 0 WHEN hrs > 0 AND disp/hrs < 1.8 THEN 1 + CASE WHEN n < 10 THEN 1 WHEN la >= cr - wd AND la <= cr + wd AND b*c > 0 THEN 1 ELSE 0 END ELSE 3 END AS lvl FROM w)"""
MK = "mk AS (SELECT *, row_number() OVER (PARTITION BY site_id, marker_id ORDER BY ts, data_id) AS rn FROM {markers})"


@query("marker_levels_recomputed", "P13,P12", f"WITH {MK}, {HISTS} SELECT at_id AS data_id, site_id, marker_id, at_ts AS ts, disp + 0.0 AS displacement, {R('hrs', 4)} AS time_delta, lvl AS alert_level FROM lev")
def _(i):
    return SU.recompute_markers(i.markers)


STALE = f"time_bucket(INTERVAL 4 HOUR, l_ts) < time_bucket(INTERVAL 4 HOUR, {E})"
MA = f"WITH mk AS (SELECT *, row_number() OVER (PARTITION BY site_id, marker_id ORDER BY ts, data_id) AS rn FROM {{markers}} WHERE ts <= {E}), {HISTS}, ma AS (SELECT site_id, marker_id, at_id AS data_id, CASE WHEN NOT ({STALE}) THEN disp + 0.0 END AS displacement, CASE WHEN NOT ({STALE}) THEN {R('hrs', 4)} END AS time_delta, CASE WHEN {STALE} THEN -1 ELSE lvl END AS alert_level FROM lev JOIN (SELECT site_id, marker_id, max(rn) AS rn FROM mk GROUP BY ALL) USING (site_id, marker_id) JOIN mk USING (site_id, marker_id, rn) WHERE at_id = mk.data_id)"


@query("marker_alerts", "P11,P12", f"{MA} SELECT * FROM ma")
def _(i):
    return SU.marker_alerts(i.markers, at(END))


@query("marker_site_levels", "A9", f"{MA} SELECT site_id, max(alert_level) AS alert_level FROM ma GROUP BY site_id")
def _(i):
    return SU.site_level(SU.marker_alerts(i.markers, at(END)))


@query("marker_lookback", "A5", f"""WITH t AS (SELECT site_id, ts, row_number() OVER (PARTITION BY site_id ORDER BY ts DESC) AS rn FROM (SELECT DISTINCT site_id, ts FROM {{markers}})) SELECT site_id, least(min(ts), {E}) AS since FROM t WHERE rn <= 10 GROUP BY site_id""")
def _(i):
    return SU.lookback(i.markers, 10, at(END))


NAMES = "nm AS (SELECT marker_id, arg_max(marker_name, (ts, hist_id)) AS marker_name FROM {marker_history} WHERE event IN ('add', 'rename') GROUP BY marker_id)"


@query("marker_names", "W16", f"WITH {NAMES} SELECT * FROM nm")
def _(i):
    return SU.current_names(i.marker_history)


@query("marker_displacement", "W17", f"""WITH {NAMES}, o AS (SELECT * FROM {{markers}} m WHERE NOT EXISTS (SELECT 1 FROM {{marker_history}} h WHERE h.event = 'mute' AND h.marker_id = m.marker_id AND h.ts = m.ts)),
s AS (SELECT *, round(CASE WHEN EXISTS (SELECT 1 FROM {{marker_history}} h WHERE h.event = 'reposition' AND h.marker_id = o.marker_id AND h.ts = o.ts) THEN 0.0 ELSE coalesce(measurement - lag(measurement) OVER (PARTITION BY marker_id ORDER BY ts, data_id), 0.0) END, 4) + 0.0 AS step FROM o)
SELECT data_id, s.marker_id, marker_name, step, {R('sum(step) OVER (PARTITION BY s.marker_id ORDER BY ts, data_id ROWS UNBOUNDED PRECEDING)', 4)} AS cumulative FROM s LEFT JOIN nm ON s.marker_id = nm.marker_id""")
def _(i):
    return SU.marker_displacement(i.markers, i.marker_history).select("data_id", "marker_id", "marker_name", "step", "cumulative")


@query("reconcile_markers", "M16,J3", """SELECT coalesce(o.site_id, r.site_id) AS site_id, coalesce(o.marker_id, r.marker_id) AS marker_id, CASE WHEN o.marker_id IS NULL THEN 'not reported' WHEN r.marker_id IS NULL THEN 'unknown' ELSE 'ok' END AS status FROM (SELECT DISTINCT site_id, marker_id FROM {markers} WHERE marker_id % 3 <> 0) o FULL JOIN (SELECT DISTINCT CAST(user_id % 50 AS INT) AS site_id, user_id AS marker_id FROM {events} WHERE user_id % 4 <> 0) r ON o.site_id = r.site_id AND o.marker_id = r.marker_id""")
def _(i):
    o = i.markers.filter("marker_id % 3 <> 0").select("site_id", "marker_id").distinct()
    r = i.events.filter("user_id % 4 <> 0").select((F.col("user_id") % 50).cast("int").alias("site_id"), F.col("user_id").alias("marker_id")).distinct()
    return SU.reconcile_markers(o, r)


@query("unpivot_observations", "I12", """SELECT event_id, 'a' AS marker_name, CAST(event_id % 100 AS DOUBLE) AS measurement, 1 AS marker_id FROM {events} UNION ALL SELECT event_id, 'b', value, 2 FROM {events} WHERE event_id % 3 = 0""")
def _(i):
    w = i.events.select("event_id", (F.col("event_id") % 100).cast("double").alias("a"), F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("b"))
    return SU.unpivot_observations(w, ["event_id"], {"a": 1, "b": 2})


# --- alerts -----------------------------------------------------------------

CUR = f"cur AS (SELECT * FROM {{triggers}} WHERE alert_level > 0 AND ts <= {E} AND ts_updated >= {E} - INTERVAL 2 DAY AND trigger_source NOT IN ('moms', 'on demand') QUALIFY row_number() OVER (PARTITION BY site_id, trigger_source, alert_level ORDER BY ts_updated DESC, trigger_id DESC) = 1)"


@query("current_triggers", "P15,J1", f"WITH {CUR} SELECT trigger_id, site_id, trigger_source, alert_level, ts, ts_updated FROM cur")
def _(i):
    return AL.current_triggers(i.triggers, at(END)).select("trigger_id", "site_id", "trigger_source", "alert_level", "ts", "ts_updated")


@query("retrigger_gate", "P16", f"WITH {CUR} SELECT cur.trigger_id, ts_updated AS ts_last_retrigger FROM cur LEFT JOIN (SELECT trigger_id, max(ts_last_retrigger) AS l FROM {{alert_status}} GROUP BY trigger_id) s ON cur.trigger_id = s.trigger_id WHERE l IS NULL OR l + INTERVAL 1 DAY < ts_updated")
def _(i):
    return AL.retrigger(AL.current_triggers(i.triggers, at(END)), i.alert_status)


@query("valid_triggers", "P17,J4", "SELECT trigger_id, site_id, alert_level FROM {triggers} WHERE trigger_id NOT IN (SELECT trigger_id FROM {alert_status} WHERE alert_status = -1)")
def _(i):
    return AL.valid_triggers(i.triggers, i.alert_status).select("trigger_id", "site_id", "alert_level")


@query("triggers_with_status", "J2", "SELECT t.trigger_id, s.ts_last_retrigger, s.alert_status FROM {triggers} t LEFT JOIN {alert_status} s ON t.trigger_id = s.trigger_id")
def _(i):
    return AL.with_status(i.triggers, i.alert_status).select("trigger_id", "ts_last_retrigger", "alert_status")


@query("status_with_triggers", "J2", "SELECT s.trigger_id, t.trigger_source FROM (SELECT * FROM {triggers} WHERE alert_level > 0) t RIGHT JOIN {alert_status} s ON t.trigger_id = s.trigger_id")
def _(i):
    return i.triggers.filter("alert_level > 0").select("trigger_id", "trigger_source").join(i.alert_status.select("trigger_id"), "trigger_id", "right").select("trigger_id", "trigger_source")


PUBS = "(SELECT trigger_id AS public_id, site_id, time_bucket(INTERVAL 30 MINUTE, ts_updated) AS ts, alert_level FROM {triggers} WHERE trigger_source = 'surficial')"


@query("validation_additions", "P18", "SELECT t.site_id, ts_updated AS ts, ts_updated, 'surficial' AS trigger_source, 2 AS alert_level FROM {triggers} t JOIN {alert_status} s ON t.trigger_id = s.trigger_id WHERE trigger_source = 'surficial' AND alert_level = 1 AND alert_status = 1")
def _(i):
    return AL.apply_validation(i.triggers, i.alert_status, i.public_alerts)[0]


@query("validation_deletions", "P18", f"""SELECT p.public_id, p.site_id, p.ts, p.alert_level FROM {PUBS} p WHERE EXISTS (SELECT 1 FROM {{triggers}} t JOIN {{alert_status}} s ON t.trigger_id = s.trigger_id WHERE trigger_source = 'surficial' AND t.alert_level >= 2 AND alert_status = -1 AND t.site_id = p.site_id AND time_bucket(INTERVAL 30 MINUTE, t.ts_updated) = p.ts
 AND NOT EXISTS (SELECT 1 FROM {{triggers}} c WHERE c.site_id = t.site_id AND time_bucket(INTERVAL 30 MINUTE, c.ts) = p.ts AND c.alert_level >= t.alert_level AND c.trigger_id NOT IN (SELECT trigger_id FROM {{alert_status}} WHERE alert_status = -1)))""")
def _(i):
    p = i.triggers.filter("trigger_source = 'surficial'").select(F.col("trigger_id").alias("public_id"), "site_id", T.half_hour("ts_updated").alias("ts"), "alert_level")
    return AL.apply_validation(i.triggers, i.alert_status, p)[1].select("public_id", "site_id", "ts", "alert_level")


@query("trigger_sources_text", "A12", "SELECT site_id, string_agg(DISTINCT trigger_source, ',' ORDER BY trigger_source) AS sources FROM {triggers} WHERE alert_level > 0 GROUP BY site_id")
def _(i):
    return AL.sources_text(i.triggers.filter("alert_level > 0"), ["site_id"], "trigger_source")


DUE = f"""{CUR}, due AS (SELECT trigger_id, site_id, trigger_source, alert_level, ts - INTERVAL 1 DAY AS event_start, ts_updated AS last FROM cur WHERE trigger_id NOT IN (SELECT trigger_id FROM {{alert_status}} WHERE alert_status <> 0))"""
HITROWS = "(SELECT CAST(user_id % 50 AS INT) AS site_id, ts, 'g' || CAST(user_id % 7 AS VARCHAR) AS g, 's' || CAST(user_id % 3 AS VARCHAR) AS s, CAST(event_id % 9 AS INT) AS node_id FROM {events})"


@query("alert_messages", "P20", f"""WITH {DUE}, gt AS (SELECT due.trigger_id, string_agg(DISTINCT g, ',' ORDER BY g) AS t FROM due JOIN {HITROWS} h ON h.site_id = due.site_id AND h.ts BETWEEN event_start AND last WHERE trigger_source IN ('rainfall', 'surficial') GROUP BY 1),
st AS (SELECT trigger_id, string_agg(s || '(' || n || ')', ',' ORDER BY s) AS t FROM (SELECT trigger_id, s, string_agg(CAST(node_id AS VARCHAR), ',' ORDER BY node_id) AS n FROM (SELECT DISTINCT due.trigger_id, s, node_id FROM due JOIN {HITROWS} h ON h.site_id = due.site_id AND h.ts BETWEEN last - INTERVAL 4 HOUR AND last WHERE trigger_source = 'subsurface') GROUP BY ALL) GROUP BY 1)
SELECT due.trigger_id, site_id, 'ALERT ' || due.trigger_id || ' site ' || site_id || ' ' || trigger_source || ' level ' || alert_level || coalesce(':' || coalesce(gt.t, st.t), '') AS message FROM due LEFT JOIN gt ON due.trigger_id = gt.trigger_id LEFT JOIN st ON due.trigger_id = st.trigger_id""")
def _(i):
    cur = AL.due_alerts(AL.current_triggers(i.triggers, at(END)), i.alert_status)
    due = cur.select("trigger_id", "site_id", "trigger_source", "alert_level", (F.col("ts") - span(days=1)).alias("event_start"), F.col("ts_updated").alias("ts_last_retrigger"))
    h = i.events.select(
        (F.col("user_id") % 50).cast("int").alias("site_id"), "ts", F.concat(F.lit("g"), (F.col("user_id") % 7).cast("string")).alias("name"),
        F.concat(F.lit("s"), (F.col("user_id") % 3).cast("string")).alias("sensor"), (F.col("event_id") % 9).cast("int").alias("node_id"),
    )
    return AL.alert_messages(due, h, h, h)


# --- keys and counts --------------------------------------------------------


@query("latest_readings", "A1", "SELECT event_id, tsm_id, node_id, ts FROM {readings} QUALIFY rank() OVER (PARTITION BY tsm_id, node_id ORDER BY ts DESC) = 1")
def _(i):
    return A.latest_rows(i.readings, NODE).select("event_id", *NODE, "ts")


@query("dedupe_first", "A2", "SELECT event_id, site_id, alert_level, ts FROM {evals} QUALIFY row_number() OVER (PARTITION BY site_id, alert_level ORDER BY ts, event_id) = 1")
def _(i):
    return A.dedupe(i.evals, ["site_id", "alert_level"], [F.col("ts"), F.col("event_id")]).select("event_id", "site_id", "alert_level", "ts")


@query("drop_repeated_keys", "A3", "SELECT release_id, site_id, data_ts FROM {schedule} QUALIFY count(*) OVER (PARTITION BY site_id, date_trunc('year', data_ts)) = 1")
def _(i):
    d = i.schedule.withColumn("y", F.year("data_ts"))
    return A.drop_all_duplicated(d, ["site_id", "y"]).select("release_id", "site_id", "data_ts")


@query("top_per_group", "A4", "SELECT site_id, event_id, ts FROM {evals} QUALIFY row_number() OVER (PARTITION BY site_id ORDER BY ts DESC, event_id DESC) <= 4")
def _(i):
    return A.top_n(i.evals, ["site_id"], [F.col("ts").desc(), F.col("event_id").desc()], 4).select("site_id", "event_id", "ts")


@query("latest_global", "A4", "SELECT event_id, ts FROM {evals} ORDER BY ts DESC, event_id DESC LIMIT 25")
def _(i):
    return A.top_n(i.evals, [], [F.col("ts").desc(), F.col("event_id").desc()], 25).select("event_id", "ts")


@query("percent_valid", "A10", f"SELECT tsm_id, node_id, {R('count(*) FILTER (x > 900) * 100.0::DOUBLE / count(*)', 2)} AS percent FROM {{readings}} GROUP BY ALL")
def _(i):
    return A.percent_valid(i.readings, NODE, F.col("x") > 900)


@query("retained_share", "A11", f"""WITH {FIX.replace('{src}', '{readings}')}, a AS (SELECT tsm_id, node_id, count(*) AS raw FROM {{readings}} WHERE ts > {E} - INTERVAL 3 DAY AND ts <= {E} GROUP BY ALL), b AS (SELECT tsm_id, node_id, count(*) AS kept FROM ort WHERE ts > {E} - INTERVAL 3 DAY AND ts <= {E} GROUP BY ALL)
SELECT tsm_id, node_id, raw, coalesce(kept, 0) AS kept, {R('coalesce(kept, 0) * 100.0::DOUBLE / raw', 2)} AS percent FROM a LEFT JOIN b USING (tsm_id, node_id)""")
def _(i):
    return A.retention(i.readings, C.orthogonal_filter(C.range_filter(i.readings)), NODE, at(END))


@query("period_statistics", "A13", """SELECT CASE WHEN grouping(m) = 0 THEN 'month' WHEN grouping(q) = 0 THEN 'quarter' ELSE 'year' END AS period, CAST(y AS INT) AS year, CAST(q AS INT) AS quarter, CAST(m AS INT) AS month, count(*) AS releases, CAST(sum(event) AS BIGINT) AS events FROM (SELECT *, year(data_ts) AS y, quarter(data_ts) AS q, month(data_ts) AS m FROM {schedule}) GROUP BY GROUPING SETS ((y, m), (y, q), (y))""")
def _(i):
    return A.period_stats(i.schedule, "data_ts", {"releases": "count(*)", "events": "sum(event)"})


@query("response_profile", "A14", """SELECT site_id, hour, weekday, count(*) AS n FROM (SELECT site_id, CAST(hour(ts) AS INT) AS hour, CASE isodow(ts) WHEN 1 THEN 'M' WHEN 2 THEN 'T' WHEN 3 THEN 'W' WHEN 4 THEN 'Th' WHEN 5 THEN 'F' WHEN 6 THEN 'Sa' ELSE 'Su' END AS weekday FROM {triggers}) GROUP BY GROUPING SETS ((site_id, hour), (site_id, weekday))""")
def _(i):
    return A.response_profile(i.triggers)


@query("measurement_compliance", "A15", """WITH s AS (SELECT event_id AS release_id, CAST(user_id % 50 AS INT) AS site_id, ts AS data_ts, CAST(event_id % 2 AS INT) AS event FROM {events} WHERE event_type = 'error'),
r AS (SELECT s.*, EXISTS (SELECT 1 FROM {markers} m WHERE m.site_id = s.site_id AND m.ts >= s.data_ts + INTERVAL 30 MINUTE - CASE WHEN event <> 1 THEN INTERVAL 8 HOUR ELSE INTERVAL 4 HOUR END AND m.ts < s.data_ts + INTERVAL 30 MINUTE) AS got FROM s)
SELECT site_id, CAST(year(data_ts) AS INT) AS year, CAST(month(data_ts) AS INT) AS month, count(*) AS expected, count(*) FILTER (got) AS received FROM r GROUP BY ALL""")
def _(i):
    s = i.events.filter("event_type = 'error'").select(F.col("event_id").alias("release_id"), (F.col("user_id") % 50).cast("int").alias("site_id"), F.col("ts").alias("data_ts"), (F.col("event_id") % 2).cast("int").alias("event"))
    return A.measurement_compliance(s, i.markers)


@query("trigger_validity", "A16", """WITH o AS (SELECT trigger_id, arg_min(alert_status, ts_last_retrigger) AS st, min(ts_last_retrigger) AS t FROM {alert_status} GROUP BY trigger_id) SELECT CAST(year(t + INTERVAL 1 MONTH) AS INT) AS year, trigger_source, count(*) AS total, count(*) FILTER (st <> -1) AS valid FROM o JOIN {triggers} tr ON o.trigger_id = tr.trigger_id GROUP BY ALL""")
def _(i):
    return A.trigger_validity(i.triggers, i.alert_status)


@query("probability_grid", "A17", f"""WITH b AS (SELECT CASE WHEN magnitude = 7.5 THEN 8 ELSE CAST(floor((magnitude - 3.0::DOUBLE) / 0.5::DOUBLE) AS INT) END AS xbin, CASE WHEN depth = 120 THEN 5 ELSE CAST(floor(depth / 20.0::DOUBLE) AS INT) END AS ybin, eq_id FROM {{quakes}})
SELECT xbin, ybin, count(*) FILTER (eq_id % 3 = 0) AS hits, count(*) AS total, nullif({R('count(*) FILTER (eq_id % 3 = 0)::DOUBLE / count(*)', 6)}, 0) AS probability FROM b WHERE xbin BETWEEN 0 AND 8 AND ybin BETWEEN 0 AND 5 GROUP BY ALL""")
def _(i):
    return A.prob_grid(i.quakes, "magnitude", "depth", F.col("eq_id") % 3 == 0, 3.0, 0.5, 9, 0.0, 20.0, 6)


@query("value_histogram", "A18", "SELECT CAST(CASE WHEN value = 200 THEN 4 WHEN value >= 100 THEN 4 WHEN value >= 50 THEN 3 WHEN value >= 10 THEN 2 ELSE 1 END AS INT) AS bin, count(*) AS n FROM {events} WHERE value >= 0 AND value <= 200 GROUP BY ALL")
def _(i):
    return A.histogram(i.events, "value", [0, 10, 50, 100, 200])


@query("even_histogram", "A18", "SELECT CAST(CASE WHEN value = 100 THEN 10 ELSE floor(value / 10) + 1 END AS INT) AS bin, count(*) AS n FROM {events} WHERE value >= 0 AND value <= 100 GROUP BY ALL")
def _(i):
    return A.histogram(i.events, "value", [10 * k for k in range(11)])


CONF = """count(*) FILTER (p AND a) AS tp, count(*) FILTER (p AND NOT a) AS fp, count(*) FILTER (NOT p AND a) AS fn, count(*) FILTER (NOT p AND NOT a) AS tn"""
RATES = ", ".join(f"{R(e, 6)} AS {n}" for n, e in {
    "tpr": "tp::DOUBLE / nullif(tp + fn, 0)", "fpr": "fp::DOUBLE / nullif(fp + tn, 0)", "specificity": "tn::DOUBLE / nullif(fp + tn, 0)",
    "mcc": "(tp::DOUBLE * tn - fp::DOUBLE * fn) / nullif(sqrt((tp + fp)::DOUBLE * (tp + fn) * (tn + fp) * (tn + fn)), 0)",
    "f1": "2 * tp::DOUBLE / nullif(2 * tp + fp + fn, 0)", "accuracy": "(tp + tn)::DOUBLE / nullif(tp + tn + fp + fn, 0)",
    "corner_distance": "sqrt((1 - tp::DOUBLE / nullif(tp + fn, 0)) * (1 - tp::DOUBLE / nullif(tp + fn, 0)) + (fp::DOUBLE / nullif(fp + tn, 0)) * (fp::DOUBLE / nullif(fp + tn, 0)))",
}.items())


@query("confusion_matrix", "A19", f"WITH c AS (SELECT {CONF} FROM (SELECT score >= 1000 AS p, label = 1 AS a FROM {{scores}})) SELECT tp, fp, fn, tn, {RATES} FROM c")
def _(i):
    return A.confusion(i.scores, F.col("score") >= 1000, F.col("label") == 1)


@query("confusion_by_site", "A19", f"WITH c AS (SELECT site_id, {CONF} FROM (SELECT site_id, alert_level >= 2 AS p, event_id % 3 = 0 AS a FROM {{evals}}) GROUP BY site_id) SELECT site_id, tp, fp, fn, tn, {RATES} FROM c")
def _(i):
    return A.confusion(i.evals, F.col("alert_level") >= 2, F.col("event_id") % 3 == 0, ["site_id"])


ROC = f"""roc AS (SELECT score AS threshold, CAST(sum(p) OVER w AS BIGINT) AS tp, CAST(sum(n) OVER w AS BIGINT) AS fp, {R('sum(p) OVER w / (sum(p) OVER ())::DOUBLE', 6)} AS tpr, {R('sum(n) OVER w / (sum(n) OVER ())::DOUBLE', 6)} AS fpr FROM (SELECT score, sum(label) AS p, sum(1 - label) AS n FROM {{scores}} GROUP BY score) WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""


@query("roc_curve", "A20", f"WITH {ROC} SELECT * FROM roc")
def _(i):
    return A.roc(i.scores, "score", "label")


@query("youden_threshold", "A20", f"WITH {ROC} SELECT threshold, tpr, fpr, {R('tpr - fpr', 6)} AS j FROM roc ORDER BY {R('tpr - fpr', 6)} DESC, threshold DESC LIMIT 1")
def _(i):
    return A.youden(A.roc(i.scores, "score", "label"))


@query("threshold_sweep", "A21", f"""WITH q AS (SELECT magnitude, depth, CASE WHEN eq_id % 3 = 0 THEN 1 ELSE 0 END AS label FROM {{quakes}}), t AS (SELECT magnitude, sum(label) AS p, sum(1 - label) AS n FROM q GROUP BY magnitude)
SELECT q.magnitude, k.k * 0.5::DOUBLE AS threshold, count(*) FILTER (label = 1 AND depth <= k.k * 0.5) AS tp, count(*) FILTER (label = 0 AND depth <= k.k * 0.5) AS fp, count(*) FILTER (label = 1 AND depth > k.k * 0.5) AS fn, count(*) FILTER (label = 0 AND depth > k.k * 0.5) AS tn,
{R('count(*) FILTER (label = 1 AND depth <= k.k * 0.5)::DOUBLE / nullif(max(p), 0)', 6)} AS tpr, {R('count(*) FILTER (label = 0 AND depth <= k.k * 0.5)::DOUBLE / nullif(max(n), 0)', 6)} AS fpr FROM q JOIN t ON q.magnitude = t.magnitude CROSS JOIN range(1, 201) AS k(k) GROUP BY ALL""")
def _(i):
    d = i.quakes.withColumn("label", F.when(F.col("eq_id") % 3 == 0, 1).otherwise(0))
    return A.sweep(d, "depth", "label", ["magnitude"], 0.5, 100.0)


@query("plane_fit", "A22", f"""WITH p AS (SELECT magnitude::DOUBLE AS x, depth::DOUBLE AS y, log10((1 + eq_id % 97) * 0.01::DOUBLE * 10000.0) AS z FROM {{quakes}}), g AS (SELECT covar_pop(x, x) AS xx, covar_pop(x, y) AS xy, covar_pop(y, y) AS yy, covar_pop(x, z) AS xz, covar_pop(y, z) AS yz, avg(x) AS mx, avg(y) AS my, avg(z) AS mz FROM p), ab AS (SELECT *, (xz * yy - yz * xy) / (xx * yy - xy * xy) AS a, (yz * xx - xz * xy) / (xx * yy - xy * xy) AS b FROM g)
SELECT {R('a', 6)} AS a, {R('b', 6)} AS b, {R('mz - a * mx - b * my', 6)} AS c FROM ab""")
def _(i):
    z = F.log10((1 + F.col("eq_id") % 97) * F.lit(0.01) * 10000.0)
    return A.fit_plane(i.quakes, "magnitude", "depth", z)


@query("site_activity", "A24", """WITH l AS (SELECT site_id, CAST(floor(trigger_id / 7) AS BIGINT) AS event_id, replace(replace(CASE trigger_source WHEN 'subsurface' THEN CASE WHEN alert_level = 3 THEN 'S' ELSE 's' END WHEN 'surficial' THEN CASE WHEN alert_level = 3 THEN 'G' ELSE 'g' END WHEN 'on demand' THEN CASE WHEN alert_level = 3 THEN 'M' ELSE 'm' END WHEN 'rainfall' THEN 'R' ELSE 'E' END, 'M', 'G'), 'm', 'g') AS t FROM {triggers} WHERE alert_level > 0),
e AS (SELECT site_id, event_id, max(CAST(t = 'S' AS INT)) AS S3, max(CAST(t = 'G' AS INT)) AS G3, max(CAST(t = 's' AS INT)) AS s2, max(CAST(t = 'g' AS INT)) AS g2, max(CAST(t = 'R' AS INT)) AS r, max(CAST(t = 'E' AS INT)) AS q FROM l GROUP BY ALL),
g AS (SELECT site_id, max(greatest(S3, s2)) AS s, max(greatest(G3, g2)) AS gg, max(greatest(S3, G3)) AS l3, count(*) FILTER (S3 + G3 + s2 + g2 > 0) AS n, count(*) FILTER (r = 1) AS rain_event, count(*) FILTER (q = 1) AS eq_event, count(*) FILTER (S3 + G3 = 0 AND s2 + g2 = 1) AS a2_single, count(*) FILTER (S3 + G3 = 0 AND s2 + g2 = 2) AS a2_both, count(*) FILTER (S3 + G3 = 1) AS a3_single, count(*) FILTER (S3 + G3 = 2) AS a3_both FROM e GROUP BY site_id)
SELECT site_id, s + gg AS corr_event, CASE WHEN l3 = 1 THEN 4 WHEN n > 0 THEN 3 ELSE 0 END AS max_event, CASE WHEN n >= 5 THEN 4 WHEN n >= 3 THEN 3 WHEN n >= 2 THEN 2 WHEN n >= 1 THEN 1 ELSE 0 END AS freq_event, rain_event, eq_event, a2_single, a2_both, a3_single, a3_both, CAST(a2_single + 1.5 * a2_both + 8 * a3_single + 12 * a3_both AS DOUBLE) AS total FROM g""")
def _(i):
    s, l3 = F.col("trigger_source"), F.col("alert_level") == 3
    letter = (
        F.when(s == "subsurface", F.when(l3, "S").otherwise("s")).when(s == "surficial", F.when(l3, "G").otherwise("g"))
        .when(s == "on demand", F.when(l3, "M").otherwise("m")).when(s == "rainfall", "R").otherwise("E")
    )
    d = i.triggers.filter("alert_level > 0").select("site_id", F.floor(F.col("trigger_id") / 7).alias("event_id"), letter.alias("trigger_type"))
    return A.site_activity(d)


@query("union_first_last", "A25", """SELECT user_id, ts, value, NULL AS note FROM {events} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1 UNION ALL (SELECT user_id, ts, value, 'last' FROM {events} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)""")
def _(i):
    one = F.struct("ts", "event_id", "value")
    g = i.events.groupBy("user_id").agg(F.min(one).alias("a"), F.max(one).alias("b"))
    first = g.select("user_id", "a.ts", "a.value")
    last = g.select("user_id", "b.ts", "b.value", F.lit("last").alias("note"))
    return first.unionByName(last, allowMissingColumns=True)


UP = """(SELECT ts, count(*) FILTER (NOT regexp_matches(replace(lower(a), 'a0', ''), 'nd|0')) AS site_count FROM (SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS ts, CASE event_type WHEN 'error' THEN 'nd' WHEN 'view' THEN 'A0' WHEN 'click' THEN 'A1-R0' ELSE 'A2-g' END AS a FROM {events}) GROUP BY ts)"""


@query("uptime", "A26", merge_sql(f"SELECT 1 AS one, ts, site_count FROM {UP}", "one", "site_count", 30))
def _(i):
    e = F.col("event_type")
    a = i.events.select(T.half_hour("ts").alias("ts"), F.when(e == "error", "nd").when(e == "view", "A0").when(e == "click", "A1-R0").otherwise("A2-g").alias("internal_alert"))
    return I.merge_alerts(A.uptime(a).withColumn("one", F.lit(1)), ["one"], "site_count", gap="30 minutes")


@query("data_presence", "A27", """WITH l AS (SELECT rain_id, max(ts) AS last_data FROM {rain} WHERE ts <= TIMESTAMP '2024-01-20 12:00:00' AND (rain_id % 5 <> 0 OR ts < TIMESTAMP '2024-01-12 00:00:00') GROUP BY rain_id), d AS (SELECT s_suppkey AS rain_id, last_data, CAST(floor(date_diff('microsecond', last_data, TIMESTAMP '2024-01-20 12:00:00') / 86400000000.0) AS BIGINT) AS days FROM {supplier} LEFT JOIN l ON s_suppkey = rain_id)
SELECT rain_id, last_data, days, CASE WHEN days <= 3 THEN 1 ELSE 0 END AS presence, CASE WHEN days <= 3 THEN 'Active' ELSE 'For Maintenance' END AS status FROM d""")
def _(i):
    f = i.rain.filter("rain_id % 5 <> 0 OR ts < TIMESTAMP_NTZ'2024-01-12 00:00:00'")
    return A.data_presence(i.supplier.select(F.col("s_suppkey").alias("rain_id")), f, "rain_id", at(END))


LOGR = """(SELECT c_custkey AS logger_id, CASE WHEN c_custkey % 97 = 0 THEN 'bulg' WHEN c_custkey % 89 = 0 THEN 'testa' ELSE substr('abc', 1 + CAST(c_custkey % 2 AS INT), 2) || 'c' || CASE c_custkey % 5 WHEN 0 THEN 'r_' WHEN 1 THEN 'pz' WHEN 2 THEN 'x_' WHEN 3 THEN 'g' ELSE 'ta' END || CAST(c_custkey % 10 AS VARCHAR(20)) END AS logger_name, CASE c_custkey % 4 WHEN 0 THEN 'arq' WHEN 1 THEN 'regular' WHEN 2 THEN 'gateway' ELSE 'other' END AS logger_type, CASE WHEN c_custkey % 6 = 0 THEN c_custkey END AS date_deactivated FROM {customer})"""


def _loggers(i):
    return i.spark.sql(LOGR[1:-1], customer=i.customer)


@query("eligible_loggers", "A28", f"SELECT logger_id, logger_name FROM {LOGR} WHERE date_deactivated IS NULL AND logger_type IN ('arq', 'regular', 'router') AND logger_name NOT IN ('testa', 'testb', 'testc', 'bulg', 'phig', 'bgbg', 'mycg', 'nvcg') AND logger_name NOT LIKE '%___r_%' AND logger_name NOT LIKE '%___pz%' AND logger_name NOT LIKE '%___x_%'")
def _(i):
    return A.eligible_loggers_v2(_loggers(i)).select("logger_id", "logger_name")


@query("eligible_gateways", "A28", f"SELECT logger_id, logger_name FROM {LOGR} WHERE logger_type IN ('gateway', 'arq') AND logger_name LIKE '%___r_%' OR logger_name LIKE '%___g%' AND logger_name NOT IN ('madg', 'bulg', 'phig', 'bgbg', 'mycg', 'nvcg')")
def _(i):
    return A.eligible_loggers_v3(_loggers(i)).select("logger_id", "logger_name")
