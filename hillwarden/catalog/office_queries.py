"""Queries over release schedules, recipients and grades."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.clock import at, clean_round, span
from ..plans import grading as GR, releases as RE
from .registry import query
from .sensor_queries import R

SHIFT = "time_bucket(INTERVAL 12 HOUR, data_ts - INTERVAL 8 HOUR) + INTERVAL 8 HOUR"


def rel(t):
    return f"(time_bucket(INTERVAL 4 HOUR, {t}) + INTERVAL 4 HOUR)"


@query("site_names", "F21", "SELECT site_id, CASE WHEN site_id IN (1, 2) THEN lower(municipality) WHEN site_id IN (3, 4) THEN replace(lower(sitio), ' ', ' | ') ELSE trim(replace(replace(lower(barangay || ', ' || municipality), 'city', ''), '.', '')) END AS name FROM {site_names}")
def _(i):
    return i.site_names.select("site_id", RE.site_name((1, 2), (3, 4)).alias("name"))


ROUT = "rt AS (SELECT s.site_id, d + INTERVAL 690 MINUTE AS data_ts FROM (SELECT unnest(generate_series(TIMESTAMP '1997-05-01', TIMESTAMP '1997-06-30', INTERVAL 1 DAY)) AS d) JOIN {plan} p ON isodow(d) = p.iso_week_day JOIN {seasons} s ON s.month = month(d) AND s.season_type = p.season_type WHERE isodow(d) IN (2, 3, 5))"


def _routine(i):
    return RE.routine_schedule(i.seasons, i.plan, "1997-05-01", "1997-06-30")


@query("routine_schedule", "S1", f"WITH {ROUT} SELECT * FROM rt")
def _(i):
    return _routine(i)


FLAGS = "fl AS (SELECT *, max(CASE WHEN alert_symbol = 'E' THEN 1 ELSE 0 END) OVER (PARTITION BY event_id) AS eq, greatest(max(CASE WHEN alert_symbol IN ('m', 'M') THEN 1 ELSE 0 END) OVER (PARTITION BY event_id, pub_sym_id), 1 - has_markers) AS moms FROM {event_rows})"


@query("event_flags", "S4", f"WITH {FLAGS} SELECT event_id, data_ts, pub_sym_id, eq, moms FROM fl")
def _(i):
    return RE.event_flags(i.event_rows).select("event_id", "data_ts", "pub_sym_id", "eq", "moms")


DAYL = lambda t: f"CAST(hour({rel(t)}) BETWEEN 8 AND 16 AS INT)"
EVS = f"""{ROUT}, {FLAGS},
ev AS (SELECT event_id, site_id, max(validity) AS v, min(data_ts) AS f, max(has_markers) AS hm, min(data_ts) FILTER (eq = 1) AS eqf, min(data_ts) FILTER (moms = 1) AS mof, arg_max(pub_sym_id, data_ts) AS ls FROM fl GROUP BY event_id, site_id),
ons AS (SELECT fl.event_id, fl.site_id, fl.data_ts, 1 AS o, fl.pub_sym_id, CAST(alert_symbol = 'D' OR pub_sym_id = 4 AS INT) AS permission, CASE WHEN data_ts = f THEN CAST(EXISTS (SELECT 1 FROM rt WHERE rt.site_id = fl.site_id AND rt.data_ts::DATE = fl.data_ts::DATE) AND (hour(data_ts) * 60 + minute(data_ts)) BETWEEN 570 AND 720 AS INT) ELSE CAST(date_diff('minute', data_ts, {rel('data_ts')}) <= 150 AND {DAYL('data_ts')} = 1 AS INT) END AS meas FROM fl JOIN ev USING (event_id)),
low AS (SELECT event_id, site_id, v - INTERVAL 30 MINUTE AS data_ts, 2 AS o, ls AS pub_sym_id, CAST(ls = 4 AS INT) AS permission, {DAYL('v - INTERVAL 30 MINUTE')} AS meas FROM ev),
gr AS (SELECT event_id, site_id, unnest(generate_series({rel('f')}, v - INTERVAL 4 HOUR, INTERVAL 4 HOUR)) AS r FROM ev),
reg AS (SELECT event_id, site_id, r - INTERVAL 30 MINUTE AS data_ts, 0 AS o, NULL::INT AS pub_sym_id, 0 AS permission, CASE WHEN EXISTS (SELECT 1 FROM fl WHERE fl.event_id = gr.event_id AND {rel('fl.data_ts')} = gr.r) THEN 0 ELSE CAST(hour(r) BETWEEN 8 AND 16 AS INT) END AS meas FROM gr WHERE NOT EXISTS (SELECT 1 FROM fl WHERE fl.event_id = gr.event_id AND hour(fl.data_ts) % 4 = 3 AND minute(fl.data_ts) IN (0, 30) AND {rel('fl.data_ts')} = gr.r)),
al AS (SELECT event_id, site_id, data_ts, o, permission, meas, last_value(pub_sym_id IGNORE NULLS) OVER (PARTITION BY event_id ORDER BY data_ts, o ROWS UNBOUNDED PRECEDING) AS pub_sym_id FROM (SELECT * FROM ons UNION ALL SELECT * FROM low UNION ALL SELECT * FROM reg)),
es AS (SELECT al.event_id, al.site_id, data_ts, pub_sym_id, permission, CAST(o = 1 AS INT) AS raising, CAST(o = 2 AS INT) AS lowering, 1 AS event, 0 AS extended, coalesce(CAST(data_ts >= eqf AS INT), 0) AS eq, CASE WHEN hm = 1 THEN meas ELSE 0 END AS gndmeas, CASE WHEN hm = 0 THEN meas WHEN data_ts >= mof THEN meas ELSE 0 END AS moms FROM al JOIN ev USING (event_id)
 UNION ALL SELECT event_id, site_id, date_trunc('day', v) + INTERVAL 2130 MINUTE + INTERVAL 1 DAY * k, 1, 0, 0, 0, 0, 1, 0, hm, 1 - hm FROM ev CROSS JOIN (VALUES (0), (1), (2)) AS kk(k))"""


def _events(i):
    return RE.event_schedule(RE.event_flags(i.event_rows), _routine(i))


@query("event_schedule", "S2", f"WITH {EVS} SELECT * FROM es")
def _(i):
    return _events(i)


@query("release_schedule", "S3", f"""WITH {EVS}, m AS (SELECT * FROM es UNION ALL SELECT NULL, site_id, data_ts, 1, 0, 0, 0, 0, 0, 0, 1, 0 FROM rt),
u AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY site_id, data_ts ORDER BY pub_sym_id DESC, extended, event DESC, raising DESC, lowering DESC, event_id DESC NULLS LAST) = 1)
SELECT * FROM u WHERE NOT EXISTS (SELECT 1 FROM es WHERE lowering = 1 AND hour(es.data_ts) < 8 AND es.site_id = u.site_id AND date_trunc('day', es.data_ts) + INTERVAL 690 MINUTE = u.data_ts) AND data_ts >= TIMESTAMP '1997-05-10' - INTERVAL 30 MINUTE AND data_ts <= TIMESTAMP '1997-06-20' - INTERVAL 30 MINUTE""")
def _(i):
    return RE.release_schedule(_events(i), _routine(i), at("1997-05-10 00:00:00"), at("1997-06-20 00:00:00"))


def due_sql(start, extra, low, raising):
    m = f"{start} + greatest(0, n - 5) * {extra} + CASE WHEN lowering = 1 THEN {low} ELSE 0 END"
    if raising:
        m = f"CASE WHEN raising = 1 THEN {raising} ELSE {m} END"
    return f"(SELECT r.*, r.data_ts + INTERVAL 1 MINUTE * CAST({m} AS INT) AS ts_due FROM {{releases}} r JOIN (SELECT data_ts, count(*) FILTER (event = 1) + max(CASE WHEN event = 1 THEN 0 ELSE 1 END) AS n FROM {{releases}} GROUP BY data_ts) c ON r.data_ts = c.data_ts)"


for _name, _args in {"sms": (35, 1, 15, 55), "bulletin": (40, 2, 15, 60), "web": (30, 0, 0, 50), "rain": (45, 0, 0, 0)}.items():

    def _due(i, policy=RE.POLICIES[_name]):
        return RE.due_times(i.releases, policy).select("release_id", "ts_due")

    query(f"due_times_{_name}", "S5", f"SELECT release_id, ts_due FROM {due_sql(*_args)}")(_due)


@query("recipients", "S6", "SELECT user_id, site_id, org_name, CAST(CASE WHEN alert_restriction IS NOT NULL THEN alert_restriction + 1 WHEN org_name NOT IN ('lewc', 'blgu', 'mlgu') THEN 1 ELSE 0 END AS INT) AS alert_level FROM {contacts} WHERE active = 1 AND receives = 1 AND staff = 0")
def _(i):
    return RE.recipients(i.contacts, i.contacts.filter("staff = 1"))


PEOPLE = "(SELECT user_id, site_id, org_name, CASE WHEN alert_restriction IS NOT NULL THEN alert_restriction + 1 WHEN org_name NOT IN ('lewc', 'blgu', 'mlgu') THEN 1 ELSE 0 END AS lv FROM {contacts} WHERE active = 1 AND receives = 1 AND staff = 0)"
MS = f"ms AS (SELECT r.release_id, r.site_id, p.user_id, p.org_name, r.data_ts, r.ts_due, (SELECT min(s.ts_written) FROM {{sent_log}} s WHERE s.site_id = r.site_id AND s.user_id = p.user_id AND s.ts_written BETWEEN r.data_ts AND r.data_ts + INTERVAL 4 HOUR) AS ts_written FROM {due_sql(35, 1, 15, 55)} r JOIN {PEOPLE} p ON r.site_id = p.site_id AND r.pub_sym_id - 1 >= p.lv)"


def _matched(i):
    d = RE.due_times(i.releases, RE.POLICIES["sms"])
    return RE.match_sent(d, RE.recipients(i.contacts, i.contacts.filter("staff = 1")), i.sent_log)


@query("sent_matching", "S7", f"WITH {MS} SELECT release_id, user_id, ts_written FROM ms")
def _(i):
    return _matched(i).select("release_id", "user_id", "ts_written")


@query("sending_timeliness", "S9", f"WITH {MS} SELECT {SHIFT} AS shift_ts, {R('avg(CASE WHEN ts_written IS NULL THEN 0.0 ELSE 1.0 - 0.1 * greatest(0.0, date_diff(SECOND_, ts_due, ts_written)) / (60 * 3) END::DOUBLE)', 4)} AS grade FROM ms GROUP BY 1".replace("SECOND_", "'second'"))
def _(i):
    return GR.timeliness(_matched(i), 3)


@query("web_timeliness", "S9,S21", f"""WITH w AS (SELECT data_ts, CASE WHEN raising = 1 THEN data_ts ELSE data_ts + INTERVAL 20 MINUTE END AS ts_start, ts_due, CASE WHEN release_id % 7 <> 0 THEN data_ts + INTERVAL 1 MINUTE * CAST(release_id % 60 AS INT) END AS ts_release FROM {due_sql(30, 0, 0, 50)})
SELECT {SHIFT} AS shift_ts, {R("avg(CASE WHEN ts_release IS NULL THEN 0.0 ELSE 1.0 - least(1.0, 0.1 * ceil(greatest(0.0, date_diff('second', ts_due, ts_release), date_diff('second', ts_release, ts_start)) / 180.0)) END::DOUBLE)", 4)} AS grade FROM w GROUP BY 1""")
def _(i):
    d = RE.due_times(i.releases, RE.POLICIES["web"])
    rid = F.col("release_id")
    d = d.withColumns(
        {
            "ts_start": F.when(F.col("raising") == 1, F.col("data_ts")).otherwise(F.col("data_ts") + span(mins=20)),
            "ts_release": F.when(rid % 7 != 0, F.col("data_ts") + span(mins=(rid % 60).cast("int"))),
        }
    )
    return GR.web_timeliness(d)


@query("web_release_times", "S21", "SELECT release_id, CASE WHEN t < data_ts THEN t - INTERVAL 1 DAY ELSE t END AS ts_release FROM (SELECT *, date_trunc('day', data_ts) + INTERVAL 1 MINUTE * CAST(release_id % 1440 AS INT) AS t FROM {releases})")
def _(i):
    return i.releases.select("release_id", RE.release_ts(F.to_date("data_ts"), (F.col("release_id") % 1440).cast("int"), F.col("data_ts")).alias("ts_release"))


TXT = "(SELECT sent_id, user_id AS mobile_id, ts_written, 'advisory for site' || CAST(site_id AS VARCHAR(20)) || CASE WHEN sent_id % 3 = 0 THEN ' 20 mm over threshold' WHEN sent_id % 3 = 1 THEN ' at 80% of limit' ELSE '' END AS sms_msg FROM {sent_log})"
TDUE = "(SELECT release_id, site_id AS mobile_id, 'site' || CAST(site_id AS VARCHAR(20)) AS name, data_ts, CAST(release_id % 2 AS INT) AS mm_values, CAST(release_id % 3 AS INT) AS percentage FROM {releases})"


@query("text_matching", "S8,F22", f"""WITH m AS (SELECT d.release_id, d.mobile_id, d.mm_values, d.percentage, min(s.ts_written) AS ts_written, coalesce(max(CASE WHEN sms_msg LIKE '%mm%' AND sms_msg LIKE '%threshold%' THEN 1 ELSE 0 END), 0) AS mm, coalesce(max(CASE WHEN sms_msg LIKE '%\\%%' ESCAPE '\\' THEN 1 ELSE 0 END), 0) AS pc FROM {TDUE} d LEFT JOIN {TXT} s ON s.mobile_id = d.mobile_id AND s.ts_written BETWEEN d.data_ts AND d.data_ts + INTERVAL 4 HOUR AND contains(s.sms_msg, d.name) GROUP BY ALL)
SELECT release_id, mobile_id, ts_written, CASE WHEN mm_values = 1 AND mm = 0 AND percentage = 1 AND pc = 0 THEN '(mm and percentage)' WHEN mm_values = 1 AND mm = 0 THEN '(mm)' WHEN percentage = 1 AND pc = 0 THEN '(percentage)' END AS unwritten_info FROM m""")
def _(i):
    s = i.spark.sql(TXT[1:-1], sent_log=i.sent_log)
    d = i.spark.sql(TDUE[1:-1], releases=i.releases)
    return RE.match_text(d, s).select("release_id", "mobile_id", "ts_written", "unwritten_info")


@query("unsent_report", "S17", f"WITH {MS} SELECT DISTINCT release_id, site_id, 'site ' || site_id AS site_name, user_id FROM ms WHERE ts_written IS NULL")
def _(i):
    names = i.site_names.select("site_id", F.concat(F.lit("site "), F.col("site_id").cast("string")).alias("site_name"))
    return RE.unsent(_matched(i), names)


@query("missing_offices", "S17", f"WITH {MS} SELECT release_id, string_agg(o, ',' ORDER BY o) AS missing FROM (SELECT DISTINCT release_id, o FROM ms CROSS JOIN (VALUES ('lewc'), ('blgu')) AS v(o) WHERE NOT EXISTS (SELECT 1 FROM ms m2 WHERE m2.release_id = ms.release_id AND m2.org_name = o AND m2.ts_written IS NOT NULL)) GROUP BY release_id")
def _(i):
    return RE.missing_offices(_matched(i), ["lewc", "blgu"])


@query("quality_grades", "S10", """WITH c AS (SELECT CAST(site_id % 15 AS BIGINT) AS staff_id, count(*) AS n FROM {releases} GROUP BY 1), l AS (SELECT CAST(staff_id AS BIGINT) AS staff_id, typo, wrong_alert, late_entry FROM {evaluations} QUALIFY row_number() OVER (PARTITION BY staff_id ORDER BY ts DESC, eval_id DESC) = 1)
SELECT c.staff_id, n, """ + R("(n - coalesce(wrong_alert * 1.0::DOUBLE + late_entry / 3.0::DOUBLE + typo / 30.0::DOUBLE, 0)) / n", 4) + """ AS grade FROM c LEFT JOIN l ON c.staff_id = l.staff_id""")
def _(i):
    c = i.releases.groupBy((F.col("site_id") % 15).alias("staff_id")).agg(F.count(F.lit(1)).alias("n"))
    e = i.evaluations.withColumn("staff_id", F.col("staff_id").cast("bigint"))
    return GR.quality(c, e, {"wrong_alert": 1.0, "late_entry": 1 / 3, "typo": 1 / 30}, ["staff_id"])


FYR = "(SELECT event_id AS release_id, user_id % 50 AS site_id, ts AS data_ts, ts + INTERVAL 9 HOUR AS shift_end FROM {events} WHERE event_type = 'error')"


@query("notification_deductions", "S11", f"""WITH d AS (SELECT *, data_ts - INTERVAL 1 HOUR AS a, {rel('data_ts')} AS e FROM {FYR}),
n AS (SELECT d.release_id, max(x.ts) AS l FROM d JOIN (SELECT user_id % 50 AS site_id, ts FROM {{events}} WHERE event_type = 'purchase') x ON x.site_id = d.site_id AND x.ts BETWEEN a AND shift_end GROUP BY 1),
g AS (SELECT d.release_id, count(*) AS c, min(x.ts) AS f FROM d JOIN (SELECT user_id % 50 AS site_id, ts FROM {{events}} WHERE event_type = 'click') x ON x.site_id = d.site_id AND x.ts BETWEEN a AND shift_end GROUP BY 1)
SELECT d.release_id, d.site_id, CASE WHEN l IS NULL THEN 1.0 ELSE round(0.1::DOUBLE * ceil(greatest(0, date_diff('microsecond', e, l) / 1000000.0) / 600.0), 4) + 0.0 END::DOUBLE AS deduction_t, CASE WHEN l IS NULL OR c IS NULL THEN 1.0 WHEN c = 1 THEN 0.0 WHEN f <= a + INTERVAL 1 HOUR THEN 0.2 WHEN f <= e THEN 0.6 ELSE 1.0 END::DOUBLE AS deduction_q FROM d LEFT JOIN n USING (release_id) LEFT JOIN g USING (release_id)""")
def _(i):
    ev = i.events.withColumn("site_id", F.col("user_id") % 50)
    r = ev.filter("event_type = 'error'").select(F.col("event_id").alias("release_id"), "site_id", F.col("ts").alias("data_ts"), (F.col("ts") + span(hours=9)).alias("shift_end"))
    return GR.notification_deductions(r, ev.filter("event_type = 'purchase'"), ev.filter("event_type = 'click'"))


@query("reminder_check", "S12", """WITH s AS (SELECT event_id AS release_id, user_id % 50 AS site_id, ts AS data_ts, event_id % 2 AS event FROM {events} WHERE event_type = 'error'), m AS (SELECT user_id % 50 AS site_id, ts FROM {events} WHERE event_type = 'purchase'), r AS (SELECT user_id % 50 AS site_id, ts FROM {events} WHERE event_type = 'click')
SELECT release_id, site_id, CAST(EXISTS (SELECT 1 FROM m WHERE m.site_id = s.site_id AND m.ts >= data_ts - INTERVAL 210 MINUTE - CASE WHEN event <> 1 THEN INTERVAL 4 HOUR ELSE INTERVAL 0 HOUR END AND m.ts < data_ts - INTERVAL 2 HOUR) <> EXISTS (SELECT 1 FROM r WHERE r.site_id = s.site_id AND r.ts >= data_ts - INTERVAL 125 MINUTE AND r.ts < data_ts - INTERVAL 90 MINUTE) AS INT) AS reminder FROM s""")
def _(i):
    ev = i.events.withColumn("site_id", F.col("user_id") % 50)
    s = ev.filter("event_type = 'error'").select(F.col("event_id").alias("release_id"), "site_id", F.col("ts").alias("data_ts"), (F.col("event_id") % 2).alias("event"))
    return GR.reminder_check(s, ev.filter("event_type = 'purchase'"), ev.filter("event_type = 'click'"))


@query("evaluation_grades", "S13", """WITH s AS (SELECT DISTINCT o_custkey % 15 AS staff_id, TIMESTAMP '2024-01-31 12:00:00' - INTERVAL 1 HOUR * CAST(o_custkey % 15 AS INT) AS shift_end FROM {orders}), l AS (SELECT CAST(staff_id AS BIGINT) AS staff_id, max(ts) AS t FROM {evaluations} GROUP BY 1), h AS (SELECT s.staff_id, t, ceil(date_diff('microsecond', shift_end + INTERVAL 4 HOUR, t) / 3600000000.0) AS k FROM s LEFT JOIN l ON s.staff_id = l.staff_id)
SELECT staff_id, CASE WHEN t IS NULL THEN 0.0 WHEN k <= 0 THEN 1.0 ELSE """ + R("(15 - least(15, 2 * k)) / 15.0", 4) + """ END::DOUBLE AS grade FROM h""")
def _(i):
    k = F.col("o_custkey") % 15
    s = i.orders.select(k.alias("staff_id")).distinct().withColumn("shift_end", at("2024-01-31 12:00:00") - span(hours=F.col("staff_id").cast("int")))
    return GR.evaluation_grade(s, i.evaluations.withColumn("staff_id", F.col("staff_id").cast("bigint")), ["staff_id"])


@query("attendance", "S14", """WITH s AS (SELECT DISTINCT o_custkey % 50 AS staff_id, o_orderdate + INTERVAL 8 HOUR AS shift_ts FROM {orders}), p AS (SELECT s.staff_id, s.shift_ts, sum(greatest(0.0, date_diff('microsecond', greatest(time_in, shift_ts - INTERVAL 15 MINUTE), least(time_out, shift_ts + INTERVAL 735 MINUTE)) / 3600000000.0)) AS h FROM s JOIN {punches} p ON p.staff_id = s.staff_id AND p.time_in <= s.shift_ts + INTERVAL 735 MINUTE AND p.time_out >= s.shift_ts - INTERVAL 15 MINUTE GROUP BY ALL)
SELECT s.staff_id, s.shift_ts, """ + R("coalesce(h, 0.0)::DOUBLE / 12.5", 4) + """ AS grade FROM s LEFT JOIN p ON s.staff_id = p.staff_id AND s.shift_ts = p.shift_ts""")
def _(i):
    s = i.orders.select((F.col("o_custkey") % 50).alias("staff_id"), (F.col("o_orderdate") + span(hours=8)).alias("shift_ts")).distinct()
    return GR.attendance(s, i.punches)


@query("availability", "S15,J13", """WITH s AS (SELECT DISTINCT o_orderdate + INTERVAL 8 HOUR AS shift_ts FROM {orders}), o AS (SELECT shift_ts, sum(date_diff('microsecond', greatest(start_ts, shift_ts), least(end_ts, shift_ts + INTERVAL 12 HOUR)) / 3600000000.0) AS h FROM s JOIN {downtime} i ON reported = 0 AND start_ts <= shift_ts + INTERVAL 12 HOUR AND end_ts >= shift_ts GROUP BY 1) SELECT s.shift_ts, """ + R("1.0 - coalesce(h, 0.0)::DOUBLE / 12.5", 4) + """ AS grade FROM s LEFT JOIN o ON s.shift_ts = o.shift_ts""")
def _(i):
    s = i.orders.select((F.col("o_orderdate") + span(hours=8)).alias("shift_ts")).distinct()
    return GR.availability(s, i.downtime)


SHIFTS = "(SELECT DISTINCT o_custkey % 20 AS staff_id, o_orderdate + INTERVAL 4 HOUR * CAST(2 + 3 * (o_custkey % 2) AS INT) AS shift_ts FROM {orders})"
SHIFTEVALS = """(SELECT staff_id, ts, min(CASE WHEN o % 4 = 0 THEN 'No' WHEN o % 3 = 0 THEN 'Yes' END) AS bug_log, min(CASE WHEN o % 5 = 0 THEN 'No' WHEN o % 7 = 0 THEN 'Yes' END) AS relayed, min(CASE WHEN o % 6 = 0 THEN 'NAN EEEE' ELSE rpad('A', CAST(1 + 3 * (o % 7) AS INT), ', B') END) AS contacts
    FROM (SELECT o_custkey % 20 AS staff_id, o_orderdate + INTERVAL 1 HOUR * CAST(8 + o_orderkey % 3 * 6 AS INT) AS ts, o_orderkey AS o FROM {orders}) AS e1 GROUP BY staff_id, ts)"""
RELEASED = "(SELECT data_ts FROM {event_rows})"


@query("shift_system_grades", "S15", f"""WITH s AS {SHIFTS}, v AS {SHIFTEVALS}, sys AS (SELECT shift_ts, 1.0 - coalesce(sum(CASE WHEN start_ts IS NOT NULL THEN date_diff('microsecond', greatest(start_ts, shift_ts), least(end_ts, shift_ts + INTERVAL 12 HOUR)) / 3600000000.0 END), 0.0)::DOUBLE / 12.5 AS g FROM (SELECT DISTINCT shift_ts FROM s) LEFT JOIN {{downtime}} ON reported = 0 AND start_ts <= shift_ts + INTERVAL 12 HOUR AND end_ts >= shift_ts GROUP BY shift_ts),
b AS (SELECT s.staff_id, s.shift_ts, min_by(struct_pack(b := bug_log, r := relayed, c := contacts), v.ts) AS e FROM s JOIN v ON v.staff_id = s.staff_id AND v.ts >= s.shift_ts AND v.ts <= s.shift_ts + INTERVAL 1 DAY GROUP BY ALL),
h AS (SELECT DISTINCT s.shift_ts FROM s JOIN {RELEASED} r ON r.data_ts > s.shift_ts AND r.data_ts <= s.shift_ts + INTERVAL 12 HOUR),
x AS (SELECT s.*, {R('g', 4)} AS g, h.shift_ts IS NOT NULL AS release, e IS NOT NULL AS have, e.c AS c, CASE WHEN coalesce(e.b, e.r) IS NOT NULL THEN CASE WHEN coalesce(e.b, 'Yes') = 'Yes' AND coalesce(e.r, 'Yes') = 'Yes' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END END AS bug FROM s JOIN sys USING (shift_ts) LEFT JOIN b USING (staff_id, shift_ts) LEFT JOIN h USING (shift_ts))
SELECT staff_id, shift_ts, release, {R('CASE WHEN release OR bug IS NULL THEN g ELSE (g + bug) / 2 END', 4)} AS system, CASE WHEN release THEN bug END AS bug, CASE WHEN NOT release AND c IS NOT NULL THEN {R("CASE WHEN c = 'NAN EEEE' THEN 0.0::DOUBLE ELSE least(1.0::DOUBLE, len(string_split(c, ', ')) / 5.0::DOUBLE) END", 4)} END AS contacts FROM x""")
def _(i):
    tables = {"orders": i.orders}
    evals = i.spark.sql("SELECT * FROM " + SHIFTEVALS, **tables).withColumnRenamed("ts", "shift_ts")
    return GR.shift_system_grades(i.spark.sql("SELECT * FROM " + SHIFTS, **tables), i.event_rows.select("data_ts"), evals, i.downtime)


@query("log_grades", "S15", "SELECT staff_id, min(CASE WHEN a IS NOT NULL THEN CAST(a = 'Yes' AS INT) END) AS grade FROM (SELECT CAST(staff_id AS BIGINT) AS staff_id, CASE WHEN eval_id % 50 = 0 THEN 'No' WHEN staff_id % 2 = 0 THEN 'Yes' END AS a FROM {evaluations}) GROUP BY staff_id")
def _(i):
    a = F.when(F.col("eval_id") % 50 == 0, "No").when(F.col("staff_id") % 2 == 0, "Yes")
    d = i.evaluations.select(F.col("staff_id").cast("bigint").alias("staff_id"), a.alias("bug_log"), a.alias("relayed"))
    return GR.log_grade(d, ["staff_id"], ["bug_log", "relayed"])


@query("peer_ratings", "S16", "SELECT CAST(staff_id AS BIGINT) AS staff_id, " + R("avg(v) * 100 / 5.0", 4) + " AS grade, count(*) AS ratings FROM (SELECT staff_id, rating_a AS v FROM {evaluations} UNION ALL SELECT staff_id, rating_b FROM {evaluations}) WHERE v IS NOT NULL GROUP BY 1")
def _(i):
    return GR.peer_rating(i.evaluations.withColumn("staff_id", F.col("staff_id").cast("bigint")), "staff_id", ["rating_a", "rating_b"])


@query("validation_tasks", "S18", "SELECT m.data_id, 'validate ' || m.site_id || ' ' || strftime(m.ts, '%Y-%m-%d %H:%M') AS message FROM {markers} m WHERE ts > TIMESTAMP '2024-01-19 00:00:00' AND ts <= TIMESTAMP '2024-01-20 12:00:00' AND data_id % 5 = 0")
def _(i):
    lv = i.markers.select("data_id", F.when(F.col("data_id") % 5 == 0, 0).otherwise(2).alias("alert_level"))
    return RE.to_validate(i.markers, lv, at("2024-01-20 12:00:00"))


@query("tagged_log", "S19,F22", "SELECT m.inbox_id, tag, c.site_id, c.org_name FROM (SELECT event_id AS inbox_id, user_id, ts, CASE WHEN event_type = 'click' THEN '#AlertFYI' ELSE '#GroundMeas' END AS tag FROM {events} WHERE event_type IN ('click', 'purchase')) m LEFT JOIN {contacts} c ON m.user_id = c.user_id WHERE m.ts >= TIMESTAMP '2024-01-10' AND m.ts <= TIMESTAMP '2024-01-12'")
def _(i):
    m = i.events.select(F.col("event_id").alias("inbox_id"), "user_id", "ts")
    t = i.events.filter(F.col("event_type").isin("click", "purchase")).select(F.col("event_id").alias("inbox_id"), F.when(F.col("event_type") == "click", "#AlertFYI").otherwise("#GroundMeas").alias("tag"))
    return RE.tagged_messages(m, t, i.contacts, at("2024-01-10 00:00:00"), at("2024-01-12 00:00:00")).select("inbox_id", "tag", "site_id", "org_name")


@query("monitored_sites", "S20", """WITH e AS (SELECT site_id, max(CASE WHEN ts >= TIMESTAMP '1997-06-03 08:00:00' THEN 1 ELSE 0 END) AS ins, max(ts_updated) AS v FROM {intervals} WHERE ts <= TIMESTAMP '1997-06-03 12:00:00' GROUP BY site_id),
a AS (SELECT site_id, CASE WHEN ins = 1 OR v >= TIMESTAMP '1997-06-03 12:00:00' THEN 'event' WHEN v < TIMESTAMP '1997-06-03' THEN 'extended' END AS mon_type FROM e WHERE ins = 1 OR v >= TIMESTAMP '1997-06-03 12:00:00' OR v < TIMESTAMP '1997-06-03')
SELECT * FROM a UNION ALL SELECT DISTINCT s.site_id, 'routine' FROM {seasons} s JOIN {plan} p ON s.season_type = p.season_type WHERE s.month = 6 AND p.iso_week_day = 2 AND s.site_id NOT IN (SELECT site_id FROM a)""")
def _(i):
    e = i.intervals.filter("ts <= TIMESTAMP_NTZ'1997-06-03 12:00:00'").select("site_id", F.col("ts").alias("ts_start"), F.col("ts_updated").alias("validity"))
    return RE.monitored(e, i.seasons, i.plan, "1997-06-03 12:00:00")


METRICS = "(SELECT * FROM (VALUES ('accuracy', 'view', 1), ('accuracy', 'click', 2), ('timeliness', 'view', 3), ('timeliness', 'purchase', 4), ('error_logs', 'error', 5)) AS m(type, metric_name, metric_id))"
SUBS = "CASE WHEN event_id % 4 = 0 THEN 'late' ELSE 'early' END"


def _facts(i):
    m = i.spark.sql(METRICS[1:-1])
    r = i.reports.withColumn("submetrics", F.array(F.when(F.col("report_id") % 4 == 0, "late").otherwise("early")))
    return GR.metric_facts(r, m, ["late", "early"])


@query("metric_facts", "S22", f"SELECT report_id, metric_id, CASE WHEN report_id % 4 = 0 THEN 1 ELSE 0 END AS late, CASE WHEN report_id % 4 = 0 THEN 0 ELSE 1 END AS early FROM {{reports}} r JOIN {METRICS} m ON r.type = m.type AND r.metric_name = m.metric_name")
def _(i):
    return _facts(i)[0].select("report_id", "metric_id", "late", "early")


@query("metric_rejects", "S22", f"SELECT report_id, r.type, r.metric_name FROM {{reports}} r LEFT JOIN {METRICS} m ON r.type = m.type AND r.metric_name = m.metric_name WHERE metric_id IS NULL")
def _(i):
    return _facts(i)[1].select("report_id", "type", "metric_name")
