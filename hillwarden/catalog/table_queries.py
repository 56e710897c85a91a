"""Queries over tables: bounded reads, registries, writes without MERGE."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.clock import at, clean_round, span
from ..operators import stats as A
from ..plans import subsurface as P
from ..sources import sinks as SK, tables as S
from .registry import query
from .sensor_queries import END, KIN, NODE, R, SERIES_SQL, _kin, _nodes


@query("bounded_readings", "I1", "SELECT event_id, tsm_id, node_id, ts, x FROM {readings} WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-09 00:00:00' AND tsm_id IN (0, 1, 3)")
def _(i):
    return S.read_family(i.readings, "2024-01-05 00:00:00", "2024-01-09 00:00:00", [0, 1, 3], cols=["event_id", *NODE, "ts", "x"])


@query("bounded_rain", "I1", "SELECT event_id, rain_id, ts, rain FROM {rain} WHERE ts > TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-09 00:00:00'")
def _(i):
    return S.read_family(i.rain, "2024-01-05 00:00:00", "2024-01-09 00:00:00", exclusive=True)


@query("sensor_ids", "I2", "SELECT tsm_name, arg_max(tsm_id, (CASE WHEN date_deactivated IS NULL OR date_deactivated >= TIMESTAMP '2016-02-01 00:00:00' THEN 1 ELSE 0 END) * 1000000 - tsm_id) AS tsm_id FROM {versions} GROUP BY tsm_name")
def _(i):
    return S.resolve_sensors(i.versions, at("2016-02-01 00:00:00"))


@query("logger_sensors", "I3", "SELECT logger_id, tsm_id FROM {versions} WHERE date_deactivated IS NULL OR date_deactivated > TIMESTAMP '2016-02-01 00:00:00' QUALIFY row_number() OVER (PARTITION BY logger_id ORDER BY date_activated DESC, tsm_id) = 1")
def _(i):
    return S.current_sensors(i.versions, at("2016-02-01 00:00:00"))


T0 = "(SELECT trigger_id, site_id, alert_level, ts_updated FROM {triggers} WHERE trigger_id % 3 <> 0)"
T1 = "(SELECT trigger_id, site_id, CAST(9 AS INT) AS alert_level, ts_updated + INTERVAL 1 HOUR AS ts_updated FROM {triggers} WHERE trigger_id % 2 = 0)"


def _upd(i):
    t = i.triggers.select("trigger_id", "site_id", "alert_level", "ts_updated")
    new = t.filter("trigger_id % 2 = 0").withColumns({"alert_level": F.lit(9), "ts_updated": F.col("ts_updated") + span(hours=1)})
    return t.filter("trigger_id % 3 <> 0"), new


UPSERTED = f"SELECT coalesce(n.trigger_id, o.trigger_id) AS trigger_id, coalesce(n.site_id, o.site_id) AS site_id, coalesce(n.alert_level, o.alert_level) AS alert_level, coalesce(n.ts_updated, o.ts_updated) AS ts_updated FROM {T0} o FULL JOIN {T1} n ON o.trigger_id = n.trigger_id"


@query("upsert_triggers", "I5", UPSERTED)
def _(i):
    old, new = _upd(i)
    return S.upsert(old, new.unionByName(new), ["trigger_id"], "ts_updated")


COUNTED = "SELECT user_id, CAST(sum(c) AS BIGINT) AS send_status FROM (SELECT user_id, event_id % 3 AS c FROM {events} WHERE event_id % 2 = 0 UNION ALL SELECT user_id, 1 FROM {events} WHERE event_id % 2 = 1) GROUP BY user_id"


@query("upsert_counters", "I6", COUNTED)
def _(i):
    e = i.events
    a = e.filter("event_id % 2 = 0").select("user_id", (F.col("event_id") % 3).alias("send_status"))
    b = e.filter("event_id % 2 = 1").select("user_id", F.lit(1).cast("bigint").alias("send_status"))
    return S.upsert_accumulate(a, b, ["user_id"], ["send_status"])


# The same into tables of files: only partitions with updates are read and rewritten.


@query("stored_triggers", "I5", UPSERTED)
def _(i):
    from .stream_queries import _scratch

    old, new = [d.withColumn("part", (F.col("trigger_id") % 8).cast("int")) for d in _upd(i)]
    path = f"{_scratch(i.spark)}/triggers"
    for d in (old, new, new.filter("part < 3")):  # the last changes nothing
        SK.upsert_into(path, d, ["trigger_id"], "part", "ts_updated")
    return i.spark.read.parquet(path).drop("part")


@query("stored_counters", "I6", COUNTED)
def _(i):
    from .stream_queries import _scratch

    e = i.events.withColumn("part", (F.col("user_id") % 8).cast("int"))
    path = f"{_scratch(i.spark)}/counters"
    for d in (e.filter("event_id % 2 = 0").select("part", "user_id", (F.col("event_id") % 3).alias("send_status")), e.filter("event_id % 2 = 1").select("part", "user_id", F.lit(1).cast("bigint").alias("send_status"))):
        SK.accumulate_into(path, d, ["part", "user_id"], ["send_status"], "part")
    return i.spark.read.parquet(path).drop("part")


@query("stored_family", "I1", "SELECT event_id, tsm_id, node_id, ts, x FROM {readings} WHERE ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts <= TIMESTAMP '2024-01-08 18:00:00' AND tsm_id IN (1, 3)")
def _(i):
    from .stream_queries import _scratch

    path = f"{_scratch(i.spark)}/tilt"
    S.write_family(i.readings, path)
    return S.read_family(i.spark.read.parquet(path), "2024-01-05 06:00:00", "2024-01-08 18:00:00", [1, 3], cols=["event_id", "tsm_id", "node_id", "ts", "x"])


@query("insert_missing", "I7,J4", f"SELECT * FROM {T0} UNION ALL SELECT * FROM {T1} n WHERE NOT EXISTS (SELECT 1 FROM {T0} o WHERE o.trigger_id = n.trigger_id)")
def _(i):
    old, new = _upd(i)
    return S.insert_missing(old, new, ["trigger_id"])


@query("incremental_rain", "I8", "SELECT event_id, rain_id, ts, rain FROM {rain} WHERE event_id > (SELECT max(event_id) FROM {rain} WHERE ts < TIMESTAMP '2024-01-15 00:00:00')")
def _(i):
    return S.incremental(i.rain, i.rain.filter("ts < TIMESTAMP_NTZ'2024-01-15 00:00:00'"), "event_id")


@query("normalised_poll", "I9", "SELECT rain_id, date_trunc('second', ts) AS ts, max(CASE WHEN event_id % 9 = 0 THEN NULL ELSE rain END) AS rain FROM {rain} WHERE date_trunc('second', ts) > TIMESTAMP '2024-01-10 00:00:00' GROUP BY 1, 2")
def _(i):
    d = i.rain.select("rain_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts_text"), F.when(F.col("event_id") % 9 == 0, "n/a").otherwise(F.col("rain").cast("string")).alias("rain_text"))
    return S.normalise_poll(d, at("2024-01-10 00:00:00"))


@query("poll_placeholders", "I10", """WITH w AS (SELECT DISTINCT rain_id, t AS start_ts, t + INTERVAL 6 HOUR AS end_ts FROM {rain} CROSS JOIN (SELECT unnest(generate_series(TIMESTAMP '2024-01-10 00:00:00', TIMESTAMP '2024-01-12 18:00:00', INTERVAL 6 HOUR)) AS t))
SELECT rain_id, end_ts AS ts, -1.0::DOUBLE AS rain FROM w WHERE NOT EXISTS (SELECT 1 FROM {rain} r WHERE r.rain_id = w.rain_id AND r.ts > w.start_ts AND r.ts <= w.end_ts)""")
def _(i):
    w = i.rain.groupBy("rain_id").agg(F.count(F.lit(1)).alias("n")).select(
        "rain_id", F.explode(F.expr("sequence(TIMESTAMP_NTZ'2024-01-10 00:00:00', TIMESTAMP_NTZ'2024-01-12 18:00:00', INTERVAL 6 HOUR)")).alias("start_ts")
    ).withColumn("end_ts", F.col("start_ts") + span(hours=6))
    return S.placeholder_rows(w, i.rain, ["rain_id"])


GN = "(SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN 'level ' ELSE 'Rain ' END || CAST(s_suppkey % 60 AS VARCHAR(20)) AS gauge_name, CASE WHEN s_suppkey % 13 = 0 THEN 0.0 ELSE 9.5 END AS latitude, 121.5 AS longitude, s_suppkey % 4 = 0 AS deactivated FROM {supplier})"


@query("catalogue_changes", "I11", f"""WITH n AS (SELECT gauge_name, max(CAST(deactivated AS INT)) AS off FROM {GN} WHERE lower(gauge_name) LIKE '%rain%' AND latitude <> 0 GROUP BY gauge_name), k AS (SELECT DISTINCT gauge_name FROM {GN} WHERE s_suppkey % 2 = 0)
SELECT gauge_name, 'new' AS change FROM n WHERE off = 0 AND gauge_name NOT IN (SELECT gauge_name FROM k) UNION ALL SELECT gauge_name, 'deactivated' FROM n WHERE off = 1 AND gauge_name IN (SELECT gauge_name FROM k)""")
def _(i):
    g = i.spark.sql(GN[1:-1], supplier=i.supplier)
    known = g.filter("s_suppkey % 2 = 0").select("gauge_name", F.lit(False).alias("deactivated")).distinct()
    g = g.drop("s_suppkey")
    return S.sync_catalogue(known, g.filter("deactivated"), g.filter("NOT deactivated"))


@query("nested_readings", "I13")
def _(i):
    d = i.readings.withColumn("day", F.to_date("ts"))
    return S.to_nested_json(d, ["tsm_id", "node_id", "day"], ["ts", "event_id", "x", "y", "z"])


@query("node_status_text", "J17", "SELECT tsm_id, node_id, arg_max(status, date_identified) AS status, CASE arg_max(status, date_identified) WHEN 1 THEN 'OK' WHEN 4 THEN 'Not OK' END AS text FROM {node_status} GROUP BY ALL")
def _(i):
    return S.status_text(i.node_status, NODE, {1: "OK", 4: "Not OK"})


@query("node_annotation", "A23", f"""WITH {KIN}, r AS (SELECT tsm_id, node_id, xz, row_number() OVER (PARTITION BY tsm_id, node_id ORDER BY ts)::DOUBLE AS i, rank() OVER (PARTITION BY tsm_id, node_id ORDER BY xz) + (count(*) OVER (PARTITION BY tsm_id, node_id, xz) - 1) / 2.0 AS k FROM kin),
c AS (SELECT tsm_id, node_id, CASE WHEN stddev_pop(k) > 0 THEN corr(i, k) END AS rho, max(xz) - min(xz) AS spread FROM r GROUP BY ALL), s AS (SELECT *, CAST(CASE WHEN rho > 0.5 THEN floor(round((round(rho, 1) - 0.5) * 10, 6)) ELSE 0 END AS INT) AS score FROM c)
SELECT tsm_id, node_id, {R('rho', 6)} AS rho, score, node_id || CASE WHEN spread > 0.01 THEN repeat('+', least(score, 4)) ELSE '' END AS text FROM s""")
def _(i):
    return A.node_annotation(_kin(i), NODE, "xz")


@query("resultant_alerts", "P21")
def _(i):
    return P.resultant_alerts(_nodes(i))


@query("drift_weeks", "W24")
def _(i):
    return P.drift_weeks(i.readings, NODE, ("ts", "event_id"))


@query("drifting_nodes", "W24")
def _(i):
    return P.drifting(P.drift_weeks(i.readings, NODE, ("ts", "event_id"), min_count=4, min_acc=0.0, min_r2=0.0), NODE, min_days=14)


@query("marker_sheet", "I4", "SELECT 'SITE' || site_id AS site_code, 'Marker ' || marker_id AS marker_name, date_trunc('second', ts) AS ts, measurement AS meas FROM {markers}")
def _(i):
    from .stream_queries import _scratch

    path = f"{_scratch(i.spark)}/sheet"
    i.markers.select(
        F.concat(F.lit("site"), F.col("site_id").cast("string")).alias("Site Code"), F.concat(F.lit("MARKER "), F.col("marker_id").cast("string")).alias("Marker Name"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("TS"), F.col("measurement").alias("Meas"),
    ).write.csv(path, header=True)
    return S.read_marker_csv(i.spark, path).select("site_code", "marker_name", "ts", "meas")
