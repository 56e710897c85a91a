"""Queries over text messages: routing, decoding and round trips."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.clock import at, clean_round
from ..operators import decode_logger as D, decode_text as X, routing as RT
from .fixtures import NTH, OBSERVATIONS
from .registry import query
from .sensor_queries import R

M = "{messages}"


def _text(d):
    """Texts as a plain column: a generator keeps the decoders' filters from
    being pushed into the expressions that build the sample texts."""
    return d.select(*[c for c in d.columns if c != "msg"], F.explode(F.array("msg")).alias("msg"))


def _all(i):
    return _text(i.messages)


def _routed(i, *routes):
    """All texts, routed; then those of the given routes."""
    return RT.route(_all(i)).filter(F.col("route").isin(*routes))


def _of(*kinds):
    """SQL: texts of the given formats in their own table."""
    return f"inbox_id % 20 IN ({', '.join(map(str, kinds))}) AND inbox_id % 13 <> 0"


MIN = "date_trunc('minute', ts)"
SEC = "date_trunc('second', ts)"
V, K = "CAST(floor(value) AS INT)", "inbox_id % 100"

ROUTES = ["extensometer", "lidar", "diagnostics", "rain_arq", "rain_csv", "rain_csv", "rssi", "tilt_vector", "gnss", "acknowledgement", "earthquake", "unknown", "status", "observation", "unknown", "piezo", "v1", "v2", "b64", "tilt_vector_v2"]
ROUTE = "CASE WHEN inbox_id % 13 = 0 THEN 'unknown' " + " ".join(f"WHEN inbox_id % 20 = {n} THEN '{r}'" for n, r in enumerate(ROUTES)) + " END"


@query("message_routes", "M1", f"SELECT inbox_id, {ROUTE} AS route FROM {M}")
def _(i):
    return RT.route(_all(i)).select("inbox_id", "route")


@query("route_counts", "M1,F22", r"""SELECT count(*) FILTER (source = 'loggers' AND regexp_matches(msg, '^[A-Z]{3}X[A-Z]{1}\*U\*')) AS extensometer, count(*) FILTER (source = 'users' AND regexp_matches(upper(msg), '^ACK \d+ .+')) AS acknowledgement, count(*) FILTER (source = 'loggers' AND regexp_matches(msg, 'PZ\*')) AS piezo FROM {messages}""")
def _(i):
    r = RT.route(_all(i))
    return r.agg(*[F.count_if(F.col("route") == n).alias(n) for n in ("extensometer", "acknowledgement", "piezo")])


@query("status_codes", "M2", f"SELECT inbox_id, CASE WHEN inbox_id % 20 = 12 THEN CASE {NTH.replace('event_id', 'inbox_id')} % 5 WHEN 0 THEN 4 WHEN 1 THEN 8 WHEN 2 THEN 6 WHEN 3 THEN 10 ELSE 9 END END AS status_code FROM {M}")
def _(i):
    return RT.classify_status(_all(i)).select("inbox_id", "status_code")


# --- round trips: integers -> hex text -> integers ---------------------------


def _hex(c, n):
    return F.lpad(F.hex(c.cast("long")), n, "0")


def _swap(c):
    h = _hex(c.cast("long").bitwiseAND(4095), 3)
    return F.concat(F.substring(h, 2, 2), F.substring(h, 1, 1))


def _name(suffix="TA"):
    return F.concat(F.lit("T"), F.char(65 + F.col("tsm_id") % 26), F.char(65 + (F.floor(F.col("tsm_id") / 26) % 26).cast("int")), F.lit(suffix))


def _stamp():
    return F.date_format("ts", "yyMMddHHmmss")


GOOD = "batt < 100 AND x > -2048"
NAME5 = "lower('T' || chr(65 + tsm_id % 26) || chr(65 + (tsm_id // 26) % 26) || 'TA')"
NAME4 = "lower('T' || chr(65 + tsm_id % 26) || chr(65 + (tsm_id // 26) % 26) || 'T')"


def _msgs(i, letter, payload, suffix="TA", where=GOOD):
    d = i.readings.filter(where)
    return _text(d.select(F.col("event_id").alias("inbox_id"), F.concat(_name(suffix), F.lit(letter), payload, F.lit("*"), _stamp()).alias("msg"), F.lit("639").alias("sim_num"), "ts"))


@query("decode_tilt_v2", "M4", f"SELECT event_id AS inbox_id, {NAME5} AS tsm_name, {MIN} AS ts, node_id, 11 AS type_num, x, y, z, batt FROM {{readings}} WHERE {GOOD}")
def _(i):
    c = F.col
    p = F.concat(_hex(c("node_id"), 2), F.lit("0B"), _swap(c("x")), _swap(c("y")), _swap(c("z")), _hex(F.round(c("batt") * 100) - 200, 2))
    return D.decode_v2(_msgs(i, "*x*", p))


@query("decode_tilt_v2_damaged", "M4", f"SELECT event_id AS inbox_id, node_id, x FROM {{readings}} WHERE {GOOD} AND event_id % 97 <> 0")
def _(i):
    c = F.col
    p = F.concat(_hex(c("node_id"), 2), F.lit("0B"), _swap(c("x")), _swap(c("y")), _swap(c("z")), _hex(F.round(c("batt") * 100) - 200, 2))
    d = _msgs(i, "*y*", F.when(F.col("event_id") % 97 == 0, F.substring(p, 1, 12)).otherwise(p))
    return D.decode_v2(d).select("inbox_id", "node_id", "x")


def _v1(i):
    c, ax = F.col, lambda a: _hex(F.col(a).cast("long").bitwiseAND(4095), 3)
    p = F.concat(_hex(c("node_id"), 2), ax("x"), ax("y"), ax("z"), _hex(F.round(c("batt") * 10), 4), F.lit("7"))
    d = i.readings.filter(GOOD + " AND x <= 1024 AND y <= 1024")
    return D.decode_v1(_text(d.select(F.col("event_id").alias("inbox_id"), F.concat(_name("T"), F.lit("DUE*"), p, F.lit("*"), _stamp()).alias("msg"), "ts")))


@query("decode_tilt_v1", "M3", f"SELECT event_id AS inbox_id, {NAME4} AS tsm_name, {MIN} AS ts, node_id, x, y, z FROM {{readings}} WHERE {GOOD} AND x <= 1024 AND y <= 1024")
def _(i):
    return _v1(i)[0]


@query("decode_moisture_v1", "M3", f"SELECT event_id AS inbox_id, {NAME4} AS tsm_name, {MIN} AS ts, node_id, CAST(round(batt * 10) AS INT) AS mval1 FROM {{readings}} WHERE {GOOD} AND x <= 1024 AND y <= 1024")
def _(i):
    return _v1(i)[1]


@query("decode_temperature", "M6", f"SELECT event_id AS inbox_id, {NAME5} AS tsm_name, {MIN} AS ts, node_id, CAST(21 + event_id % 4 AS INT) AS type_num, CASE WHEN 1000 + z >= 1022 AND 21 + event_id % 4 IN (23, 24) THEN 0 ELSE 1000 + z END AS temp_val FROM {{readings}} WHERE {GOOD}")
def _(i):
    p = F.concat(_hex(F.col("node_id"), 2), _hex(F.col("event_id") % 4 + 21, 2), _hex(F.col("z") + 1000, 4))
    return D.decode_temp(_msgs(i, "*d*", p))


@query("decode_moisture", "M5", f"""SELECT event_id AS inbox_id, node_id, CASE WHEN event_id % 2 = 0 THEN 110 ELSE 112 END AS type_num, CAST(1000 + z AS DOUBLE) AS mval1, CASE WHEN event_id % 2 = 0 THEN CAST(2000 + y AS DOUBLE) ELSE 0.0 END AS mval2 FROM {{readings}} CROSS JOIN (VALUES (1), (2)) AS v(k) WHERE {GOOD} AND y <= 1024 AND node_id <> 10""")
def _(i):
    def tri(c):
        h = _hex(c, 3)
        return F.concat(F.substring(h, 2, 2), F.substring(h, 1, 1))

    raw = F.concat(_hex(F.col("node_id"), 2), F.lit("6E"), tri(F.col("z") + 1000), tri(F.col("y") + 2000))
    cal = F.concat(_hex(F.col("node_id"), 2), F.lit("70"), tri(F.col("z") + 1000))
    # every third message carries the letter of the other kind
    even = F.col("event_id") % 2 == 0
    letter = F.when(F.when(F.col("event_id") % 3 == 0, ~even).otherwise(even), "*b*").otherwise("*c*")
    # node 10 reads as a command at the start of a raw message
    d = i.readings.filter(GOOD + " AND y <= 1024 AND node_id <> 10")
    m = d.select(F.col("event_id").alias("inbox_id"), F.concat(_name(), letter, F.repeat(F.when(even, raw).otherwise(cal), F.lit(2)), F.lit("*"), _stamp()).alias("msg"), "ts")
    return D.decode_soms(_text(m)).select("inbox_id", "node_id", "type_num", "mval1", "mval2")


def _b64(c, n):
    out = F.lit("")
    for k in range(n - 1, -1, -1):
        out = F.concat(out, F.substr(F.lit(D.B64), (F.floor(c / 64**k) % 64 + 1).cast("int"), F.lit(1)))
    return out


@query("decode_base64_tilt", "M7", f"SELECT event_id AS inbox_id, {NAME5} AS tsm_name, {MIN} AS ts, node_id, CASE WHEN event_id % 2 = 0 THEN 11 ELSE 51 END AS type_num, x, y, z, batt FROM {{readings}} WHERE {GOOD}")
def _(i):
    even = F.col("event_id") % 2 == 0
    ax = lambda m, n: [_b64(F.col(a).cast("long").bitwiseAND(m), n) for a in "xyz"]
    b = _b64(F.round(F.col("batt") * 100).cast("long") - 200, 2)
    p = F.when(even, F.concat(_b64(F.col("node_id"), 1), *ax(4095, 2), b)).otherwise(F.concat(_b64(F.col("node_id"), 1), *ax(65535, 3), b))
    d = i.readings.filter(GOOD)
    m = d.select(F.col("event_id").alias("inbox_id"), F.concat(_name(), F.lit("*"), F.when(even, _b64(F.lit(11), 2)).otherwise(_b64(F.lit(51), 2)), F.lit("*"), p, F.lit("*"), _stamp()).alias("msg"), "ts")
    return D.decode_b64(_text(m))[0]


@query("decode_base64_temperature", "M7", f"SELECT event_id AS inbox_id, {NAME5} AS tsm_name, {MIN} AS ts, node_id, 23 AS type_num, CASE WHEN 1000 + z >= 1022 THEN 0 ELSE 1000 + z END AS temp_val FROM {{readings}} WHERE {GOOD}")
def _(i):
    p = F.concat(_b64(F.col("node_id"), 1), _b64(F.col("z") + 1000, 2))
    m = i.readings.filter(GOOD).select(F.col("event_id").alias("inbox_id"), F.concat(_name(), F.lit("*"), _b64(F.lit(23), 2), F.lit("*"), p, F.lit("*"), _stamp()).alias("msg"), "ts")
    return D.decode_b64(_text(m))[1]


@query("decode_tilt_vector_hex", "M13", f"SELECT event_id AS inbox_id, {MIN} AS ts, n AS node_id, x AS ac_x, y AS ac_y, z AS ac_z, 7 AS temp, 0 AS taps, 18.75::DOUBLE AS temp_rtc FROM {{readings}} CROSS JOIN (VALUES (0), (1)) AS v(n)")
def _(i):
    h = lambda a: _hex(F.col(a).cast("long").bitwiseAND(65535), 4)
    v = F.concat_ws(",", h("x"), h("y"), h("z"), *[F.lit("0001")] * 6, F.lit("0007"))
    m = i.readings.select(
        F.col("event_id").alias("inbox_id"), F.concat(F.lit("SINNB*0:"), v, F.lit(",;1:"), v, F.lit(";0,18.75,4.14*"), _stamp()).alias("msg"), "ts"
    )
    return D.decode_tilt_vector_v2(_text(m)).select("inbox_id", "ts", "node_id", "ac_x", "ac_y", "ac_z", "temp", "taps", "temp_rtc")


# --- plain formats -----------------------------------------------------------


@query("decode_extensometer", "M12", f"SELECT inbox_id, 'kodxb' AS extensometer_name, {SEC} AS ts, CAST({V} AS DOUBLE) AS lag, {K} + 0.25::DOUBLE AS abs_max_val, CAST(inbox_id % 3000 AS DOUBLE) AS abs_max_index, 17.75::DOUBLE AS temp_val FROM {M} WHERE {_of(0)}")
def _(i):
    return D.decode_extensometer(_routed(i, "extensometer"))


@query("decode_lidar", "M12,M13", f"SELECT inbox_id, 'kodlc' AS lidar_name, {SEC} AS ts, {V} + 0.75::DOUBLE AS dist, 12.5::DOUBLE AS voltage, 90.25::DOUBLE AS current, 19.5::DOUBLE AS temp_val, {K} + 0.5::DOUBLE AS ac_x, 0.125::DOUBLE AS ac_y, -0.5::DOUBLE AS ac_z, 7.5::DOUBLE AS mg_x, 8.5::DOUBLE AS mg_y, 9.5::DOUBLE AS mg_z, 2.25::DOUBLE AS gr_x, 3.25::DOUBLE AS gr_y, CAST({K} AS DOUBLE) AS gr_z FROM {M} WHERE {_of(1)}")
def _(i):
    return D.decode_lidar(_routed(i, "lidar"))


@query("decode_logger_volts", "M8", f"SELECT inbox_id, 'varsa' AS tsm_name, {MIN} AS ts, CAST(s AS INT) AS stat, CASE s WHEN 0 THEN 1.25 WHEN 1 THEN 88.5 ELSE 2.75 END::DOUBLE AS curr_draw, CASE s WHEN 0 THEN 12.5::DOUBLE WHEN 1 THEN CAST('13.' || (10 + inbox_id % 90) AS DOUBLE) ELSE 11.75::DOUBLE END AS batt_volt FROM {M} CROSS JOIN (VALUES (0), (1), (99)) AS v(s) WHERE {_of(2)}")
def _(i):
    return D.decode_diag(_routed(i, "diagnostics"))[0]


@query("decode_unsent", "M8", f"SELECT inbox_id, {MIN} AS ts, CAST({K} AS INT) AS unsent FROM {M} WHERE {_of(2)}")
def _(i):
    return D.decode_diag(_routed(i, "diagnostics"))[1].select("inbox_id", "ts", "unsent")


SENDER = "nm AS (SELECT right(sim_num, 10) AS num, arg_max(logger_id, (date_activated, mobile_id)) AS logger_id FROM {mobiles} GROUP BY 1)"


@query("message_senders", "M10", f"WITH {SENDER} SELECT inbox_id, logger_id FROM {M} m LEFT JOIN nm ON right(m.sim_num, 10) = nm.num")
def _(i):
    return RT.resolve_sender(i.messages, i.mobiles).select("inbox_id", "logger_id")


GAUGES = "(SELECT DISTINCT logger_id, 'G' || logger_id AS gauge_name, CASE WHEN logger_id % 4 = 0 THEN NULL ELSE 0.25::DOUBLE END AS resolution FROM {mobiles})"


def tip_gauges(i):
    return i.mobiles.select("logger_id", F.concat(F.lit("G"), F.col("logger_id").cast("string")).alias("gauge_name"), F.when(F.col("logger_id") % 4 != 0, F.lit(0.25)).alias("resolution")).distinct()


def routers(i):
    return i.spark.sql("SELECT * FROM VALUES ('nodep', 1), ('nodeq', 2) AS t(router_name, logger_id)")


@query("decode_rain_tips", "M9,M10", f"WITH {SENDER} SELECT inbox_id, lower(gauge_name) AS gauge_name, {SEC} AS ts, (inbox_id % 40) * coalesce(resolution, 0.5::DOUBLE) AS rain, 27.5::DOUBLE AS temperature, 61.5::DOUBLE AS humidity, 3.905::DOUBLE AS battery1, 3.955::DOUBLE AS battery2, CAST(inbox_id % 31 AS INT) AS csq FROM {M} m JOIN nm ON right(m.sim_num, 10) = nm.num JOIN {GAUGES} g ON nm.logger_id = g.logger_id WHERE {_of(3)}")
def _(i):
    return D.decode_rain_arq(_routed(i, "rain_arq"), i.mobiles, tip_gauges(i))


@query("decode_rain_fields", "M9", f"SELECT inbox_id, 'kodg' AS gauge_name, {SEC} AS ts, CASE WHEN inbox_id % 20 = 4 THEN {V} + 0.75 ELSE {V} + 0.25 END::DOUBLE AS rain, CASE WHEN inbox_id % 20 = 4 THEN {K} + 0.25 ELSE 18.5 END::DOUBLE AS temperature, 12.61::DOUBLE AS battery1, CAST(inbox_id % 31 AS INT) AS csq FROM {M} WHERE {_of(4, 5)}")
def _(i):
    return D.decode_rain_csv(_routed(i, "rain_csv"))


@query("decode_router_signal", "M14", f"SELECT inbox_id, {SEC} AS ts, CASE r WHEN 'nodep' THEN 1 ELSE 2 END AS logger_id, r AS router_name, CAST(CASE r WHEN 'nodep' THEN {K} ELSE inbox_id % 31 END AS INT) AS rssi_val, CASE r WHEN 'nodep' THEN 2.75::DOUBLE END AS battery FROM {M} CROSS JOIN (VALUES ('nodep'), ('nodeq')) AS v(r) WHERE {_of(6)}")
def _(i):
    return D.decode_rssi(_routed(i, "rssi"), routers(i))


@query("decode_tilt_vector", "M13", f"SELECT inbox_id, 'kodst' AS logger_name, 'F' AS type, {MIN} AS ts, 2.5::DOUBLE AS ac_x, {K} + 0.25::DOUBLE AS ac_y, CAST({V} AS DOUBLE) AS temp FROM {M} WHERE {_of(7)}")
def _(i):
    return D.decode_tilt_vector(_routed(i, "tilt_vector")).select("inbox_id", "logger_name", "type", "ts", "ac_x", "ac_y", "temp")


@query("decode_gnss", "M13", f"SELECT inbox_id, 'varub' AS logger_name, {MIN} AS ts, 11.204837561::DOUBLE AS latitude, CAST('124.' || (300000000 + inbox_id % 1000) AS DOUBLE) AS longitude, 318.75::DOUBLE AS msl, 0.0525::DOUBLE AS prec, 21.5::DOUBLE AS temp, CAST('3.' || (10 + inbox_id % 80) AS DOUBLE) AS volt FROM {M} WHERE {_of(8)}")
def _(i):
    return D.decode_gnss(_routed(i, "gnss"))


HEX = "(100 + inbox_id % 900)::VARCHAR"


@query("decode_routed_nodes", "M3,M4,M7,M13", f"""SELECT inbox_id, CASE inbox_id % 20 WHEN 16 THEN 'kodt' WHEN 19 THEN 'kodnb' ELSE 'kodtb' END AS name, CASE inbox_id % 20 WHEN 17 THEN CASE k WHEN 1 THEN 1 ELSE 2 END WHEN 18 THEN CASE k WHEN 1 THEN 1 ELSE 2 END WHEN 19 THEN CASE k WHEN 1 THEN 0 ELSE 1 END ELSE 1 END AS node_id,
        CASE inbox_id % 20 WHEN 16 THEN CAST('0x' || {HEX} AS INT) - CASE WHEN CAST('0x' || {HEX} AS INT) > 1024 THEN 4096 ELSE 0 END WHEN 17 THEN CASE k WHEN 1 THEN CAST('0x' || substr({HEX}, 3, 1) || substr({HEX}, 1, 2) AS INT) - CASE WHEN CAST('0x' || substr({HEX}, 3, 1) || substr({HEX}, 1, 2) AS INT) > 2048 THEN 4096 ELSE 0 END ELSE 266 END WHEN 18 THEN 1024 ELSE 1 END AS x
        FROM {M} CROSS JOIN (VALUES (1), (2)) AS v(k) WHERE {_of(16, 17, 18, 19)} AND (k = 1 OR inbox_id % 20 > 16)""")
def _(i):
    one = lambda d, name: d.select("inbox_id", F.col(name).alias("name"), "node_id", "x")
    m = RT.route(_all(i))
    of = lambda r: m.filter(F.col("route") == r)
    axes = D.decode_tilt_vector_v2(of("tilt_vector_v2")).withColumnRenamed("ac_x", "x")
    return one(D.decode_v1(of("v1"))[0], "tsm_name").unionByName(one(D.decode_v2(of("v2")), "tsm_name")).unionByName(one(D.decode_b64(of("b64"))[0], "tsm_name")).unionByName(one(axes, "logger_name"))


@query("acknowledgements", "M19", f"SELECT inbox_id, inbox_id AS stat_id, CASE inbox_id % 3 WHEN 0 THEN 1 WHEN 1 THEN -1 ELSE 0 END AS alert_status, ts AS ts_ack, 'checked by ' || {K} AS remarks FROM {M} WHERE {_of(9)}")
def _(i):
    return X.extract_acks(_routed(i, "acknowledgement")).select("inbox_id", "stat_id", "alert_status", "ts_ack", "remarks")


@query("quake_bulletins", "M17", f"SELECT inbox_id, make_timestamp(2021, 9, CAST(10 + inbox_id % 19 AS INT), CAST(12 + 1 + inbox_id % 9 AS INT), 40, 0) AS event_ts, 1 + inbox_id % 7 + 0.2::DOUBLE AS magnitude, CAST(10 + inbox_id % 80 AS DOUBLE) AS depth, 11.4::DOUBLE AS latitude, 124.85::DOUBLE AS longitude, 'PIV' AS issuer FROM {M} WHERE {_of(10)}")
def _(i):
    return X.extract_quakes(_routed(i, "earthquake"))


@query("quake_posts", "M17", f"SELECT inbox_id, date_trunc('minute', ts) AS event_ts, 1 + inbox_id % 7 + 0.5::DOUBLE AS magnitude, CAST({K} AS DOUBLE) AS depth, 10.25::DOUBLE AS latitude, 123.75::DOUBLE AS longitude, 'Isla Norte' AS province FROM {M}")
def _(i):
    d = i.messages.withColumn("msg", F.concat(
        F.lit("Earthquake Information Date and Time: "), F.date_format("ts", "dd MMM yyyy - hh:mm a"), F.lit(" Magnitude = "), (F.col("inbox_id") % 7 + 1).cast("string"),
        F.lit(".5 Depth = "), (F.col("inbox_id") % 100).cast("string"), F.lit(" kilometers Location = 10.25N, 123.75E - 023 km S 15 W of Lumbang (Isla Norte)")))
    return X.extract_posts(_text(d))


@query("sync_records", "M20", f"SELECT inbox_id, 'field_survey_logs' AS target, CAST(r AS INT) AS row_no, CASE WHEN r = 0 THEN 'x' || {K} ELSE 'z' END AS first, CASE WHEN r = 0 THEN 'y: noon' ELSE CAST({V} AS VARCHAR) END AS second FROM {M} CROSS JOIN (VALUES (0), (1)) AS v(r) WHERE inbox_id % 20 = 11")
def _(i):
    return X.decode_sync(_routed(i, "unknown")).select("inbox_id", "target", "row_no", F.col("fields")[0].alias("first"), F.col("fields")[1].alias("second"))


@query("sync_rain", "M20", f"SELECT inbox_id, 'tolg' AS gauge_name, {SEC} AS ts, CAST({K} AS DOUBLE) AS rain, CAST(inbox_id % 31 AS INT) AS csq FROM {M} WHERE inbox_id % 5 <> 0")
def _(i):
    name = F.when(F.col("inbox_id") % 5 == 0, "NOGAUGE").otherwise("TOLG")
    d = i.messages.withColumn("msg", F.concat_ws("|?=", name, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), (F.col("inbox_id") % 100).cast("string"), F.lit("18.5"), F.lit("72"), F.lit("3.9"), F.lit("4.0"), (F.col("inbox_id") % 31).cast("string")))
    g = i.spark.sql("SELECT 'TOLG' AS gauge_name")
    return X.decode_sync_rain(_text(d), g).select("inbox_id", "gauge_name", "ts", "rain", "csq")


@query("decode_piezo", "M11", f"""SELECT inbox_id, 'pugb' AS piezo_name, {MIN} AS ts, {R("CAST('0x' || substr(d, 1, 2) AS INT) * 100 + CAST('0x' || substr(d, 3, 2) AS INT) + CAST('0x' || substr(d, 5, 2) AS INT) * 0.01::DOUBLE", 4)} AS frequency_shift, {R("CAST('0x' || substr(d, 7, 2) AS INT) + CAST('0x' || substr(d, 9, 2) AS INT) * 0.01::DOUBLE", 4)} AS temperature FROM (SELECT *, substr(CAST(1000000000 + (inbox_id * 7919) % 1000000000 AS VARCHAR), 1, 10) AS d FROM {M}) WHERE {_of(15)}""")
def _(i):
    d = D.decode_piezo(_routed(i, "piezo"))
    return d.select("inbox_id", "piezo_name", "ts", clean_round("frequency_shift", 4).alias("frequency_shift"), clean_round("temperature", 4).alias("temperature"))


def sites(i):
    return i.spark.sql("SELECT 'kod' AS site_code, 7 AS site_id")


def _observations(i):
    return X.extract_observations(_routed(i, "observation"), sites(i), at("2024-01-31 00:00:00"))


NTH_IN = NTH.replace("event_id", "inbox_id")
OUTCOME = f"CASE {NTH_IN} % {len(OBSERVATIONS)} " + " ".join(f"WHEN {n} THEN {e}" for n, (e, _) in enumerate(OBSERVATIONS) if e) + " END"


@query("community_observations", "M15", f"SELECT inbox_id, e AS err_code, CASE WHEN e IS NULL THEN 'EVENT' END AS meas_type, CASE WHEN e IS NULL THEN 7 END AS site_id, CASE WHEN e IS NULL THEN make_timestamp(2023, 12, CAST(20 + {NTH_IN} % 9 AS INT), 14, 20, 0) END AS obs_ts, CASE WHEN e IS NULL THEN 'MAKULIMLIM' END AS weather, CASE WHEN e IS NULL THEN 'ROSA BAUTISTA' END AS observer_name FROM (SELECT inbox_id, {OUTCOME} AS e FROM {M} WHERE {_of(13)})")
def _(i):
    return _observations(i).select("inbox_id", "err_code", "meas_type", "site_id", "obs_ts", "weather", "observer_name")


@query("community_measurements", "M15", f"SELECT inbox_id, site_id, obs_ts, marker_name, measurement FROM (SELECT inbox_id, 7 AS site_id, make_timestamp(2023, 12, CAST(20 + {NTH_IN} % 9 AS INT), 14, 20, 0) AS obs_ts, CAST('' || {K} || '.4' AS DOUBLE) AS a, 38.5::DOUBLE AS b FROM {M} WHERE {_of(13)} AND {OUTCOME} IS NULL), LATERAL (SELECT 'C' AS marker_name, a AS measurement UNION ALL SELECT 'D', b)")
def _(i):
    return X.observation_measurements(_observations(i))


# --- pages: every stored page as it is, two in three with a table of events behind its text ---

PAGE_TS = "TIMESTAMP '2020-01-01 00:00:00' + INTERVAL 1 HOUR * CAST(page_id AS INT)"


def _pages(i):
    td = lambda *c: F.concat(*[F.concat(F.lit("<td class='x'><b>"), x.cast("string"), F.lit(" </b></td>")) for x in c])
    p = F.col("page_id")
    ts = at("2020-01-01 00:00:00") + F.make_dt_interval(hours=p.cast("int"))
    cells = td(F.date_format(ts, "dd MMMM yyyy - hh:mm a"), F.lit("10.25"), F.lit("123.75"), (p % 120).cast("double"), ((p % 45 + 30) / 10).cast("double"),
               F.concat(F.lit("023 km S of Town"), (p % 7).cast("string"), F.lit(" (Province"), (p % 9).cast("string"), F.lit(")")))
    # every other table holds two events in one row
    table = F.concat(F.lit("<table><tr><th>Date</th></tr><tr>"), F.when(p % 2 == 0, F.concat(cells, cells)).otherwise(cells), F.lit("</tr></table>"))
    whole = F.concat(F.coalesce("html", F.lit("")), F.when(p % 3 == 0, "").otherwise(table))
    return i.pages.select("page_id", F.explode(F.array(whole)).alias("html"))


@query("html_events", "M18", f"SELECT page_id, {PAGE_TS} AS event_ts, 10.25::DOUBLE AS latitude, 123.75::DOUBLE AS longitude, CAST(page_id % 120 AS DOUBLE) AS depth, (page_id % 45 + 30) / 10.0::DOUBLE AS magnitude, 'Province' || (page_id % 9) AS province, 'Town' || (page_id % 7) AS municipality FROM {{pages}} CROSS JOIN (VALUES (1), (2)) AS v(k) WHERE page_id % 3 <> 0 AND (k = 1 OR page_id % 2 = 0)")
def _(i):
    return X.extract_html_events(_pages(i)).select("page_id", "event_ts", "latitude", "longitude", "depth", "magnitude", "province", "municipality")


@query("html_cells", "M18", "SELECT page_id, CAST(CASE WHEN page_id % 3 = 0 THEN 0 ELSE 1 END AS INT) AS table_rows, CAST(CASE WHEN page_id % 3 = 0 THEN 0 WHEN page_id % 2 = 0 THEN 12 ELSE 6 END AS INT) AS cells FROM {pages}")
def _(i):
    d = _pages(i).select("page_id", X.html_cells().alias("r"))
    return d.select("page_id", F.size("r").alias("table_rows"), F.size(F.flatten("r")).alias("cells"))


# In the wrong table, logger texts meet people's formats only and count as handled; people's texts fit nothing there, but tables for synchronising are read from either.
READ = f"CASE WHEN inbox_id % 13 = 0 THEN CASE WHEN inbox_id % 20 IN (9, 10, 13, 14) THEN -1 ELSE 1 END WHEN inbox_id % 20 = 13 AND {OUTCOME} IS NOT NULL THEN -1 ELSE 1 END"


@query("parse_ledger", "M21", f"SELECT inbox_id, CASE WHEN inbox_id % 20 IN (0, 1, 8) OR {_of(3, 4, 5, 6, 9, 12)} OR source = 'users' AND inbox_id % 20 IN (11, 14) OR source = 'users' AND inbox_id % 13 = 0 THEN 1 ELSE -1 END AS read_status FROM {M}")
def _(i):
    # three decoders only: the rest is handled by rule or not at all
    r = RT.route(_all(i))
    ids = [f(r.filter(F.col("route") == n)).select("inbox_id") for n, f in (("extensometer", D.decode_extensometer), ("lidar", D.decode_lidar), ("gnss", D.decode_gnss))]
    return RT.parse_ledger(r, ids[0].unionByName(ids[1]).unionByName(ids[2]))


@query("sensors_to_evaluate", "M22", f"SELECT {NAME5} AS tsm_name, max({MIN}) + INTERVAL 10 MINUTE AS evaluate_at FROM {{readings}} WHERE {GOOD} GROUP BY 1")
def _(i):
    c = F.col
    p = F.concat(_hex(c("node_id"), 2), F.lit("0B"), _swap(c("x")), _swap(c("y")), _swap(c("z")), _hex(F.round(c("batt") * 100) - 200, 2))
    return RT.sensors_to_evaluate(D.decode_v2(_msgs(i, "*x*", p)))


@query("item_counts", "I14", f"SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS bucket, source, count(*) AS items FROM {M} WHERE status LIKE 'READ%' GROUP BY ALL")
def _(i):
    return RT.count_items(i.messages, "READ")


@query("message_predicates", "F22", f"SELECT inbox_id FROM {M} WHERE (regexp_matches(msg, '(?i)routine|ack') AND msg LIKE '%a%' AND position(CAST(inbox_id % 100 AS VARCHAR) IN msg) > 0) OR status IN ('READ-SUCCESS') AND msg LIKE 'IMU%'")
def _(i):
    k = (F.col("inbox_id") % 100).cast("string")
    return _all(i).filter((F.col("msg").rlike("(?i)routine|ack") & F.col("msg").like("%a%") & F.contains("msg", k)) | (F.col("status").isin("READ-SUCCESS") & F.col("msg").like("IMU%"))).select("inbox_id")
