"""Views over the given tables, one SQL text for both engines.

``{name}`` marks a table or another view and ``each(..)`` repeats a row per
listed value (explode / unnest). Integer arithmetic first and one
division last, so both engines agree bit for bit.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

VIEWS: dict[str, str] = {
    "readings": """SELECT event_id, CAST((user_id - user_id % 10) / 10 AS INT) AS tsm_id, CAST(user_id % 10 AS INT) + 1 AS node_id, ts,
        CAST(CASE WHEN event_id % 29 = 0 THEN 700 WHEN event_id % 41 = 0 THEN 1060 + (event_id * 37) % 60 - 30 - 4096 ELSE 1000 + (event_id * 37) % 60 - 30 END AS INT) AS x,
        CAST(CASE WHEN event_id % 53 = 0 THEN 1500 ELSE (event_id * 53) % 301 - 150 END AS INT) AS y,
        CAST((event_id * 71) % 301 - 150 AS INT) AS z,
        CAST(CASE WHEN event_id % 37 = 0 THEN 120.0 ELSE (300 + event_id % 40) / 100.0 END AS DOUBLE) AS batt FROM {events}""",
    "sensors": """SELECT DISTINCT CAST((user_id - user_id % 10) / 10 AS INT) AS tsm_id, 10 AS number_of_segments, CAST(1.0 AS DOUBLE) AS segment_length,
        CAST((user_id - user_id % 10) / 10 AS INT) % 50 AS site_id FROM {events}""",
    "rain": """SELECT event_id, user_id AS rain_id, ts, CAST(CASE WHEN event_type = 'error' THEN -1.0 ELSE (CAST(floor(value) AS INT) % 40) / 2.0 END AS DOUBLE) AS rain FROM {events}""",
    "tags": """SELECT s_suppkey AS rain_id, CAST('2024-01-02 00:00:00' AS TIMESTAMP) + INTERVAL 1 HOUR * CAST(s_suppkey * 7 % 640 AS INT) AS ts_start, CASE WHEN s_suppkey % 2 = 1 THEN CAST('2024-01-02 06:00:00' AS TIMESTAMP) + INTERVAL 1 HOUR * CAST(s_suppkey * 7 % 640 AS INT) END AS ts_end FROM {supplier}""",
    "sites": """SELECT c_custkey AS site_id, CAST((5000 + (c_custkey * 7919) % 14000) / 1000.0 AS DOUBLE) AS latitude, CAST((118000 + (c_custkey * 10473) % 8000) / 1000.0 AS DOUBLE) AS longitude,
        CAST(100 + (c_custkey % 5) * 25 AS DOUBLE) AS threshold_value, c_mktsegment AS province FROM {customer}""",
    "gauges": """SELECT s_suppkey AS rain_id, CAST((5000 + (s_suppkey * 6151) % 14000) / 1000.0 AS DOUBLE) AS latitude, CAST((118000 + (s_suppkey * 3571) % 8000) / 1000.0 AS DOUBLE) AS longitude, s_suppkey % 7 <> 0 AS active FROM {supplier}""",
    "quakes": """SELECT p_partkey AS eq_id, CAST('1996-01-01 00:00:00' AS TIMESTAMP) + INTERVAL 1 HOUR * CAST(p_partkey * 5 % 8760 AS INT) AS ts, CAST((30 + p_partkey % 45) / 10.0 AS DOUBLE) AS magnitude, CAST(p_partkey % 120 AS DOUBLE) AS depth, CAST((5000 + (p_partkey * 4639) % 14000) / 1000.0 AS DOUBLE) AS latitude,
        CAST((118000 + (p_partkey * 8513) % 8000) / 1000.0 AS DOUBLE) AS longitude FROM {part}""",
    "markers": """SELECT event_id AS data_id, user_id AS marker_id, CAST(user_id % 50 AS INT) AS site_id, ts, CAST((5000 + event_id % 400) / 100.0 AS DOUBLE) AS measurement,
        CASE WHEN event_type = 'view' THEN 'DRS' ELSE 'SMS' END AS data_source FROM {events} WHERE event_type IN ('view', 'click', 'purchase')""",
    "evals": """SELECT event_id, CAST(user_id % 5 AS INT) AS site_id, ts, CAST(CASE WHEN value >= 90 THEN 3 WHEN value >= 50 THEN 2 WHEN value >= 5 THEN 0 ELSE -1 END AS INT) AS alert_level, event_type AS trigger_source FROM {events}""",
    "intervals": """SELECT o_orderkey AS event_id, o_custkey AS site_id, o_orderdate AS ts, CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate + INTERVAL 1 DAY WHEN o_orderkey % 3 = 1 THEN o_orderdate + INTERVAL 12 HOUR ELSE o_orderdate + INTERVAL 30 MINUTE END AS ts_updated,
        CAST(o_orderkey % 4 AS INT) AS alert_level FROM {orders}""",
    "schedule": """SELECT o_orderkey AS release_id, o_custkey AS site_id, CASE WHEN o_orderkey % 4 = 0 THEN o_orderdate + INTERVAL 210 MINUTE WHEN o_orderkey % 4 = 1 THEN o_orderdate + INTERVAL 450 MINUTE WHEN o_orderkey % 4 = 2 THEN o_orderdate + INTERVAL 690 MINUTE ELSE o_orderdate + INTERVAL 930 MINUTE END AS data_ts,
        CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS INT) AS event, CAST(CASE WHEN o_orderkey % 17 = 0 THEN 1 ELSE 0 END AS INT) AS raising, CAST(CASE WHEN o_orderkey % 19 = 0 THEN 1 ELSE 0 END AS INT) AS lowering FROM {orders}""",
    "scores": """SELECT d.doc_id, CAST(d.n_chars AS DOUBLE) AS score, l.quality AS label FROM {documents} d JOIN {labels} l ON d.doc_id = l.doc_id""",
    # --- further dimensions and logs ---
    "accelerometers": """SELECT tsm_id, n AS node_id, a AS accel_number, CAST(CASE WHEN (tsm_id + n + a) % 3 = 0 THEN 0 ELSE 1 END AS INT) AS in_use, CAST(3.05 AS DOUBLE) AS voltage_min, CAST(3.35 AS DOUBLE) AS voltage_max,
        CAST(tsm_id * 100 + n * 2 + a AS BIGINT) AS accel_id
        FROM (SELECT tsm_id, n, each(1, 2) AS a FROM (SELECT tsm_id, each(1, 2, 3, 4, 5, 6, 7, 8, 9, 10) AS n FROM {sensors}) AS s1) AS s2""",
    "node_status": """SELECT DISTINCT CAST((user_id - user_id % 10) / 10 AS INT) AS tsm_id, CAST(user_id % 10 AS INT) + 1 AS node_id, CAST(CASE WHEN user_id % 69 = 0 THEN 4 ELSE 1 END AS INT) AS status, CAST('2024-01-05 00:00:00' AS TIMESTAMP) AS date_identified FROM {events}""",
    "mobiles": """SELECT c_custkey AS mobile_id, '639' || substr(CAST(1000000000 + c_custkey AS VARCHAR(20)), 2, 9) AS sim_num, c_custkey % 100 AS logger_id, CAST('2020-01-01 00:00:00' AS TIMESTAMP) AS date_activated FROM {customer}
        UNION ALL SELECT c_custkey + 1000000 AS mobile_id, '09' || substr(CAST(1000000000 + c_custkey AS VARCHAR(20)), 2, 9) AS sim_num, c_custkey % 100 + 500 AS logger_id, CAST('2022-01-01 00:00:00' AS TIMESTAMP) AS date_activated FROM {customer} WHERE c_custkey % 9 = 0""",
    "roster": """SELECT o_orderdate + INTERVAL 8 HOUR AS ts, min('MT' || CAST(o_custkey AS VARCHAR(20))) AS mt, min('CT' || CAST(o_custkey AS VARCHAR(20))) AS ct FROM {orders} GROUP BY o_orderdate
        UNION ALL SELECT o_orderdate + INTERVAL 20 HOUR AS ts, max('MT' || CAST(o_custkey AS VARCHAR(20))) AS mt, max('CT' || CAST(o_custkey AS VARCHAR(20))) AS ct FROM {orders} GROUP BY o_orderdate""",
    "downtime": """SELECT s_suppkey AS down_id, CAST('1995-01-02 00:00:00' AS TIMESTAMP) + INTERVAL 1 DAY * CAST(s_suppkey * 23 % 2400 AS INT) AS start_ts, CAST('1995-01-02 00:00:00' AS TIMESTAMP) + INTERVAL 1 DAY * CAST(s_suppkey * 23 % 2400 AS INT) + INTERVAL 3 HOUR * CAST(1 + s_suppkey % 9 AS INT) AS end_ts, CAST(s_suppkey % 2 AS INT) AS reported FROM {supplier}""",
    "site_names": """SELECT c_custkey AS site_id, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 'Sitio ' || CAST(c_custkey % 13 AS VARCHAR(20)) END AS sitio, 'Brgy. ' || CAST(c_custkey AS VARCHAR(20)) AS barangay, n_name || CASE WHEN c_nationkey % 2 = 0 THEN ' City' ELSE '' END AS municipality, c_nationkey AS nation
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""",
    "contacts": """SELECT c_custkey AS user_id, c_custkey AS site_id, CASE WHEN c_custkey % 4 = 0 THEN 'lewc' WHEN c_custkey % 4 = 1 THEN 'blgu' WHEN c_custkey % 4 = 2 THEN 'mlgu' ELSE 'plgu' END AS org_name, CAST(CASE WHEN c_custkey % 11 = 0 THEN 2 ELSE NULL END AS INT) AS alert_restriction,
        CASE WHEN c_custkey % 13 = 0 THEN 0 ELSE 1 END AS active, CASE WHEN c_custkey % 6 = 0 THEN 0 ELSE 1 END AS receives, CASE WHEN c_custkey % 29 = 0 THEN 1 ELSE 0 END AS staff FROM {customer}""",
    "sent": """SELECT l_orderkey AS release_id, l_linenumber AS line_id, l_suppkey AS user_id, o_orderdate + INTERVAL 1 HOUR * (l_linenumber * 2) AS ts_sent, CAST(CASE WHEN l_linestatus = 'F' THEN 5 ELSE 0 END AS INT) AS send_status FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "punches": """SELECT o_custkey % 50 AS staff_id, o_orderkey AS punch_id, o_orderdate + INTERVAL 7 HOUR + INTERVAL 1 MINUTE * CAST(o_orderkey % 120 AS INT) AS time_in, o_orderdate + INTERVAL 19 HOUR + INTERVAL 1 MINUTE * CAST(o_orderkey % 150 AS INT) AS time_out FROM {orders}""",
    "evaluations": """SELECT event_id AS eval_id, floor(user_id / 10) AS staff_id, ts, CAST(event_id % 4 AS INT) AS typo, CAST(event_id % 3 AS INT) AS wrong_alert, CAST(event_id % 2 AS INT) AS late_entry, CAST(1 + event_id % 5 AS INT) AS rating_a, CAST(CASE WHEN event_id % 7 = 0 THEN NULL ELSE 1 + event_id % 4 END AS INT) AS rating_b FROM {events}""",
    "reports": """SELECT event_id AS report_id, CASE WHEN event_id % 3 = 0 THEN 'accuracy' WHEN event_id % 3 = 1 THEN 'timeliness' ELSE 'error_logs' END AS type, event_type || CASE WHEN event_id % 5 = 0 THEN '_unknown' ELSE '' END AS metric_name, ts, 'report ' || CAST(event_id AS VARCHAR(20)) AS report_message, value AS execution_time FROM {events}""",
    "marker_history": """SELECT user_id AS marker_id, event_id AS hist_id, ts, CASE WHEN event_type = 'view' THEN 'add' WHEN event_type = 'click' THEN 'rename' WHEN event_type = 'purchase' THEN 'reposition' ELSE 'mute' END AS event, 'M' || CAST(event_id % 26 AS VARCHAR(20)) AS marker_name FROM {events}""",
    "triggers": """SELECT event_id AS trigger_id, CAST(user_id % 50 AS INT) AS site_id, CASE WHEN event_type = 'view' THEN 'rainfall' WHEN event_type = 'click' THEN 'subsurface' WHEN event_type = 'purchase' THEN 'surficial' WHEN event_type = 'error' THEN 'earthquake' ELSE 'on demand' END AS trigger_source,
        CAST(event_id % 4 AS INT) AS alert_level, ts, ts + INTERVAL 1 MINUTE * CAST(event_id % 7 * 30 AS INT) AS ts_updated FROM {events}""",
    "alert_status": """SELECT trigger_id, ts_updated - INTERVAL 1 MINUTE * CAST(trigger_id % 7 * 600 AS INT) AS ts_last_retrigger, CAST(trigger_id % 3 - 1 AS INT) AS alert_status, CAST(trigger_id % 40 AS INT) AS user_id FROM {triggers} WHERE trigger_id % 5 = 0""",
    "event_rows": """SELECT event_id, site_id, data_ts, alert_symbol, pub_sym_id, validity, has_markers FROM (SELECT c_custkey AS event_id, c_custkey AS site_id, CAST('1995-01-01 03:30:00' AS TIMESTAMP) + INTERVAL 1 DAY * CAST(c_custkey * 13 % 2300 AS INT) + INTERVAL 4 HOUR * CAST(c_custkey % 4 AS INT) AS data_ts, CASE WHEN c_custkey % 7 = 0 THEN 'E' WHEN c_custkey % 5 = 0 THEN 'm' WHEN c_custkey % 11 = 0 THEN 'D' ELSE 'R' END AS alert_symbol, CAST(2 + c_custkey % 3 AS INT) AS pub_sym_id,
        CAST('1995-01-01 04:00:00' AS TIMESTAMP) + INTERVAL 1 DAY * CAST(c_custkey * 13 % 2300 + 1 + c_custkey % 2 AS INT) + INTERVAL 4 HOUR * CAST(c_custkey % 4 AS INT) AS validity, CAST(CASE WHEN c_custkey % 4 = 0 THEN 0 ELSE 1 END AS INT) AS has_markers FROM {customer}) AS e1
        UNION ALL SELECT c_custkey AS event_id, c_custkey AS site_id, CAST('1995-01-01 08:30:00' AS TIMESTAMP) + INTERVAL 1 DAY * CAST(c_custkey * 13 % 2300 AS INT) + INTERVAL 4 HOUR * CAST(c_custkey % 4 AS INT) + INTERVAL 30 MINUTE * CAST(c_custkey % 7 AS INT) AS data_ts, CASE WHEN c_custkey % 3 = 0 THEN 'M' ELSE 's' END AS alert_symbol, CAST(3 + c_custkey % 2 AS INT) AS pub_sym_id,
        CAST('1995-01-04 04:00:00' AS TIMESTAMP) + INTERVAL 1 DAY * CAST(c_custkey * 13 % 2300 AS INT) + INTERVAL 4 HOUR * CAST(c_custkey % 4 AS INT) AS validity, CAST(CASE WHEN c_custkey % 4 = 0 THEN 0 ELSE 1 END AS INT) AS has_markers FROM {customer}""",
    "seasons": """SELECT c_custkey AS site_id, CAST(m AS INT) AS month, CASE WHEN (c_custkey + m) % 2 = 0 THEN 'wet' ELSE 'dry' END AS season_type FROM (SELECT c_custkey, each(1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12) AS m FROM {customer}) AS s1""",
    "plan": """SELECT * FROM (VALUES ('wet', 2), ('wet', 5), ('dry', 3)) AS p(season_type, iso_week_day)""",
    "releases": """SELECT release_id, site_id, data_ts, event, raising, lowering, 0 AS extended, CAST(1 + release_id % 4 AS INT) AS pub_sym_id FROM {schedule}""",
    "sent_log": """SELECT release_id + 10000000 * k AS sent_id, site_id, site_id AS user_id, data_ts + INTERVAL 10 MINUTE * CAST(release_id % 31 + k * 9 AS INT) AS ts_written FROM (SELECT *, each(0, 1) AS k FROM {schedule} WHERE release_id % 5 <> 0) AS s1""",
    "versions": """SELECT s_suppkey AS tsm_id, 'snr' || CAST(s_suppkey % 40 AS VARCHAR(20)) AS tsm_name, s_suppkey % 35 AS logger_id, CAST('2015-01-01 00:00:00' AS TIMESTAMP) + INTERVAL 1 DAY * CAST(s_suppkey % 50 AS INT) AS date_activated, CASE WHEN s_suppkey % 3 = 0 THEN CAST('2016-01-01 00:00:00' AS TIMESTAMP) + INTERVAL 1 DAY * CAST(s_suppkey AS INT) END AS date_deactivated FROM {supplier}""",
    "public_alerts": """SELECT event_id AS public_id, site_id, ts, ts_updated, alert_level FROM {intervals}""",
}

# --- text messages: one format per event_id % 20, in the wrong table for every thirteenth ---
_S = "CAST({} AS VARCHAR(20))"
_TS = "replace(replace(replace(substr(CAST(ts AS VARCHAR(30)), 3, 17), '-', ''), ':', ''), ' ', '')"
_V, _K, _E = _S.format("CAST(floor(value) AS INT)"), _S.format("event_id % 100"), _S.format("event_id")
_CSQ = _S.format("event_id % 31")
#: Number of a message among those of its format.
NTH = "CAST((event_id - event_id % 20) / 20 AS BIGINT)"
_DEC = f"'dec 2' || {_S.format(f'{NTH} % 9')}"
# Observations in all their outcomes, by error code: read, then what each stage fails on.
OBSERVATIONS = [
    (None, f"'Event kod ' || {_DEC} || ' 2023 2:20pm c ' || {_K} || '.4cm d 38.5cm makulimlim rosa bautista'"),
    (1, f"'Rutine kod ' || {_DEC} || ' 2023 2:20pm c 40.4cm makulimlim rosa bautista'"),
    (2, f"'Event qqq ' || {_DEC} || ' 2023 2:20pm c 40.4cm makulimlim rosa bautista'"),
    (4, "'Event kod dec 2:20pm c 40.4cm makulimlim rosa bautista'"),
    (5, f"'Event kod ' || {_DEC} || ' 2021 2:20pm c 40.4cm makulimlim rosa bautista'"),
    (6, f"'Event kod ' || {_DEC} || ' 2023 2:20pm makulimlim rosa bautista'"),
    (7, f"'Event kod ' || {_DEC} || ' 2023 14:20pm c 40.4cm makulimlim rosa bautista'"),
    (8, f"'Event kod ' || {_DEC} || ' 2023 c 40.4cm makulimlim rosa bautista'"),
    (9, f"'Event kod ' || {_DEC} || ' 2023 9:20pm c 40.4cm makulimlim rosa bautista'"),
    (10, f"'Event kod ' || {_DEC} || ' 2023 2:20pm c 40.4cm rosa bautista'"),
    (11, f"'Event kod ' || {_DEC} || ' 2023 2:20pm c 40.4cm makulimlim rb'"),
]
_AXES = f"0001,0' || {_S.format('100 + event_id % 900')} || ',FFFE,0004,0005,0006,0007,0008,0009,000A"
# (table of origin, text); made up from the descriptions of the formats.
FORMATS = [
    ("loggers", f"'KODXB*U*LA:' || {_V} || '*MX:' || {_K} || '.25*MI:' || {_S.format('event_id % 3000')} || '*TP:17.75*' || {_TS}"),
    ("loggers", f"'KODLC*L*LR:' || {_V} || '.75*BV:12.50*BI:90.25*AC:' || {_K} || '.5,0.125,-0.5*MG:7.5,8.5,9.5*GR:2.25,3.25,' || {_K} || '*TP:19.50*' || {_TS}"),
    ("loggers", f"'VARSA*m* 1.25*12.50*88.50*13.' || {_S.format('10 + event_id % 90')} || '* 2.75*11.75>' || {_K} || '*' || {_TS}"),
    ("loggers", f"'ARQ+' || {_S.format('event_id % 40')} || '+1+3.905+3.955+0.2055+6.120+0.305+900+' || {_CSQ} || '+27.5+61.5+188+' || substr({_TS}, 1, 6) || '/' || substr({_TS}, 7, 6)"),
    ("loggers", f"'KODW,' || substr({_TS}, 3, 2) || '/' || substr({_TS}, 5, 2) || '/' || substr({_TS}, 1, 2) || ',' || substr(CAST(ts AS VARCHAR(30)), 12, 8) || ',7,,' || {_K} || '.25,' || {_V} || '.75,12.61,' || {_CSQ}"),
    ("loggers", f"'KODG,18.5,' || {_V} || '.25,12.61,' || {_CSQ} || ',' || {_TS}"),
    ("loggers", f"'GATEWAY*RSSI,HILL,NODEP,' || {_K} || ',2.75,NODEQ,' || {_CSQ} || ',,NODEX,9,*' || {_TS}"),
    ("loggers", f"'KODST*F*2.5,' || {_K} || '.25,4.5,1,2,3,4,5,6,' || {_V} || ',' || {_TS}"),
    ("loggers", f"'VARUB:11.204837561,124.' || {_S.format('300000000 + event_id % 1000')} || ',318.75,0.0525:21.50,3.' || {_S.format('10 + event_id % 80')} || '*' || {_TS}"),
    ("users", f"'Ack ' || {_E} || CASE WHEN event_id % 3 = 0 THEN ' VALID' WHEN event_id % 3 = 1 THEN ' invalid' ELSE ' Validating' END || ' checked by ' || {_K}"),
    ("users", f"'EQInfo7: ' || {_S.format('10 + event_id % 19')} || 'Sep2021 0' || {_S.format('1 + event_id % 9')} || ':40PM Mw=' || {_S.format('1 + event_id % 7')} || '.2 D=0' || {_S.format('10 + event_id % 80')} || 'km 11.40N, 124.85E - 023km S15W of Lumbang (Isla Norte) <PIV>'"),
    ("users", f"'FieldSurveyLogs:x' || {_K} || '<*>y: noon||z<*>' || {_V}"),
    ("loggers", f"CASE {NTH} % 5 WHEN 0 THEN 'unit registered' WHEN 1 THEN 'now system startup' WHEN 2 THEN 'Manual reset by key' WHEN 3 THEN 'power saving deactivated' ELSE 'sms reset done' END"),
    ("users", f"CASE {NTH} % {len(OBSERVATIONS)} " + " ".join(f"WHEN {n} THEN {t}" for n, (_, t) in enumerate(OBSERVATIONS)) + " END"),
    ("users", f"'kumusta ' || {_K}"),
    ("loggers", f"'PUGBPZ*' || substr({_S.format('1000000000 + (event_id * 7919) % 1000000000')}, 1, 10) || '*' || {_TS}"),
    ("loggers", f"'KODTDUE*01' || {_S.format('100 + event_id % 900')} || '00A0140' || {_S.format('100 + event_id % 900')} || '*' || {_TS}"),
    ("loggers", f"'KODTB*x*010B' || {_S.format('100 + event_id % 900')} || 'A00B0080020B0A10C00D08C*' || {_TS}"),
    ("loggers", f"'KODTB*AL*BQAABACCACQAABACCB*' || {_TS}"),
    ("loggers", f"'KODNB*0:{_AXES},;1:{_AXES};2,20.25,3.95*' || {_TS}"),
]
VIEWS["messages"] = (
    "SELECT event_id AS inbox_id, CASE "
    + " ".join(f"WHEN event_id % 20 = {n} THEN {f}" for n, (_, f) in enumerate(FORMATS))
    + " END AS msg, '639' || substr(CAST(1000000000 + user_id AS VARCHAR(20)), 2, 9) AS sim_num, ts, CASE WHEN event_id % 20 IN ("
    + ", ".join(str(n) for n, (t, _) in enumerate(FORMATS) if t == "users")
    + ") THEN CASE WHEN event_id % 13 = 0 THEN 'loggers' ELSE 'users' END ELSE CASE WHEN event_id % 13 = 0 THEN 'users' ELSE 'loggers' END END AS source, CASE WHEN event_id % 3 = 0 THEN 'READ-SUCCESS' ELSE 'UNREAD' END AS status, user_id, value FROM {events}"
)

_REF = re.compile(r"\{([a-z_]+)\}")
_EACH = re.compile(r"\beach\(([^)]*)\)")


def _needs(names: list[str]) -> list[str]:
    """Views in dependency order."""
    out: list[str] = []

    def visit(n: str) -> None:
        if n in TABLES or n in out:
            return
        for m in _REF.findall(VIEWS[n]):
            visit(m)
        out.append(n)

    for n in names:
        visit(n)
    return out


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, or a view derived from the given tables."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = VIEWS[name].replace("AS TIMESTAMP)", "AS TIMESTAMP_NTZ)")
    text = _EACH.sub(r"explode(array(\1))", text)
    refs = {m: frame(spark, sf_dir, m) for m in set(_REF.findall(text))}
    return spark.sql(text, **refs)


def with_views(body: str) -> str:
    """DuckDB text: the views ``body`` names in braces as CTEs, then ``body``."""
    used = [m for m in dict.fromkeys(_REF.findall(body)) if m not in TABLES]
    ctes = [f"{v} AS ({_EACH.sub(r'unnest([\1])', _REF.sub(r'\1', VIEWS[v]))})" for v in _needs(used)]
    text = _REF.sub(r"\1", body).strip()
    if not ctes:
        return text
    if text[:5].upper() == "WITH ":
        rest = text[5:]
        if rest[:10].upper() == "RECURSIVE ":
            return "WITH RECURSIVE " + ",\n".join(ctes) + ",\n" + rest[10:]
        return "WITH " + ",\n".join(ctes) + ",\n" + rest
    return "WITH " + ",\n".join(ctes) + "\n" + text
