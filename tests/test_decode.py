"""Literal messages with known values."""

import pytest
from pyspark.sql import functions as F

from hillwarden.functions.clock import at
from hillwarden.operators import decode_logger as D, decode_text as X, routing as RT


@pytest.fixture(scope="module")
def msgs(spark):
    def make(*texts):
        rows = [(n, t, "639173082161") for n, t in enumerate(texts)]
        return spark.createDataFrame(rows, "inbox_id int, msg string, sim_num string").withColumn("ts", at("2024-01-15 10:00:00"))

    return make


def test_v2_nodes(msgs):
    # id, type, low byte first: 3E8 = 1000 as E83, FF0 = -16 as F0F, 00A = 10 as 0A0; 78 + 200 = 3.20 V
    r = D.decode_v2(msgs("TESTQ*x*020BE83F0F0A0780C0B00400AFFF7A*190312084530")).orderBy("node_id").collect()
    assert [(x.tsm_name, x.node_id, x.type_num, x.x, x.y, x.z, x.batt) for x in r] == [("testq", 2, 11, 1000, -16, 10, 3.20), ("testq", 12, 11, 1024, -1536, -1, 3.22)]
    assert str(r[0].ts) == "2019-03-12 08:45:00"


def test_v2_old_comma_form(msgs):
    r = D.decode_v2(msgs("TESTQ,020BE83F0F0A078,19/03/12084530")).collect()
    assert [(x.node_id, x.x, x.y, x.z) for x in r] == [(2, 1000, -16, 10)]


def test_v2_rejects_cut_messages(msgs):
    assert D.decode_v2(msgs("TESTQ*x*020BE83F0F0A0780C0BE83F0F*190312084530", "TESTQ*x*020BE83F0F0A078*1903")).count() == 0


def test_v1(msgs):
    # 0C = 12, 2BC = 700, FFE = -2, 00F = 15, 01C2 = 450
    tilt, soms = D.decode_v1(msgs("TOLLDUE*0C2BCFFE00F01C2*200605113015", "TOLLDUE"))
    assert [(x.tsm_name, x.node_id, x.x, x.y, x.z, str(x.ts)) for x in tilt.collect()] == [("toll", 12, 700, -2, 15, "2020-06-05 11:30:00")]
    assert soms.collect()[0].mval1 == 450


def test_diagnostics(msgs):
    volt, unsent = D.decode_diag(msgs("TOLSA*m* 1.10*12.40*92.50*12.35*95.00*12.30* 2.20*12.25*220117060000", "TOLSA*m* 1.10*12.40*2.20*12.25>37*220117060000"))
    first = volt.filter("inbox_id = 0").orderBy("stat").collect()
    assert [(r.stat, r.curr_draw, r.batt_volt) for r in first] == [(0, 1.1, 12.4), (1, 92.5, 12.35), (2, 95.0, 12.3), (99, 2.2, 12.25)]
    assert [r.unsent for r in unsent.orderBy("inbox_id").collect()] == [None, 37]


def test_extensometer_needs_a_time_and_keeps_long_values(msgs):
    long = "0" * 60 + "7654"
    r = D.decode_extensometer(msgs(f"TOLXC*U*LA:{long}*MX:81.5*MI:2040*TP:18.25*190920153045", "TOLXC*U*LA:7654*MX:81.5*MI:2040*TP:18.25*1909201")).collect()
    assert [(x.lag, x.abs_max_val, x.abs_max_index, x.temp_val, str(x.ts)) for x in r] == [(7654, 81.5, 2040, 18.25, "2019-09-20 15:30:45")]


def test_rain(spark, msgs):
    text = "ARQ+6+1+3.900+3.950+0.2100+6.010+0.300+900+17+26.5+70.25+190+210930/174501"
    mobiles = spark.createDataFrame([(1, "09173082161", 5, "2020-01-01")], "mobile_id int, sim_num string, logger_id int, date_activated string")
    gauges = spark.createDataFrame([(5, "tolta", 0.25)], "logger_id int, gauge_name string, resolution double")
    r = D.decode_rain_arq(msgs(text, "ARQ+17+26.5+70.25+190+210930/174501"), mobiles, gauges).collect()
    assert [(x.gauge_name, x.rain, x.temperature, x.csq) for x in r] == [("tolta", 1.5, 26.5, 17)]
    assert D.decode_rain_arq(msgs(text), mobiles.withColumn("sim_num", F.lit("1")), gauges).count() == 0
    c = D.decode_rain_csv(msgs("TOLW,03/14/22,21:05:40,7,001,002,3.50,12.75,19", "TOLW,33/14/22,21:05:40,7,001,002,3.50,12.75,19", "TOLW,03/14/22,21:05:40,7")).collect()
    assert [(x.gauge_name, str(x.ts), x.rain, x.csq) for x in c] == [("tolg", "2022-03-14 21:05:40", 3.5, 19)]


def test_quakes(msgs):
    ok = "EQInfo4: 07Nov2019 10:15PM Mb=3.8 D=122km 13.05N, 121.40E - 040km S60W of Lumbang (Isla Norte) <QZ>"
    r = X.extract_quakes(msgs(ok, ok.replace("07Nov2019", "07Nox2019"), ok.replace("Mb=3.8", ""))).collect()
    assert [(str(x.event_ts), x.magnitude, x.depth, x.latitude, x.longitude, x.issuer) for x in r] == [("2019-11-07 22:15:00", 3.8, 122.0, 13.05, 121.4, "QZ")]


@pytest.mark.parametrize(
    "text,code",
    [
        ("Event tol may 14 2021 1:30pm f 12.5cm g 80cm umuulan pedro reyes", None),
        ("Evant tol may 14 2021 1:30pm f 12.5cm umuulan pedro", 1),
        ("Event qqq may 14 2021 1:30pm f 12.5cm umuulan pedro", 2),
        ("Event tol mei 14 1:30pm f 12.5cm umuulan pedro", 4),
        ("Event tol sep 14 2020 1:30pm f 12.5cm umuulan pedro", 5),
        ("Event tol may 14 2021 1:30pm umuulan pedro", 6),
        ("Event tol may 14 2021 15:30pm f 12.5cm umuulan pedro", 7),
        ("Event tol may 14 2021 f 12.5cm umuulan pedro", 8),
        ("Event tol may 14 2021 11:30pm f 12.5cm umuulan pedro", 9),
        ("Event tol may 14 2021 1:30pm f 12.5cm pedro reyes", 10),
        ("Event tol may 14 2021 1:30pm f 12.5cm umuulan pr", 11),
    ],
)
def test_observations(spark, msgs, text, code):
    sites = spark.createDataFrame([("tol", 7)], "site_code string, site_id int")
    r = X.extract_observations(msgs(text), sites, at("2021-05-15 00:00:00")).collect()[0]
    assert r.err_code == code
    if code is None:
        assert (r.meas_type, r.site_id, str(r.obs_ts), r.weather) == ("EVENT", 7, "2021-05-14 13:30:00", "UMUULAN")
        assert [(m.marker_name, m.measurement) for m in r.measurements] == [("F", 12.5), ("G", 80.0)]


def test_observations_keep_long_names_and_weather(spark, msgs):
    sites = spark.createDataFrame([("tol", 7)], "site_code string, site_id int")
    names = " ".join(f"PANGALAN{c}" for c in "ABCDEFGHIJKLMNOP")
    weather = "NAPAKALAKASNAPAGULAN"[:-4] + "NGULANNGAYON"
    r = X.extract_observations(msgs(f"Event tol may 14 2021 1:30pm f 12.5cm {weather} {names}"), sites, at("2021-05-15 00:00:00")).collect()[0]
    assert (r.observer_name, r.weather) == (names, weather) and len(names) > 100 and len(weather) > 20


def test_routes(msgs):
    texts = ["TOLTC*y*020BE83F0F0A078*190312084530", "TOLUA:11.2,124.3,318.75,0.05:21.5,3.9*211121150800", "Ack 12 valid ok", "no data from sensors", "what"]
    assert [r.route for r in RT.route(msgs(*texts)).orderBy("inbox_id").collect()] == ["v2", "gnss", "acknowledgement", "status", "unknown"]
    of = lambda source: [r.route for r in RT.route(msgs(*texts).withColumn("source", F.lit(source))).orderBy("inbox_id").collect()]
    assert of("loggers") == ["v2", "gnss", "unknown", "status", "unknown"]
    assert of("users") == ["unknown", "unknown", "acknowledgement", "unknown", "unknown"]


def test_outcomes(spark, msgs):
    m = msgs("TOLW,not a rain text".replace("not", "12"), "GATEWAY*RSSI,HILL,NOONE,5,1.5*220117060000", "GATEWAY*STATUS,x*220117060000", "Ack 7 nothing said", "GATEWAY", "hello", "hello")
    m = m.withColumn("source", F.when(F.col("inbox_id").isin(3, 6), "users").otherwise("loggers"))
    got = RT.parse_ledger(RT.route(m), spark.createDataFrame([], "inbox_id int")).orderBy("inbox_id").collect()
    # rain texts, signal lists of unknown routers and acknowledgements count as handled; so do people's other texts
    assert [r.read_status for r in got] == [1, 1, -1, 1, -1, -1, 1]
