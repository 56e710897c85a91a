"""Thresholds, boundaries and parity with small pandas / numpy versions."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from hillwarden.functions.clock import half_hour, release_time
from hillwarden.operators import intervals as I, kinematics as K, series as S
from hillwarden.plans import surficial as SU


def _ts(spark, rows, schema):
    d = spark.createDataFrame(rows, schema)
    return d.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def test_release_slot_is_strictly_after(spark):
    d = _ts(spark, [("2024-01-01 04:00:00",), ("2024-01-01 03:59:59",), ("2024-01-01 23:00:00",)], "ts string")
    got = [(str(r.a), str(r.b)) for r in d.select(release_time("ts").alias("a"), half_hour("ts").alias("b")).collect()]
    assert got == [
        ("2024-01-01 08:00:00", "2024-01-01 04:00:00"), ("2024-01-01 04:00:00", "2024-01-01 03:30:00"), ("2024-01-02 00:00:00", "2024-01-01 23:00:00"),
    ]


def test_merge_gap_is_inclusive(spark):
    rows = [(1, "2024-01-01 00:00:00", 2), (1, "2024-01-01 01:30:00", 2), (1, "2024-01-01 03:00:01", 2), (1, "2024-01-01 03:30:00", 3), (1, "2024-01-01 23:50:00", 3), (1, "2024-01-02 00:20:00", 3)]
    m = I.merge_alerts(_ts(spark, rows, "k int, ts string, lv int"), ["k"], "lv").orderBy("ts").collect()
    assert [(str(r.ts), str(r.ts_updated), r.lv) for r in m] == [
        ("2024-01-01 00:00:00", "2024-01-01 01:30:00", 2), ("2024-01-01 03:00:01", "2024-01-01 03:00:01", 2),
        ("2024-01-01 03:30:00", "2024-01-01 03:30:00", 3), ("2024-01-01 23:50:00", "2024-01-02 00:20:00", 3),
    ]


def test_marker_thresholds(spark):
    def level(move, hours):
        rows = [(1, 9, 1, "2024-01-01 00:00:00", 50.0), (1, 9, 2, str(pd.Timestamp("2024-01-01") + pd.Timedelta(hours=hours)), 50.0 + move)]
        d = _ts(spark, rows, "site_id int, marker_id int, data_id int, ts string, measurement double")
        return {r.data_id: r.alert_level for r in SU.recompute_markers(d).collect()}[2]

    assert level(0.99, 1) == 0
    assert level(1.0, 4) == 2  # exactly 0.25 cm / h, too few points for a trend test
    assert level(1.0, 4.1) == 0
    assert level(1.8, 1) == 3
    assert level(1.79, 1) == 2


def test_rolling_spearman_matches_ranks(spark):
    rng = np.random.default_rng(3)
    t = pd.date_range("2024-01-01", periods=700, freq="30min")
    v = np.round(np.cumsum(rng.normal(size=700)), 0)
    pdf = pd.DataFrame({"tsm_id": 1, "node_id": 1, "ts": t.astype(str), "xz": v})
    d = spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = K.rolling_spearman(d, "xz", 144).orderBy("ts").toPandas()["rho"].to_numpy(float)
    want = np.full(700, np.nan)
    for e in range(143, 700):
        w = pd.Series(v[e - 143 : e + 1])
        want[e] = np.corrcoef(w.rank(), np.arange(144))[0, 1] if w.nunique() > 1 else np.nan
    np.testing.assert_allclose(got, want, atol=2e-6, equal_nan=True)


def test_right_closed_bins(spark):
    rows = [(1, "2024-01-01 00:30:00", 1.0), (1, "2024-01-01 00:30:01", 2.0), (1, "2024-01-01 01:00:00", 4.0)]
    r = S.resample_sum_right(_ts(spark, rows, "k int, ts string, v double"), ["k"], "v").orderBy("ts").collect()
    assert [(str(x.ts), x.v) for x in r] == [("2024-01-01 00:00:00", 1.0), ("2024-01-01 00:30:00", 6.0)]


def test_drift_needs_four_weeks_one_way(spark):
    from hillwarden.plans.subsurface import drifting

    def weeks(node, days, signs):
        return [(1, node, f"2024-01-{d:02d}" if d <= 31 else f"2024-02-{d - 31:02d}", s * 1e-4) for d, s in zip(days, signs)]

    rows = weeks(1, [7, 14, 21, 28, 35], [1] * 5) + weeks(2, [7, 14, 21, 28, 35], [1, 1, -1, 1, 1]) + weeks(3, [7, 14, 35, 42], [1] * 4)
    d = spark.createDataFrame(rows, "tsm_id int, node_id int, w string, vel double").withColumn("week_end", F.to_date("w"))
    r = drifting(d, ["tsm_id", "node_id"]).collect()
    assert [(x.node_id, str(x.since), str(x.until), x.weeks) for x in r] == [(1, "2024-01-07", "2024-02-04", 5)]


def test_drift_weeks_of_twelve_weeks_at_the_default_thresholds(spark):
    import numpy as np
    import pandas as pd

    from hillwarden.plans.subsurface import drift_weeks, drifting

    rng, start, rows = np.random.default_rng(3), pd.Timestamp("2024-01-03 05:10:00"), []
    for node, bend in ((1, 2.5e-6), (2, 0.0), (3, 4e-6)):
        for i in range(12 * 7 * 48):
            size = 1024 * (1 + bend * (i / 12) ** 2 + 2e-5 * rng.standard_normal())
            if i == 0 or i > 12 * 7 * 48 - 4 or rng.random() < 0.01:
                size = 5000.0 if node == 3 or i % 2 else 200.0  # out of range
            elif rng.random() < 0.01:
                size += 150  # outlier
            if rng.random() > (0.8 if 1000 < i < 2000 else 0.05) or i == 0:
                rows.append((9, node, str(start + pd.Timedelta(minutes=30 * i)), -4000.0, 0.0, float(size)))
                if i % 7 == 0:
                    rows.append((9, node, str(start + pd.Timedelta(minutes=30 * i + 9)), 0.0, 0.0, 1024.0))
    want = []
    for node in (1, 2, 3):  # the steps of the rule, in pandas
        d = pd.DataFrame([r[2:] for r in rows if r[1] == node], columns=["ts", "x", "y", "z"])
        d = d.set_index(pd.to_datetime(d.pop("ts"))).resample("30min").first()
        d["i"] = np.arange(1.0, len(d) + 1)
        d[["x", "y", "z"]] = d[["x", "y", "z"]].where(lambda v: ~(v < -2048), lambda v: v + 4096)
        d["mag"] = np.sqrt((d[["x", "y", "z"]] / 1024).pow(2).sum(axis=1, skipna=False))
        n = d.mag.resample("W").count()
        d[(d.mag > 3) | (d.mag < 0.5)] = np.nan
        near = d.mag.rolling(12, center=True)
        d[((d.mag - near.mean()).abs() > 3 * near.std()) & (near.std() != 0)] = np.nan
        h = d.interpolate()[["mag", "i"]].resample("6h").mean()
        h[h.mag.rolling(2).std().shift(-1).rolling(2).mean() > 0.05] = np.nan
        vel = h.mag.diff()
        r2 = pd.Series({k: g.mag.corr(g.i) ** 2 for k, g in h.resample("W")})
        k = pd.DataFrame({"vel": vel.resample("W").mean(), "acc": vel.diff().resample("W").mean(), "n": n, "r2": r2})
        k = k[(k.acc.abs() > 3e-6) & (k.r2 > 0.7) & (k.n >= 84)]
        want += [(node, t.date(), *row) for t, row in zip(k.index, k.itertuples(index=False), strict=True)]
    got = drift_weeks(_ts(spark, rows, "tsm_id int, node_id int, ts string, x double, y double, z double"), ["tsm_id", "node_id"])
    noted = [(r.node_id, r.week_end, r.vel, r.acc, r.n, r.r2) for r in got.orderBy("node_id", "week_end").collect()]
    assert len(want) >= 10 and [r[:2] for r in noted] == [r[:2] for r in want]
    assert np.allclose([r[2:] for r in noted], [r[2:] for r in want], rtol=0, atol=1e-6)
    assert [r.node_id for r in drifting(got, ["tsm_id", "node_id"]).orderBy("node_id").collect()] == [1, 3]


def test_quakes_without_a_finite_magnitude_or_place_raise_nothing(spark):
    from hillwarden.plans import earthquake as Q

    nan = float("nan")
    rows = [(1, "2024-01-01", 6.5, None, 10.0, 120.0), (2, "2024-01-01", nan, 5.0, 10.0, 120.0), (3, "2024-01-01", 6.5, 5.0, float("inf"), 120.0), (4, "2024-01-01", 2.0, 5.0, 10.0, 120.0), (5, "2024-01-01", None, 5.0, 10.0, 120.0)]
    q = _ts(spark, rows, "eq_id int, ts string, magnitude double, depth double, latitude double, longitude double")
    sites = spark.createDataFrame([(7, 10.01, 120.0), (8, -60.0, -30.0)], "site_id int, latitude double, longitude double")
    assert [(r.eq_id, r.site_id) for r in Q.quake_alerts(q, sites).collect()] == [(1, 7)]
    assert {r.eq_id: r.processed for r in Q.mark_processed(q).collect()} == {1: 1, 2: -1, 3: -1, 4: 1, 5: -1}


def test_second_counts_stay_where_they_are_not_calibrated(spark):
    from hillwarden.operators import clean as C

    d = spark.createDataFrame([("a", 1, 10.0, 20.0), ("b", 2, 10.0, 20.0)], "tsm_name string, tsm_id int, mval1 double, mval2 double")
    s = spark.createDataFrame([(1, 2), (2, 3)], "tsm_id int, version int")
    got = {r.tsm_name: (r.mval1, r.mval2) for r in C.soms_calibrate(d, s).collect()}
    assert got["a"][1] is None and got["a"][0] != 10.0 and got["b"] == (10.0, 20.0)


def test_unsent_keeps_sites_without_a_name(spark):
    from hillwarden.plans import releases as R

    m = spark.createDataFrame([(1, 5, None, 9), (2, 6, None, 9)], "release_id int, site_id int, ts_written string, user_id int")
    n = spark.createDataFrame([(5, "north")], "site_id int, site_name string")
    assert {(r.release_id, r.site_name) for r in R.unsent(m, n).collect()} == {(1, "north"), (2, None)}


def test_near_threshold_rows_are_stored_only_where_the_gate_is_open(spark):
    from hillwarden.plans import rainfall as RF

    rows = [(1, 7, 0, 40.0, 50.0, 50.0, 100.0), (2, 7, 0, 40.0, 50.0, 50.0, 100.0), (3, 7, 0, 40.0, 50.0, 50.0, 100.0), (4, 7, 1, 60.0, 120.0, 50.0, 100.0), (5, 7, -1, None, None, 50.0, 100.0), (6, 7, 0, 1.0, 80.0, 50.0, 100.0)]
    summary = spark.createDataFrame(rows, "site_id int, rain_id int, alert_level int, one_day double, three_day double, half_max double, full_max double")
    gate = spark.createDataFrame([(1, True), (2, False), (4, False), (5, True), (6, True)], "site_id int, write boolean")
    got = sorted((r.site_id, r.rain_alert, r.cumulative) for r in RF.stored_codes(summary, gate).collect())
    assert got == [(1, "x", 40.0), (4, "a", 60.0), (4, "b", 120.0), (6, "x", 80.0)]


def test_system_bug_and_contact_grades(spark):
    from datetime import datetime as dt

    from hillwarden.plans import grading as GR

    a, b = dt(2021, 5, 3, 8), dt(2021, 5, 3, 20)
    shifts = spark.createDataFrame([(1, a), (2, a), (1, b), (3, b)], "staff_id int, shift_ts timestamp_ntz")
    releases = spark.createDataFrame([(dt(2021, 5, 3, 20),)], "data_ts timestamp_ntz")  # in the first shift, not the second
    evals = spark.createDataFrame(
        [(1, a, "Yes", None, "A, B"), (2, a, "Yes", "No", "A"), (1, b, "No", None, "NAN EEEE"), (1, dt(2021, 5, 4, 21), "Yes", "Yes", "A")],
        "staff_id int, shift_ts timestamp_ntz, bug_log string, relayed string, contacts string")
    down = spark.createDataFrame([(1, dt(2021, 5, 3, 18), dt(2021, 5, 3, 22), 0), (2, dt(2021, 5, 3, 9), dt(2021, 5, 4, 9), 1)], "down_id int, start_ts timestamp_ntz, end_ts timestamp_ntz, reported int")
    got = {(r.staff_id, r.shift_ts): (r.release, r.system, r.bug, r.contacts) for r in GR.shift_system_grades(shifts, releases, evals, down).collect()}
    assert got == {(1, a): (True, 0.84, 1.0, None), (2, a): (True, 0.84, 0.0, None), (1, b): (False, 0.42, None, 0.0), (3, b): (False, 0.84, None, None)}
