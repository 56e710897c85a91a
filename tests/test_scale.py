"""Plans and states that must not grow with the tables."""

import datetime

from pyspark.sql import functions as F

from hillwarden.functions.geo import haversine
from hillwarden.plans import earthquake as Q, releases as RE
from hillwarden.streaming import streams as ST


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_routine_schedule_broadcasts_the_calendar_only(spark):
    seasons = spark.range(40).select(F.col("id").alias("site_id"), F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month")).withColumn("season_type", F.when((F.col("site_id") + F.col("month")) % 2 == 0, "wet").otherwise("dry"))
    plan = spark.createDataFrame([("wet", 2), ("wet", 5), ("dry", 3), ("dry", 3)], "season_type string, iso_week_day int")
    d = RE.routine_schedule(seasons, plan, "1997-05-01", "1997-06-30")
    # with 12 rows a site the seasons look smaller to Spark than they are
    text = _plan(d)
    assert "SortMergeJoin" not in text and "BroadcastHashJoin [month" in text
    join = next(x for x in text.splitlines() if "BroadcastHashJoin [month" in x)
    assert "BuildRight" in join
    rows = d.groupBy("site_id").count().collect()
    # May wet and June dry, or the other way round; a plan row that comes twice counts twice
    days = lambda month, *week: sum(1 for k in range(1, 32) if (month, k) != (6, 31) and datetime.date(1997, month, k).isoweekday() in week)
    assert len(rows) == 40 and {r["count"] for r in rows} == {days(5, 2, 5) + 2 * days(6, 3), 2 * days(5, 3) + days(6, 2, 5)}


def test_crowds_on_both_sides_of_a_cell_are_split(spark):
    near = lambda n, name: spark.range(n).select(F.col("id").alias(name), (F.lit(12.0) + F.col("id") * 1e-5).alias("latitude"), F.lit(121.0).alias("longitude"))
    quakes, sites = near(600, "eq_id"), near(400, "site_id").withColumn("__cell", F.lit(1))
    p, r = Q._shared(quakes.withColumn("__cell", F.lit(1)), sites, 50)
    on = ["__cell", "__share", "__lot"]
    assert max(c["count"] for d in (p, r) for c in d.groupBy(*on).count().collect()) < 120  # hashed, so about 50
    met = p.select("eq_id", *on).join(r.select("site_id", *on), on)
    assert met.count() == met.select("eq_id", "site_id").distinct().count() == 600 * 400
    assert p.rdd.getNumPartitions() >= int(spark.conf.get("spark.sql.shuffle.partitions"))
    got = Q.within_radius(quakes, sites.drop("__cell"), F.lit(5.0), crowd=50)
    assert got.count() == 600 * 400


def test_the_radius_join_copies_a_row_only_where_it_can_meet(spark, monkeypatch):
    place = lambda n, name, k: spark.range(n).select(F.col("id").alias(name), (F.pmod(F.col("id") * 37 * k, F.lit(1800)) / 10 - 90).alias("latitude"), (F.pmod(F.col("id") * 101 * k, F.lit(3600)) / 10 - 180).alias("longitude"))
    quakes, sites = place(300, "eq_id", 7).withColumn("km", F.element_at(F.array(*map(F.lit, (30.0, 400.0, 2500.0, 21000.0))), (F.col("eq_id") % 4 + 1).cast("int"))), place(400, "site_id", 11)
    seen = []
    shared = Q._shared
    monkeypatch.setattr(Q, "_shared", lambda p, r, crowd: seen.extend((p, r)) or shared(p, r, crowd))
    got = {(x.eq_id, x.site_id) for x in Q.within_radius(quakes, sites, F.col("km")).collect()}
    far = haversine("latitude", "longitude", "a", "b")
    want = quakes.crossJoin(sites.select("site_id", F.col("latitude").alias("a"), F.col("longitude").alias("b"))).filter(far <= F.col("km"))
    assert got == {(x.eq_id, x.site_id) for x in want.collect()} and len(got) > 30_000
    p, r = seen
    assert r.count() == 4 * 400  # one for each size of cell that a quake picks
    assert p.count() < 0.5 * 27 * 300
    assert not [c for c in p.columns + r.columns if c[:3] in ("__p", "__r")]


def test_all_quakes_meet_all_sites_without_a_shuffle_of_pairs(spark):
    rows = [(1, 6.0, 10.0, 12.0, 121.0), (1, 6.0, 10.0, 12.0, 121.0), (1, 6.0, 10.0, 12.5, 121.0), (2, 3.0, None, -40.0, -60.0), (3, 5.0, 4.0, None, 121.0)]
    quakes = spark.createDataFrame(rows, "t long, magnitude double, depth double, latitude double, longitude double").withColumn("ts", F.timestamp_seconds("t"))
    sites = spark.createDataFrame([(7, 12.0, 121.0), (7, 12.5, 121.0), (8, 12.25, 121.0), (None, 50.0, 10.0)], "site_id long, latitude double, longitude double")
    km = lambda a, b: F.round(F.lit(2 * 6371.0) * F.asin(F.sqrt(sum((F.pow(F.sin(F.radians(F.col(f"{b}.latitude") - F.col(f"{a}.latitude")) / 2), 2), F.cos(F.radians(f"{a}.latitude")) * F.cos(F.radians(f"{b}.latitude")) * F.pow(F.sin(F.radians(F.col(f"{b}.longitude") - F.col(f"{a}.longitude")) / 2), 2)), F.lit(0.0)))), 3)
    want = quakes.alias("q").crossJoin(sites.alias("s")).select("q.ts", "s.site_id", "q.magnitude", "q.depth", km("q", "s").alias("distance")).distinct()
    want = {(r.ts, r.site_id, r.magnitude, r.depth, r.distance) for r in want.collect()}
    for crowd in (1024, 1):  # places of a key in one row, or as rows
        got = Q.quake_site_distance(quakes, sites, crowd=crowd)
        noted = [(r.ts, r.site_id, r.magnitude, r.depth, r.distance) for r in got.collect()]
        assert len(noted) == len(set(noted)) == len(want) and set(noted) == want
        assert all(r.hypocentral == (None if None in (r.distance, r.depth) else round((r.distance**2 + r.depth**2) ** 0.5, 3)) for r in got.collect())
    assert max(r[4] for r in want if r[4] is not None) > 10_000


def test_waiting_rows_are_kept_by_segment(spark, tmp_path, monkeypatch):
    start = F.lit(1_700_000_000)
    d = spark.range(1200).select((F.col("id") % 2).cast("int").alias("id"), F.timestamp_seconds(start + F.pmod(F.col("id") * 611, F.lit(1200)) * 3600).alias("ts"))
    d.write.parquet(f"{tmp_path}/in")  # a row an hour, out of order, each in a minute of its own

    def run(name, held, segment, batches):
        monkeypatch.setattr(ST, "HELD", held, raising=False)
        monkeypatch.setattr(ST, "SEGMENT", segment, raising=False)
        q = ST.cooldown_stream(ST.file_stream(spark, f"{tmp_path}/in", "id int, ts timestamp", batches), "id", 24, "60 days")
        q.writeStream.format("parquet").option("path", f"{tmp_path}/{name}/out").option("checkpointLocation", f"{tmp_path}/{name}/ck").trigger(availableNow=True).start().awaitTermination()
        return spark.read.format("statestore").option("stateVarName", "wait").load(f"{tmp_path}/{name}/ck").count()

    assert run("whole", 200_000, 2_000, 100) == 2  # a segment a key, not a state entry a minute
    many = run("cut", 50, 7, 1)
    assert many > 100
    end = spark.range(1).select(F.lit(-1).alias("id"), F.timestamp_seconds(start + 400 * 86_400).alias("ts"))
    end.write.mode("append").parquet(f"{tmp_path}/in")
    assert run("whole", 200_000, 2_000, 100) == run("cut", 50, 7, 1) == 1  # the last row waits
    got = [sorted(spark.read.parquet(f"{tmp_path}/{n}/out").selectExpr("id", "CAST(unix_seconds(ts) - 1700000000 AS INT) / 3600 AS h").collect()) for n in ("whole", "cut")]
    assert got[0] == got[1]
    hours = {k: sorted((i * 611) % 1200 for i in range(1200) if i % 2 == k) for k in (0, 1)}
    want = []
    for k, all_hours in hours.items():
        last = None
        for h in all_hours:
            if last is None or h > last + 24:
                want.append((k, float(h)))
                last = h
    assert [tuple(r) for r in got[0]] == want


def test_replayed_rows_land_in_files_of_bounded_size(spark, tmp_path, monkeypatch):
    from hillwarden.catalog import stream_queries as SQ
    from hillwarden.catalog.registry import Inputs

    monkeypatch.setattr(SQ, "FILE_ROWS", 100, raising=False)
    monkeypatch.setattr(SQ, "_scratch", lambda spark: f"{tmp_path}/replay")
    spark.range(1000).select(F.col("id").alias("event_id"), (F.col("id") % 3).alias("user_id"), (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("ts")).write.parquet(f"{tmp_path}/events.parquet")
    got = SQ.replay_all(Inputs(spark, str(tmp_path)), lambda s: s.select("user_id", "ts"), lambda s: ST.event_session_stream(s, ["user_id"]))
    assert sorted((r.user_id, r.n) for r in got.collect()) == [(0, 334), (1, 333), (2, 333)]
    sizes = [r["count"] for r in spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/replay/in").groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) >= 11 and max(sizes) <= 100


def _grid(spark, rows):
    d = spark.createDataFrame(rows, "tsm_id int, node_id int, slot int, xz double")
    return d.select("tsm_id", "node_id", (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("slot") * 30)).alias("ts"), "xz", F.col("xz").alias("xy"))


def test_line_fit_updates_columns_and_rounds_as_regressions_do(spark):
    from pyspark.sql import Window as W

    from hillwarden.operators import kinematics as K

    d = _grid(spark, [(1, n, k, None if n == 2 and k % 11 == 0 else round((k * 7919 * (n + 1) % 401 - 200) / 1e4, 4)) for n in range(3) for k in range(400)])
    w = W.partitionBy("tsm_id", "node_id").orderBy("ts")
    frame = w.rowsBetween(-6, 0)
    want = d.withColumn("x", F.row_number().over(w).cast("double"))
    line = F.regr_slope("xz", "x").over(frame) * F.col("x") + F.regr_intercept("xz", "x").over(frame)
    want = want.withColumn("want", F.when(F.count("xz").over(frame) == 7, F.round(line, 4) + F.lit(0.0))).select("tsm_id", "node_id", "ts", "want")
    got = K.linreg_displacement(d, ["tsm_id", "node_id"], "xz")
    assert got.columns == [*d.columns, "predicted", "displacement"] and "regr" not in _plan(got)
    both = got.join(want, ["tsm_id", "node_id", "ts"])
    assert both.count() == 1200 and both.filter("NOT predicted <=> want").count() == 0


def test_rank_correlation_rides_along_without_copies_or_joins(spark):
    from hillwarden.operators import kinematics as K
    from hillwarden.plans import subsurface as P

    d = _grid(spark, [(1, n, k, (k * 37 % 101) / 100) for n in range(3) for k in range(200)])
    plan = _plan(K.rolling_spearman(d, "xz", 20))
    assert "Generate" not in plan and plan.count("Exchange") == 1
    plan = _plan(P.resultant_alerts(d))
    assert "Join" not in plan and plan.count("Exchange") == 1


def test_drift_weeks_sorts_readings_and_not_empty_slots(spark):
    from hillwarden.plans import subsurface as P

    d = _grid(spark, [(1, 1, k * 50, 1000.0) for k in range(200)]).select("tsm_id", "node_id", "ts", F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), F.col("xz").alias("z"))
    lines = _plan(P.drift_weeks(d, ["tsm_id", "node_id"])).splitlines()
    at = next(i for i, x in enumerate(lines) if "Generate" in x)
    above = [x for x in lines[:at] if "Window " in x]
    assert above and all("slot" in x for x in above)  # six-hour rows only
    assert any("Window " in x for x in lines[at:])


def test_pairs_of_sites_and_gauges_are_not_sorted(spark):
    points = lambda n, name, a, b: spark.range(n).select(F.col("id").alias(name), (10 + F.col("id") * a % 997 / 997).alias("latitude"), (120 + F.col("id") * b % 991 / 991).alias("longitude"))
    sites = points(300, "site_id", 379, 613).unionByName(points(40, "site_id", 0, 0).withColumn("site_id", F.col("site_id") + 1000))
    gauges = points(500, "rain_id", 211, 757).unionByName(points(60, "rain_id", 0, 0).withColumn("rain_id", F.col("rain_id") + 1000)).withColumn("active", F.col("rain_id") % 5 != 0)
    far = spark.createDataFrame([(5000, -45.0, -60.0), (5001, None, 1.0)], "site_id long, latitude double, longitude double")
    sites = sites.unionByName(far)
    got = Q.nearest_gauges(sites, gauges, crowd=16)
    assert "slice(" in _plan(got)  # each site keeps its few before rows are ranked
    pairs = sites.filter("latitude IS NOT NULL").crossJoin(gauges.filter("active").select("rain_id", F.col("latitude").alias("a"), F.col("longitude").alias("b")))
    best = pairs.withColumn("d", Q.haversine("latitude", "longitude", "a", "b")).groupBy("site_id").agg(F.slice(F.sort_array(F.collect_list(F.struct("d", "rain_id"))), 1, 4).alias("l"))
    want = {(r.site_id, k + 1): x.rain_id for r in best.collect() for k, x in enumerate(r.l)}
    assert {(r.site_id, r["rank"]): r.rain_id for r in got.collect()} == want and len(want) == 341 * 4


def test_expanding_steps_keep_their_tasks(spark):
    from hillwarden.functions.scan import spread

    d = spread(spark.range(1000).withColumn("k", F.col("id") % 100), "k")
    assert d.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism
