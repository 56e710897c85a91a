"""Rolling rank correlation, resultant levels, curves over bands and reflected gaussian weights against pandas and numpy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hillwarden.operators import kinematics as K, series as S, stats as A
from hillwarden.plans import subsurface as P


def grid(spark, nodes):
    rows = [(1, n, pd.Timestamp("2024-01-01") + pd.Timedelta(minutes=30 * k), float(v)) for n, values in nodes.items() for k, v in enumerate(values)]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["tsm_id", "node_id", "ts", "xz"])).withColumns({"ts": F.col("ts").cast("timestamp_ntz"), "xy": F.col("xz")})


def moving(values, n=144):
    v = pd.Series(values)
    return v.rolling(n).apply(lambda w: np.corrcoef(w.rank(), np.arange(n))[0, 1] if w.nunique() > 1 else np.nan, raw=False)


@pytest.fixture(scope="module")
def nodes():
    rng = np.random.default_rng(2)
    steady = np.cumsum(rng.random(800) * 0.002)
    return {1: np.round(steady, 4), 2: rng.integers(0, 4, 800) / 100, 3: np.zeros(800), 4: np.round(np.cumsum(rng.normal(0, 0.01, 300)), 4), 5: rng.random(100)}


def test_rolling_rank_correlation(spark, nodes):
    got = K.rolling_spearman(grid(spark, nodes), "xz").toPandas()
    for n, values in nodes.items():
        mine = got[got.node_id == n].sort_values("ts").rho.to_numpy()
        assert len(mine) == len(values)
        assert np.allclose(mine, moving(values).to_numpy(), atol=2e-6, equal_nan=True)


def test_resultant_levels(spark, nodes):
    got = P.resultant_alerts(grid(spark, nodes)).toPandas()
    seen = set()
    for n, values in nodes.items():
        mine = got[got.node_id == n].sort_values("ts").reset_index(drop=True)
        steady = (moving(values).abs().round(6) > 0.6).to_numpy()
        for value, limit, level in (("displacement", 0.05, "disp_alert"), ("vel_xz", 0.032, "vel_alert")):
            far = (mine[value].abs() > limit).to_numpy()
            assert (mine[level].to_numpy() == np.where(far & steady, 2, 0)).all()
            seen |= set(mine[level])
    assert seen == {0, 2}
    # displacement: end of the fitted line less its begin, over three days of half hours
    one = got[got.node_id == 1].sort_values("ts").reset_index(drop=True)
    k = 500
    slope, cut = np.polyfit(np.arange(len(nodes[1]))[k - 143 : k + 1], nodes[1][k - 143 : k + 1], 1)
    assert one.displacement.notna().any() and abs(one.displacement[k]) == pytest.approx(abs(slope * 143), rel=0.05)


@pytest.mark.parametrize("scale", [1.0, 1e6])
def test_curve_over_bands(spark, scale):
    rng = np.random.default_rng(4)
    score, label = np.round(rng.beta(2, 5, 4000), 4) * scale, rng.integers(0, 2, 4000)
    df = spark.createDataFrame(pd.DataFrame({"s": score, "y": label})).repartition(3)
    got = A.roc(df, "s", "y").toPandas().sort_values("threshold")
    want = [(t, int(label[score >= t].sum()), int((1 - label[score >= t]).sum())) for t in np.unique(score)]
    assert list(zip(got.threshold, got.tp, got.fp)) == want
    bands = df.select(A.value_bands(df, "s", 8).alias("b")).groupBy("b").count().toPandas()
    assert len(bands) == 8 and bands["count"].max() < 2 * 4000 / 8
    assert A.roc(df.limit(0), "s", "y").count() == 0
    odd = spark.createDataFrame([(float("nan"), 1), (0.5, 0), (None, 1), (0.5, 1)], "s double, y int")
    assert [(r.tp, r.fp) for r in A.roc(odd, "s", "y").orderBy(F.isnan("threshold").desc(), F.desc("threshold")).collect()] == [(1, 0), (2, 1), (3, 1)]


@pytest.mark.parametrize("n,chunk", [(1, 4096), (7, 4096), (40, 4096), (500, 64)])
def test_gaussian_weights_reflect_at_the_ends(spark, n, chunk):
    v = np.random.default_rng(n).random(n)
    df = spark.createDataFrame(pd.DataFrame({"k": 1, "i": np.arange(1, n + 1), "v": v}))
    got = S.gaussian_mean(df, ["k"], "i", "v", chunk=chunk).orderBy("i").toPandas()["mean"].to_numpy()
    w = np.exp(-(np.arange(-19, 20) ** 2) / 18.0)
    ring = np.concatenate([v, v[::-1]])
    want = [sum(w[o + 19] * ring[(i + o) % (2 * n)] for o in range(-19, 20)) / w.sum() for i in range(n)]
    assert np.allclose(got, want, atol=1e-12)


def test_gaussian_weights_copy_few_rows(spark):
    df = spark.range(1, 100_001).select(F.lit(1).alias("k"), F.col("id").alias("i"), (F.col("id") % 7).cast("double").alias("v"))
    from hillwarden.functions.scan import with_halo

    assert with_halo(df, F.col("i"), 4096, 19, 19).count() < 1.1 * 100_000
    plan = S.gaussian_mean(df, ["k"], "i", "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def rows_a_task(df):
    from pyspark.sql import functions as F

    return [r[0] for r in df.groupBy(F.spark_partition_id()).count().select("count").collect()]


def test_keyless_joins_of_one_day_are_spread(spark):
    from hillwarden.operators import intervals as I

    n = 20_000
    day = lambda k: F.expr("TIMESTAMP_NTZ'2024-03-01 00:00:00'") + F.make_dt_interval(secs=k)
    rows = spark.range(n).select(F.col("id").alias("release_id"), day((F.col("id") * 7 % 3600).cast("decimal(18,6)")).alias("data_ts"))  # all within an hour
    down = spark.createDataFrame([(10.0, 600.0), (300.0, 900.0), (900.0, 1000.0), (3000.0, 2000.0), (None, 5.0)], "a double, b double").select(
        day(F.col("a").cast("decimal(18,6)")).alias("start_ts"), day(F.col("b").cast("decimal(18,6)")).alias("end_ts"))
    merged = I.disjoint(down, "start_ts", "end_ts").collect()
    assert sorted((r.end_ts - r.start_ts).total_seconds() for r in merged) == [0.0, 990.0]
    left = I.remove_downtime(rows, down, salts=4)
    gone = [k for k in range(n) if 10 <= k * 7 % 3600 <= 1000 or k * 7 % 3600 == 3000]
    assert left.columns == rows.columns and left.count() == n - len(gone)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert max(rows_a_task(I.remove_downtime(rows, down, salts=16))) < 0.7 * n
        states = spark.range(50).select(day((F.col("id") * 70).cast("decimal(18,6)")).alias("ts"), F.col("id").alias("mt"))
        events = rows.withColumnRenamed("data_ts", "ts")
        got = I.as_of(events, states, [], ["mt"], ["release_id"])
        assert max(rows_a_task(got)) < 0.7 * n
        assert got.filter(F.col("mt") != F.floor((F.col("release_id") * 7 % 3600 - 1) / 70)).filter("release_id * 7 % 3600 BETWEEN 1 AND 3499").count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_town_in_one_cell_is_spread(spark):
    from hillwarden.plans import earthquake as Q

    n = 100_000
    sites = spark.range(n).select(F.col("id").alias("site_id"), (11.0 + F.col("id") % 100 / 1e6).alias("latitude"), (124.0 + F.floor(F.col("id") / 100) / 1e6).alias("longitude"))
    quakes = spark.createDataFrame([(k, 11.5, 124.0 + k / 10, 6.5) for k in range(8)], "eq_id long, latitude double, longitude double, magnitude double").withColumn("ts", F.expr("TIMESTAMP_NTZ'2024-03-01 00:00:00'"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        d = Q.quake_alerts(quakes, sites)
        tasks = rows_a_task(d)
        assert sum(tasks) == 8 * n  # magnitude 6.5 reaches over a hundred kilometres
        assert max(tasks) < 0.25 * sum(tasks)
        few = Q.nearest_gauges(sites.limit(50), sites.select(F.col("site_id").alias("rain_id"), "latitude", "longitude", F.lit(True).alias("active")))
        assert few.filter("rank = 1 AND distance < 0.01").count() == 50 and few.count() == 200
    finally:
        for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"):
            spark.conf.unset(c)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
