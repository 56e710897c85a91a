"""Stateful streams over batches: ties, microseconds, many waiting rows, devices never heard of, late rows."""

import time

import pytest
from pyspark.sql import functions as F

from hillwarden.streaming import streams as ST


class Feed:
    """A file stream fed batch by batch; rows are (key, seconds, level, tie) after a fixed start."""

    SCHEMA = "id int, ts timestamp_ntz, level int, tie int"

    def __init__(self, spark, folder, build):
        self.spark, self.src, self.out = spark, f"{folder}/src", f"{folder}/out"
        self.rows([]).write.parquet(self.src)
        df = build(ST.file_stream(spark, self.src, self.SCHEMA))
        self.schema = df.schema
        self.query = df.writeStream.format("parquet").option("path", self.out).option("checkpointLocation", f"{folder}/ck").trigger(processingTime="100 milliseconds").start()

    def rows(self, rows):
        d = self.spark.createDataFrame([(r[0], float(r[1]), r[2] if len(r) > 2 else 0, r[3] if len(r) > 3 else 0) for r in rows], "id int, s double, level int, tie int")
        return d.select("id", (F.timestamp_seconds(F.lit(1_700_000_000) + F.round("s", 6).cast("decimal(20,6)"))).cast("timestamp_ntz").alias("ts"), "level", "tie")

    def send(self, rows):
        self.rows(rows).coalesce(1).write.mode("append").parquet(self.src)
        self.query.processAllAvailable()

    def close(self):
        self.send([(-1, 10_000_000)])
        self.query.processAllAvailable()
        self.query.stop()
        start = F.lit(1_700_000_000 * 1_000_000)
        d = self.spark.read.schema(self.schema).parquet(self.out).filter("id <> -1")
        times = [c for c, t in d.dtypes if t == "timestamp"]
        d = d.withColumns({c: (F.unix_micros(c) - start) / 1e6 for c in times})
        return sorted(map(tuple, d.collect()), key=str)


@pytest.fixture
def feed(spark, tmp_path):
    made = []

    def make(build):
        made.append(Feed(spark, tmp_path, build))
        return made[-1]

    yield make
    for f in made:
        f.query.stop()


def test_intervals_keep_microseconds_and_ties(feed):
    f = feed(lambda s: ST.merge_alert_stream(s, "id", "level", "10 minutes", tie="tie"))
    f.send([(1, 0.000001, 2, 5), (1, 0.000002, 3, 1), (2, 60, 1, 9), (2, 60, 2, 3)])  # apart by a microsecond; a tie
    f.send([(1, 500, 3, 1), (1, 100, 3, 1)])  # late, but within the delay
    f.send([(1, 500 + 5400.000001, 3, 1), (2, 30_000, 2, 1)])  # a microsecond over the gap
    assert f.close() == [(1, 1e-06, 1e-06, 2), (1, 2e-06, 500.0, 3), (1, 5900.000001, 5900.000001, 3), (2, 30000.0, 30000.0, 2), (2, 60.0, 60.0, 2)]


def test_cooldown_over_many_waiting_rows_of_one_key(feed):
    f = feed(lambda s: ST.cooldown_stream(s, "id", 24, "40 hours"))
    n = 100_000
    f.send([(1, k * 1.2) for k in range(n)])  # 33 hours, all waiting
    began = time.time()
    f.send([(1, n * 1.2 + 1), (2, 7)])  # touches the minutes of its own rows only
    assert time.time() - began < 30
    assert f.close() == [(1, 0.0), (1, 86401.2), (2, 7.0)]


def test_silence_of_devices_never_heard_of(spark, feed):
    known = spark.createDataFrame([(5, 0.0), (6, 0.0), (7, 3600.0)], "id int, s double").select("id", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("s")).alias("since"))
    f = feed(lambda s: ST.silence_stream(s, "id", 72, "1 hour", known))
    day = 86_400
    f.send([(1, 0), (6, day)])
    f.send([(1, 2 * day), (6, 2 * day)])
    f.send([(1, 3 * day + 3800)])
    got = sorted(map(tuple, spark.read.schema(f.schema).parquet(f.out).collect()), key=str)
    assert [(k, never) for k, _, never in got] == [(5, True)]  # after three days; 7 came an hour later, 6 has sent
    f.send([(1, 3 * day + 7600)])
    assert sorted(k for k, _, never in map(tuple, spark.read.schema(f.schema).parquet(f.out).collect()) if never) == [5, 7]
    f.send([(5, 6 * day)])  # heard after all
    end = f.close()
    assert [(k, t) for k, t, never in end if not never] == [(1, 3.0 * day + 7600), (5, 6.0 * day), (6, 2.0 * day)]


def test_nodes_are_reported_after_three_hours(spark, feed):
    known = spark.createDataFrame([(5,), (6,)], "id int").select("id", F.timestamp_seconds(F.lit(1_700_000_000)).alias("since"))
    f = feed(lambda s: ST.silence_stream(s, "id", 3, "5 minutes", known))
    f.send([(6, 10_000)])
    f.send([(6, 11_200)])
    assert f.query.isActive and spark.read.schema(f.schema).parquet(f.out).count() == 1
    f.send([(6, 20_000), (5, 20_050)])
    assert f.close() == [(5, 20050.0, False), (5, None, True), (6, 20000.0, False)]


def test_late_rows_are_counted(spark, tmp_path, feed):
    late = ST.LateRows(spark, f"{tmp_path}/late")
    spark.streams.addListener(late)
    try:
        f = feed(lambda s: ST.rain_stream(s.select("ts", F.col("id").alias("rain_id"), F.col("level").cast("double").alias("rain"), "tie"), "1 hour", id="tie").withColumnRenamed("rain_id", "id"))
        f.send([(1, 100_000, 1, 1), (1, 100_100, 1, 2)])
        f.send([(1, 1_000, 1, 10), (1, 1_001, 1, 11), (2, 99_000, 1, 12)])  # two late, one inside the hour
        f.send([(1, 2_000, 1, 13)])
        f.send([(1, 3_000, 1, 14), (1, 3_000, 1, 14), (1, 100_200, 1, 2)])  # late twice over; a repeat
        got = f.close()
        for _ in range(50):
            if late.total(str(f.query.id)) >= 5:
                break
            time.sleep(0.2)
        assert late.total(str(f.query.id)) == 5
        assert spark.read.parquet(f"{tmp_path}/late").agg(F.sum("late")).first()[0] == 5
        assert sum(r[2] for r in got) == 3.0
    finally:
        spark.streams.removeListener(late)
