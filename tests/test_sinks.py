"""Partitioned upserts, replayed batches, the decoding and enrichment streams."""

import os

import pytest
from pyspark.sql import functions as F

from hillwarden.catalog.message_queries import routers, sites, tip_gauges
from hillwarden.catalog.registry import Inputs
from hillwarden.sources import sinks as SK
from hillwarden.streaming import streams as ST

from conftest import SF


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def rows(spark, path, *cols):
    return sorted(map(tuple, spark.read.parquet(path).select(*cols).collect()), key=str)


def test_upsert_touches_only_partitions_with_updates(spark, tmp_path):
    path, schema = f"{tmp_path}/t", "k int, day string, v int, n int"
    SK.upsert_into(path, spark.createDataFrame([(1, "a", 10, 1), (2, "a", 20, 1), (3, "b", 30, 1), (4, None, 40, 1)], schema), ["k"], "day", "n")
    before = files(path)
    new = spark.createDataFrame([(2, "a", 21, 2), (5, "c", 50, 1), (4, None, 41, 2), (4, None, 41, 2)], schema)
    for _ in range(2):  # twice is as good as once
        SK.upsert_into(path, new, ["k"], "day", "n")
        assert rows(spark, path, "k", "day", "v") == sorted([(1, "a", 10), (2, "a", 21), (3, "b", 30), (4, None, 41), (5, "c", 50)], key=str)
    after = files(path)
    same = {f for f in before if after.get(f) == before[f]}
    assert same == {f for f in before if "day=b" in f} and same
    assert not os.path.exists(f"{tmp_path}/_staged-t")


def test_counters_add_up_in_their_partitions(spark, tmp_path):
    path, schema = f"{tmp_path}/t", "day string, k int, n long"
    SK.accumulate_into(path, spark.createDataFrame([("a", 1, 2), ("b", 1, 5)], schema), ["day", "k"], ["n"], "day")
    before = files(path)
    SK.accumulate_into(path, spark.createDataFrame([("a", 1, 3), ("a", 2, 1)], schema), ["day", "k"], ["n"], "day")
    assert rows(spark, path, "day", "k", "n") == [("a", 1, 5), ("a", 2, 1), ("b", 1, 5)]
    assert {f for f in before if "day=b" in f} <= set(files(path).items() and files(path))
    with pytest.raises(ValueError):
        SK.accumulate_into(path, spark.createDataFrame([("a", 1, 3)], schema), ["k"], ["n"], "day")


def test_a_cut_off_replacement_is_finished(spark, tmp_path):
    path, schema = f"{tmp_path}/t", "k int, day string, v int"
    SK.upsert_into(path, spark.createDataFrame([(1, "a", 1), (2, "b", 2)], schema), ["k"], "day", "v")
    spark.createDataFrame([(1, "a", 7)], schema).write.partitionBy("day").parquet(f"{tmp_path}/_staged-t")  # died before it was installed
    SK.finish(spark, path, "day")
    assert rows(spark, path, "k", "v") == [(1, 7), (2, 2)]
    spark.createDataFrame([(1, "a", 9)], schema).write.partitionBy("day").parquet(f"{tmp_path}/_staged-t")
    os.remove(f"{tmp_path}/_staged-t/_SUCCESS")  # died while staging
    SK.finish(spark, path, "day")
    assert rows(spark, path, "k", "v") == [(1, 7), (2, 2)] and not os.path.exists(f"{tmp_path}/_staged-t")


def known(i):
    return {"mobiles": i.mobiles, "gauges": tip_gauges(i), "routers": routers(i), "sites": sites(i)}


def test_decoding_is_exactly_once_even_if_a_batch_runs_again(spark, tmp_path):
    i, out = Inputs(spark, SF), f"{tmp_path}/out"
    m = i.messages.select("inbox_id", "msg", "sim_num", "ts", "source")
    half = F.col("inbox_id") % 40 < 20
    fam = {k: ST.FAMILIES[k] for k in ("gnss", "extensometer", "status", "lidar")}
    ST.decode_batch(m.filter(half), out, 0, known(i), fam)
    ST.decode_batch(m.filter(~half), out, 1, known(i), fam)
    tables = [*fam, "ledger", "dead_letters"]
    want = {t: rows(spark, f"{out}/{t}", "inbox_id", "batch") for t in tables}
    folders = {t: sorted(os.listdir(f"{out}/{t}")) for t in tables}
    # the batch died after some tables were written, and runs again with one text less in a table that had it alone
    ST.decode_batch(m.filter(~half), out, 1, known(i), fam)
    assert want == {t: rows(spark, f"{out}/{t}", "inbox_id", "batch") for t in tables}
    assert all({x for x in os.listdir(f"{out}/{t}") if x.startswith("day=")} <= {x for x in folders[t]} for t in tables)
    assert len(want["ledger"]) == 1000 and len({k for k, _ in want["ledger"]}) == 1000
    assert len(want["gnss"]) == 46  # of 50, four lie in the wrong table


def test_the_decoding_stream_starts_again_where_it_ended(spark, tmp_path):
    i = Inputs(spark, SF)
    src, out, ck = (f"{tmp_path}/{n}" for n in ("src", "out", "ck"))
    m = i.messages.select("inbox_id", "msg", "sim_num", "ts", "source")
    m.repartition(3).write.parquet(src)
    fam = {k: ST.FAMILIES[k] for k in ("gnss", "extensometer")}
    for _ in range(2):  # the second start finds nothing new
        ST.decode_stream(ST.file_stream(spark, src, m.schema, 1), out, ck, lambda: known(i), fam).awaitTermination()
    assert spark.read.parquet(f"{out}/gnss").count() == 46 and spark.read.parquet(f"{out}/ledger").count() == 1000
    assert spark.read.parquet(f"{out}/ledger").select("batch").distinct().count() == 3
    assert sorted(os.listdir(out)) == ["_routed", "_started", "dead_letters", "extensometer", "gnss", "ledger"]
    dead = spark.read.parquet(f"{out}/dead_letters").count()
    assert dead == spark.read.parquet(f"{out}/ledger").filter("read_status = -1").count() > 0


def test_one_scan_of_the_source_a_batch(spark, tmp_path):
    i = Inputs(spark, SF)
    m = i.messages.select("inbox_id", "msg", "sim_num", "ts", "source")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    ST.decode_batch(m.mapInArrow(count, m.schema), f"{tmp_path}/out", 0, known(i))
    assert seen.value == 1000


def test_senders_registered_between_two_batches_are_known(spark, tmp_path):
    src, reg, out, ck = (f"{tmp_path}/{n}" for n in ("src", "reg", "out", "ck"))
    text = lambda k: spark.createDataFrame([(k, "hi", "+63 917 555 0001", "users")], "inbox_id int, msg string, sim_num string, source string").withColumn("ts", F.expr("TIMESTAMP_NTZ'2024-01-02 03:04:05'"))
    number = lambda k, n, day: spark.createDataFrame([(k, n, 40 + k, day)], "mobile_id int, sim_num string, logger_id int, date_activated string").write.mode("append").parquet(reg)
    text(1).write.parquet(src)
    number(1, "639180000000", "2020-01-01")
    q = ST.enrich_stream(ST.file_stream(spark, src, text(1).schema), lambda: spark.read.parquet(reg), out, ck, processingTime="200 milliseconds")
    try:
        q.processAllAvailable()
        number(2, "09175550001", "2021-01-01")
        text(2).write.mode("append").parquet(src)
        q.processAllAvailable()
        number(3, "639175550001", "2022-01-01")
        text(3).write.mode("append").parquet(src)
        q.processAllAvailable()
    finally:
        q.stop()
    assert rows(spark, f"{out}/enriched", "inbox_id", "logger_id") == [(1, None), (2, 42), (3, 43)]
