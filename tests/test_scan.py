"""Chunked scans equal plain windows, also with tiny chunks and one hot key."""

import random

import pandas as pd
import pytest
from pyspark.sql import Window as W, functions as F

from hillwarden.functions.scan import (
    last_before, last_value, max_before, previous, row_index, running_max, running_sum, scan, with_halo,
)


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(7)
    data = []
    for n in range(600):
        key = 0 if n % 3 == 0 else rnd.randrange(1, 20)
        data.append((key, rnd.randrange(0, 400), n, None if rnd.random() < 0.3 else rnd.randrange(-50, 50)))
    return spark.createDataFrame(data, "k int, t int, id int, v int")


@pytest.mark.parametrize("size", [1, 7, 1000])
@pytest.mark.parametrize("reverse", [False, True])
def test_scan_equals_window(rows, size, reverse):
    got = scan(
        rows, ["k"], ["t", "id"],
        {
            "s": running_sum(F.col("v")), "n": row_index(), "m": running_max(F.col("v")), "mb": max_before(F.col("v")),
            "l": last_value(F.col("v")), "lb": last_before(F.col("v")), "p": previous(F.col("v")),
        },
        F.floor(F.col("t") / size), reverse,
    )
    o = [F.col("t").desc(), F.col("id").desc()] if reverse else ["t", "id"]
    w = W.partitionBy("k").orderBy(*o)
    upto, before = w.rowsBetween(W.unboundedPreceding, 0), w.rowsBetween(W.unboundedPreceding, -1)
    want = rows.select(
        "*", F.sum("v").over(upto).alias("s"), F.row_number().over(w).cast("bigint").alias("n"), F.max("v").over(upto).alias("m"),
        F.max("v").over(before).alias("mb"), F.last("v", True).over(upto).alias("l"), F.last("v", True).over(before).alias("lb"), F.lag("v").over(w).alias("p"),
    )
    a = got.select(*want.columns).toPandas().sort_values("id").reset_index(drop=True)
    b = want.toPandas().sort_values("id").reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b, check_dtype=False)


def test_halo_covers_range_frames(rows):
    w = W.partitionBy("k").orderBy("t").rangeBetween(-25, 0)
    want = {r.id: r.n for r in rows.select("id", F.count("v").over(w).alias("n")).collect()}
    d = with_halo(rows, F.col("t"), 40, 25)
    w2 = W.partitionBy("k", "__chunk").orderBy("t").rangeBetween(-25, 0)
    got = {r.id: r.n for r in d.withColumn("n", F.count("v").over(w2)).filter("__own").collect()}
    assert got == want
