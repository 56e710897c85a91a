"""Regular grids, fills, rolling frames and gap ranges.

Input to the grid functions is one row per (keys, slot). A series is then no
longer than its time span divided by the slot, whatever the reading rate, so
windows partitioned by the series key are bounded.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.clock import clean_round, floor_to, right_closed_slot, span
from ..functions.scan import CHUNK, own_rows, spread, with_halo


def _series(keys: Sequence[str], ts: str = "ts"):
    return W.partitionBy(*keys).orderBy(ts)


def resample_ffill(
    df: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    start: Column | None = None,
    end: Column | None = None,
    minutes: int = 30,
) -> DataFrame:
    """Regular grid per series, each slot holding the last row at or before it.

    Every row spreads itself over the slots up to the next row, so no join and
    no fill window is needed. Slots from ``start`` to the first row are NULL.
    ``start`` and ``end`` default to the series' own first and last slot.
    """
    w = _series(keys)
    step = span(mins=minutes)
    d = spread(df, *keys).select(
        *keys, "ts", *cols, F.lead("ts").over(w).alias("__next"), F.lag("ts").over(w).alias("__prev")
    )
    stop = F.coalesce(F.col("__next") - step, F.greatest(end, F.col("ts")) if end is not None else F.col("ts"))
    own = F.transform(
        F.sequence(F.col("ts"), stop, step), lambda s: F.struct(s.alias("ts"), F.lit(True).alias("has"))
    )
    if start is not None:
        lead_in = F.when(
            F.col("__prev").isNull() & (F.col("ts") > start),
            F.transform(
                F.sequence(start, F.col("ts") - step, step),
                lambda s: F.struct(s.alias("ts"), F.lit(False).alias("has")),
            ),
        )
        own = F.concat(F.coalesce(lead_in, F.slice(own, 1, 0)), own)
    return d.select(*keys, *cols, F.explode(own).alias("__s")).select(
        *keys,
        F.col("__s.ts").alias("ts"),
        *[F.when(F.col("__s.has"), F.col(c)).alias(c) for c in cols],
    )


def fill(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Forward fill, then back fill; an all-NULL column becomes zero."""
    w = _series(keys)
    past = w.rowsBetween(W.unboundedPreceding, 0)
    rest = w.rowsBetween(0, W.unboundedFollowing)
    return df.withColumns(
        {
            c: F.coalesce(
                F.last(c, ignorenulls=True).over(past), F.first(c, ignorenulls=True).over(rest), F.lit(0.0)
            )
            for c in cols
        }
    )


def smooth(df: DataFrame, keys: Sequence[str], cols: Sequence[str], n: int = 7, digits: int = 4) -> DataFrame:
    """Trailing mean of ``n`` rows; a series loses its first n - 1 rows."""
    w = _series(keys)
    d = df.select(
        *[c for c in df.columns if c not in cols],
        *[clean_round(F.avg(c).over(w.rowsBetween(1 - n, 0)), digits).alias(c) for c in cols],
        F.row_number().over(w).alias("__n"),
        F.count(F.lit(1)).over(W.partitionBy(*keys)).alias("__rows"),
    )
    return d.filter((F.col("__n") >= n) | (F.col("__rows") == 1)).drop("__n", "__rows")


def resample(df: DataFrame, keys: Sequence[str], minutes: int, aggs: Sequence[Column]) -> DataFrame:
    """Tumbling aggregate per series, labelled with the left edge."""
    return (
        df.withColumn("__slot", floor_to("ts", minutes))
        .groupBy(*keys, "__slot")
        .agg(*aggs)
        .withColumnRenamed("__slot", "ts")
    )


def week_ending_sunday(ts: str = "ts") -> Column:
    """Date of the Sunday closing the week of ``ts``."""
    d = F.to_date(ts)
    return F.date_add(d, 6 - F.weekday(d))


def resample_sum_right(df: DataFrame, keys: Sequence[str], value: str, minutes: int = 30) -> DataFrame:
    """Sum per bin (t, t + minutes], labelled t; only bins with data."""
    return (
        df.withColumn("__slot", right_closed_slot("ts", minutes))
        .groupBy(*keys, "__slot")
        .agg(F.sum(value).alias(value))
        .withColumnRenamed("__slot", "ts")
    )


def grid(df: DataFrame, keys: Sequence[str], cols: Sequence[str], minutes: int = 30) -> DataFrame:
    """Every slot between a series' first and last one; missing slots NULL."""
    w = _series(keys)
    step = span(mins=minutes)
    d = spread(df, *keys).select(*keys, "ts", *cols, F.lead("ts").over(w).alias("__next"))
    slots = F.sequence(F.col("ts"), F.coalesce(F.col("__next") - step, F.col("ts")), step)
    return d.select(*keys, *cols, F.posexplode(slots).alias("__p", "__t")).select(
        *keys,
        F.col("__t").alias("ts"),
        *[F.when(F.col("__p") == 0, F.col(c)).alias(c) for c in cols],
    )


def rolling_sums(df: DataFrame, keys: Sequence[str], value: str, frames: dict[str, int], digits: int = 4) -> DataFrame:
    """Trailing sums over the last n grid rows, NULL where a frame is empty.

    Differences of running totals: the cost does not grow with the frame.
    """
    w = _series(keys)
    upto = w.rowsBetween(W.unboundedPreceding, 0)
    d = df.withColumns({"__p": F.coalesce(F.sum(value).over(upto), F.lit(0.0)), "__c": F.count(value).over(upto)})
    out = {}
    for name, n in frames.items():
        total = F.col("__p") - F.lag("__p", n, 0.0).over(w)
        rows = F.col("__c") - F.lag("__c", n, 0).over(w)
        out[name] = F.when(rows > 0, clean_round(total, digits))
    return d.withColumns(out).drop("__p", "__c")


def gaps(df: DataFrame, keys: Sequence[str], value: str, minutes: int = 30) -> DataFrame:
    """Ranges of consecutive slots without a value: [first slot, last slot + step)."""
    step = span(mins=minutes)
    nulls = df.filter(F.col(value).isNull())
    run = F.col("ts") - F.expr(f"INTERVAL '{minutes}' MINUTE") * F.row_number().over(_series(keys))
    return (
        nulls.select(*keys, "ts", run.alias("__run"))
        .groupBy(*keys, "__run")
        .agg(F.min("ts").alias("ts_start"), (F.max("ts") + step).alias("ts_end"))
        .drop("__run")
    )


def zeroed(df: DataFrame, keys: Sequence[str], cols: Sequence[str], order: Sequence[str] = ("ts",)) -> DataFrame:
    """Subtract each series' first value; the first row comes from an aggregate."""
    rank = F.struct(*[F.col(c) for c in order])
    first = df.groupBy(*keys).agg(*[F.min_by(c, rank).alias(f"__0_{c}") for c in cols])
    return (
        df.join(first, list(keys))
        .withColumns({c: F.col(c) - F.col(f"__0_{c}") for c in cols})
        .drop(*[f"__0_{c}" for c in cols])
    )


# --- gaussian weights ------------------------------------------------------


def gaussian_mean(
    df: DataFrame, keys: Sequence[str], index: str, value: str, sigma: float = 3.0, width: int = 39, out: str = "mean", chunk: int = 4096
) -> DataFrame:
    """Weighted mean around each row, edges reflected.

    ``index`` is the 1-based row number, without gaps. A series is cut into
    chunks of rows with a halo of half a width, so no task needs a whole series
    and few rows are copied; each row then weighs the values of its own frame.
    Beyond an end the series reads backwards, and forwards again, as often as
    a short series needs.
    """
    half = width // 2
    weights = [math.exp(-(o * o) / (2.0 * sigma * sigma)) for o in range(-half, half + 1)]
    d = with_halo(df.select(*keys, index, F.col(value).alias("__v")), F.col(index), max(chunk, half), half, half)
    frame = W.partitionBy(*keys, CHUNK).orderBy(index).rowsBetween(-half, half)
    # structs, so that NULL values keep their places
    d = own_rows(d.withColumns({"__f": F.collect_list(F.struct("__v")).over(frame), "__lo": F.min(index).over(frame), "__n": F.max(index).over(frame)}))
    # where the frame is cut, __n is the last row; elsewhere no row beyond it is asked for
    n, at = F.col("__n"), lambda o: F.pmod(F.col(index) + o - 1, 2 * F.col("__n"))
    place = lambda o: F.when(at(o) < n, at(o) + 1).otherwise(2 * n - at(o)) - F.col("__lo") + 1
    terms = F.zip_with(
        F.sequence(F.lit(-half), F.lit(half)), F.array(*map(F.lit, weights)),
        lambda o, w: F.struct((w * F.element_at(F.col("__f"), place(o).cast("int"))["__v"]).alias("s"), w.alias("w")),
    )
    # a NULL value carries no weight in the sum but keeps it below the line, as a sum over rows would
    total = F.aggregate(terms, F.lit(0.0), lambda a, t: a + F.coalesce(t["s"], F.lit(0.0)))
    return d.select(*keys, index, (total / F.lit(sum(weights))).alias(out))


def gaussian_smooth(
    df: DataFrame, keys: Sequence[str], index: str, value: str, sigma: float = 3.0, width: int = 39
) -> DataFrame:
    """Weighted mean, and weighted mean of the squared distance from it."""
    m = gaussian_mean(df, keys, index, value, sigma, width)
    on = [*keys, index]
    r = df.join(m, on).withColumn("__sq", (F.col(value) - F.col("mean")) * (F.col(value) - F.col("mean")))
    v = gaussian_mean(r.select(*on, "__sq"), keys, index, "__sq", sigma, width, "variance")
    return m.join(v, on)
