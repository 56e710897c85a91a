"""Ordered scans that never put a whole series into one task.

A plain ``Window.partitionBy(key).orderBy(ts)`` sends every row of a hot key to
one task. Here each series is cut into *chunks* of its ordering (a day, a range
of row numbers, a score band). Rows are scanned inside (key, chunk); one small
summary row per (key, chunk), built with a map-side combined aggregate, carries
the state over chunk borders. The results equal the plain window.

Series keys must not be NULL.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .clock import micros

CHUNK = "__chunk"
DAY = 86_400_000_000


def time_chunk(ts: str, size: int = DAY) -> Column:
    """Chunk number of a timestamp; ``size`` in microseconds."""
    return F.floor(micros(ts) / F.lit(size))


@dataclass(frozen=True)
class Spec:
    kind: str
    expr: Column


def running_sum(e: Column) -> Spec:
    return Spec("sum", e)


def row_index() -> Spec:
    """1-based position in the series."""
    return Spec("sum", F.lit(1).cast("bigint"))


def running_max(e: Column) -> Spec:
    return Spec("max", e)


def max_before(e: Column) -> Spec:
    """Maximum over strictly earlier rows."""
    return Spec("max_before", e)


def last_value(e: Column) -> Spec:
    """Latest non-NULL at or before the row."""
    return Spec("last", e)


def last_before(e: Column) -> Spec:
    """Latest non-NULL strictly before the row."""
    return Spec("last_before", e)


def previous(e: Column) -> Spec:
    """Value of the row just before, NULL or not."""
    return Spec("prev", e)


def scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    specs: dict[str, Spec],
    chunk: Column | None = None,
    reverse: bool = False,
) -> DataFrame:
    """Add the columns named in ``specs``. ``order`` must be a total order.

    ``chunk`` must be monotone in ``order``; by default days of ``order[0]``.
    ``reverse`` scans from the end, so ``previous`` becomes the next row.
    """
    keys = list(keys)
    d = df.withColumn(CHUNK, time_chunk(order[0]) if chunk is None else chunk)
    for n, s in specs.items():
        wrapped = F.struct(s.expr.alias("v")) if s.kind == "prev" else s.expr
        d = d.withColumn(f"__in_{n}", wrapped)

    rank = F.struct(*[F.col(c) for c in order])
    latest = F.min_by if reverse else F.max_by
    aggs = []
    for n, s in specs.items():
        x = F.col(f"__in_{n}")
        if s.kind == "sum":
            a = F.sum(x)
        elif s.kind in ("max", "max_before"):
            a = F.max(x)
        else:
            a = latest(x, F.when(x.isNotNull(), rank))
        aggs.append(a.alias(f"__tot_{n}"))

    def ordered(cols):
        return [F.col(c).desc() if reverse else F.col(c).asc() for c in cols]

    before = W.partitionBy(*keys).orderBy(*ordered([CHUNK])).rowsBetween(W.unboundedPreceding, -1)
    carry = d.groupBy(*keys, CHUNK).agg(*aggs)
    outs = []
    for n, s in specs.items():
        t = F.col(f"__tot_{n}")
        f = {"sum": F.sum(t), "max": F.max(t), "max_before": F.max(t)}.get(
            s.kind, F.last(t, ignorenulls=True)
        )
        outs.append(f.over(before).alias(f"__carry_{n}"))
    carry = carry.select(*keys, CHUNK, *outs)

    base = W.partitionBy(*keys, CHUNK).orderBy(*ordered(order))
    upto = base.rowsBetween(W.unboundedPreceding, 0)
    prior = base.rowsBetween(W.unboundedPreceding, -1)
    local = []
    for n, s in specs.items():
        x = F.col(f"__in_{n}")
        f = {
            "sum": lambda x: F.sum(x).over(upto),
            "max": lambda x: F.max(x).over(upto),
            "max_before": lambda x: F.max(x).over(prior),
            "last": lambda x: F.last(x, ignorenulls=True).over(upto),
            "last_before": lambda x: F.last(x, ignorenulls=True).over(prior),
            "prev": lambda x: F.last(x, ignorenulls=True).over(prior),
        }[s.kind]
        local.append(f(x).alias(f"__loc_{n}"))
    d = d.select("*", *local).join(carry, [*keys, CHUNK], "left")

    final = []
    for n, s in specs.items():
        loc, car = F.col(f"__loc_{n}"), F.col(f"__carry_{n}")
        if s.kind == "sum":
            v = F.when(loc.isNotNull() | car.isNotNull(), F.coalesce(loc, loc * 0, car * 0) + F.coalesce(car, loc * 0))
        elif s.kind in ("max", "max_before"):
            v = F.greatest(loc, car)
        else:
            v = F.coalesce(loc, car)
            if s.kind == "prev":
                v = v["v"]
        final.append(v.alias(n))
    keep = [c for c in df.columns if c not in specs]
    return d.select(*keep, *final)


def islands(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    prev: dict[str, Spec],
    starts: Column,
    aggs: Sequence[Column],
    chunk: Column | None = None,
    chunk_by: str | None = None,
) -> DataFrame:
    """Group maximal runs of rows; ``starts`` is true where a run begins.

    ``starts`` may use the columns named in ``prev`` (state from earlier rows).
    """
    def ck():
        return chunk if chunk is not None else time_chunk(chunk_by or order[0])

    d = scan(df, keys, order, prev, ck())
    d = d.withColumn("__new", F.when(starts, 1).otherwise(0).cast("bigint"))
    d = scan(d, keys, order, {"__island": running_sum(F.col("__new"))}, ck())
    return d.groupBy(*keys, "__island").agg(*aggs)


def value_bands(df: DataFrame, col: str, bands: int | None = None, error: float = 0.002) -> Column:
    """Number of the band a value falls into, for `scan` over values of any range.

    Splitters are approximate quantiles of ``df`` (one job), so bands hold
    about the same number of rows wherever the values lie. At most ``bands``
    of them, the shuffle partitions by default; equal values share a band.
    NULL comes first, NaN last.
    """
    bands = bands or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cuts = sorted(set(df.select(F.col(col).cast("double").alias("v")).approxQuantile("v", [k / bands for k in range(1, bands)], error)))
    if not cuts:
        return F.lit(0)
    v = F.col(col).cast("double")
    return F.when(v.isNull(), -1).otherwise(F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= v)))


def with_halo(
    df: DataFrame, position: Column, size: int | float, back: int | float, ahead: int | float = 0
) -> DataFrame:
    """Copy rows into every chunk whose frames can reach them.

    ``position`` is a number (microseconds, row index); a row at p is used by
    frames of rows in [p - ahead, p + back]. Adds ``__chunk`` and ``__own``;
    keep only ``__own`` rows after the window. With ``size`` >= ``back`` a row
    has at most one copy on each side.
    """
    home = F.floor(position / F.lit(size))
    lo = F.floor((position - F.lit(ahead)) / F.lit(size))
    hi = F.floor((position + F.lit(back)) / F.lit(size))
    return df.select("*", home.alias("__home"), F.explode(F.sequence(lo, hi)).alias(CHUNK)).withColumn(
        "__own", F.col("__home") == F.col(CHUNK)
    ).drop("__home")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows by ``keys`` over tasks, before a step in which a few rows make many.

    Neither the files' sizes nor those of a shuffle may then say how many tasks
    there are, so their number is fixed.
    """
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return df.repartition(tasks, *keys)


def own_rows(df: DataFrame) -> DataFrame:
    return df.filter("__own").drop("__own", CHUNK)
