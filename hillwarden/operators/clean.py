"""Row repair and rejection for raw sensor readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.clock import floor_to, span
from ..functions.scan import spread

NODE = ("tsm_id", "node_id")
AXES = ("x", "y", "z")


def range_filter(df: DataFrame) -> DataFrame:
    """Unwrap valid overshoot, blank impossible axes, drop rows without x."""
    def fits(a):
        return F.col(a).between(-1126, 1126)

    def wrapped(a):
        # unwrapped values always fit: -3071 .. -2971 become 1025 .. 1125
        return (F.col(a) > -3072) & (F.col(a) < -2970)

    d = df.filter(fits("x") | wrapped("x"))
    return d.withColumns({a: F.when(fits(a), F.col(a)).when(wrapped(a), F.col(a) + 4096) for a in AXES})


def magnitude() -> Column:
    x, y, z = (F.pow(F.col(a) / F.lit(1024.0), F.lit(2.0)) for a in AXES)
    return F.sqrt(x + y + z)


def orthogonal_filter(df: DataFrame, lim: float = 0.08) -> DataFrame:
    """Keep rows whose gravity vector has about unit length."""
    return df.filter(F.abs(magnitude() - 1.0) < lim)


def slot_first(
    df: DataFrame,
    keys: Sequence[str] = NODE,
    cols: Sequence[str] = AXES,
    tie: Sequence[str] = ("ts",),
    minutes: int = 30,
) -> DataFrame:
    """First non-NULL of each column per slot; one combinable aggregate."""
    order = F.struct(*[F.col(c) for c in tie])
    return (
        df.withColumn("__slot", floor_to("ts", minutes))
        .groupBy(*keys, "__slot")
        .agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in cols])
        .withColumnRenamed("__slot", "ts")
    )


def outlier_filter(
    df: DataFrame,
    keys: Sequence[str] = NODE,
    tie: Sequence[str] = ("ts",),
    slots: int = 48,
    width: float = 3.0,
    minutes: int = 30,
) -> DataFrame:
    """Drop slots where any axis leaves mean +- width * std of the last day.

    Empty slots count towards the frame, hence RANGE. After ``slot_first`` a
    series has at most one row per slot, so a window partition is bounded by
    the time span and not by the reading count. Means and deviations are
    differences of running sums, so a frame is looked up once and not summed
    for each axis; the sums of whole numbers are exact.
    """
    d = spread(slot_first(df, keys, AXES, tie, minutes), *keys)
    whole = all(t in ("tinyint", "smallint", "int") for c, t in d.dtypes if c in AXES)
    number = lambda a: F.col(a).cast("bigint" if whole else "double")  # sums of whole numbers are exact
    running = W.partitionBy(*keys).orderBy("ts").rowsBetween(W.unboundedPreceding, 0)
    d = d.select(
        "*",
        *[F.count(a).over(running).alias(f"__n_{a}") for a in AXES],
        *[F.sum(number(a)).over(running).alias(f"__1_{a}") for a in AXES],
        *[F.sum(number(a) * number(a)).over(running).alias(f"__2_{a}") for a in AXES],
    )
    # what was summed up to the frame's first row, that row included, and that row itself
    sums = [F.col(f"__{k}_{a}") for a in AXES for k in "n12"]
    d = d.withColumn("__at", F.struct(*AXES, *sums))
    frame = f"(PARTITION BY {', '.join(keys)} ORDER BY ts RANGE BETWEEN INTERVAL '{(slots - 1) * minutes}' MINUTE PRECEDING AND CURRENT ROW)"
    d = d.withColumn("__first", F.expr(f"first(__at) OVER {frame}"))
    keep = F.lit(True)
    zero = F.lit(0)
    for a in AXES:
        v, own = F.col(a), F.col(f"__first.{a}").cast("bigint" if whole else "double")
        n = F.col(f"__n_{a}") - F.col(f"__first.__n_{a}") + own.isNotNull().cast("int")
        one = F.coalesce(f"__1_{a}", zero) - F.coalesce(F.col(f"__first.__1_{a}"), zero) + F.coalesce(own, zero)
        two = F.coalesce(f"__2_{a}", zero) - F.coalesce(F.col(f"__first.__2_{a}"), zero) + F.coalesce(own * own, zero)
        m = one / n
        # NULL for a single value, as a sample has no deviation
        s = F.when(n > 1, F.sqrt(F.greatest(n * two - one * one, zero) / (n * (n - 1))))
        out = (v > m + width * s) | (v < m - width * s)
        keep = keep & v.isNotNull() & ~F.coalesce(out, F.lit(False))
    return d.filter(keep).select(*keys, "ts", *AXES)


def apply_filters(
    df: DataFrame,
    keys: Sequence[str] = NODE,
    tie: Sequence[str] = ("ts",),
    range_: bool = True,
    ortho: bool = True,
    outlier: bool = True,
) -> DataFrame:
    """Range, unit-gravity and outlier steps, each switchable."""
    if range_:
        df = range_filter(df)
    if ortho:
        df = orthogonal_filter(df)
    if outlier:
        df = outlier_filter(df, keys, tie)
    return df


def volt_filter(df: DataFrame, accel: DataFrame, name: str | None = None) -> DataFrame:
    """Keep readings whose supply voltage fits the accelerometer's limits.

    Batteries of 56 and more are raw counts. With ``name``, sensors of the
    first version (four-letter names) pass unchecked.
    """
    on = ["tsm_id", "node_id", "accel_number"]
    lim = accel.select(*on, "voltage_min", "voltage_max")
    batt = F.when(F.col("batt") >= 56, (F.col("batt") + 200) / 100).otherwise(F.col("batt"))
    ok = (F.col("batt") == 2) | F.col("batt").between(F.col("voltage_min"), F.col("voltage_max"))
    if name is None:
        return df.join(lim, on).withColumn("batt", batt).filter(ok).drop("voltage_min", "voltage_max")
    old = F.length(name) == 4
    return (
        df.join(lim, on, "left")
        .withColumn("batt", F.when(old, F.col("batt")).otherwise(batt))
        .filter(old | ok)
        .drop("voltage_min", "voltage_max")
    )


def accel_number(type_num: str = "type_num") -> Column:
    """Message type -> accelerometer 1 / 2, 0 if neither. Fixed values."""
    t = F.col(type_num)
    return (
        F.when(t.isNull() | t.isin(32, 11, 41), 1).when(t.isin(33, 12, 42), 2).otherwise(0)
    )


def select_accel(df: DataFrame, accel: DataFrame, analysis: bool = False) -> DataFrame:
    """Readings of the accelerometer in use.

    ``analysis`` keeps in-use rows only. Otherwise a sensor without any in-use
    reading falls back to its highest accelerometer number.
    """
    on = ["tsm_id", "node_id", "accel_number"]
    d = df.withColumn("accel_number", accel_number()).join(accel.select(*on, "in_use"), on)
    if analysis:
        return d.filter("in_use = 1").drop("in_use")
    pick = d.groupBy("tsm_id").agg(
        F.max("in_use").alias("__any"), F.max("accel_number").alias("__top")
    )
    return (
        d.join(pick, "tsm_id")
        .filter(F.when(F.col("__any") == 1, F.col("in_use") == 1).otherwise(F.col("accel_number") == F.col("__top")))
        .drop("in_use", "__any", "__top")
    )


def drop_bad_nodes(df: DataFrame, status: DataFrame, at: Column | None = None, bad: int = 4) -> DataFrame:
    """Remove nodes flagged bad on or before ``at`` (or the row's own time)."""
    s = status.filter(F.col("status") == bad)
    if at is not None:
        return df.join(s.filter(F.col("date_identified") <= at).select(*NODE).distinct(), list(NODE), "left_anti")
    first = s.groupBy(*NODE).agg(F.min("date_identified").alias("__since"))
    return df.join(first, list(NODE), "left").filter("__since IS NULL OR __since > ts").drop("__since")


def drop_tagged(df: DataFrame, tags: DataFrame, key: str = "rain_id") -> DataFrame:
    """Remove rows strictly inside a tagged interval; an open tag lasts a day.

    The tags are laid out per day so that the join is on equality of
    (key, day); the interval test then sees only that day's tags.
    """
    t = tags.select(
        F.col(key),
        F.col("ts_start").alias("__a"),
        F.coalesce("ts_end", F.col("ts_start") + span(days=1)).alias("__b"),
    ).select(
        "*", F.explode(F.sequence(F.to_date("__a"), F.to_date("__b"))).alias("__day")
    )
    d = df.withColumn("__day", F.to_date("ts"))
    return d.join(
        t, (d[key] == t[key]) & (d["__day"] == t["__day"]) & (d.ts > t["__a"]) & (d.ts < t["__b"]), "left_anti"
    ).drop("__day")


# --- soil moisture ---------------------------------------------------------
# Message types each sensor version may send.
MOISTURE_TYPES = {2: (21, 26, 112, 111), 3: (110, 113, 10, 13)}
MOISTURE_GAIN = 20_000_000.0


def soms_calibrate(df: DataFrame, sensors: DataFrame, gains: dict[str, float] | None = None) -> DataFrame:
    """Moisture from the two raw counts; version 2 only, others keep both. ``gains`` by sensor name."""
    k = F.lit(MOISTURE_GAIN)
    for n, g in (gains or {}).items():
        k = F.when(F.col("tsm_name") == n, F.lit(g)).otherwise(k)
    d = df.join(sensors.select("tsm_id", "version"), "tsm_id")
    cal = (F.try_divide(k, F.col("mval1")) - F.try_divide(k, F.col("mval2"))) * 4 / 10
    return d.withColumn("mval1", F.when(F.col("version") == 2, cal).otherwise(F.col("mval1"))).withColumn("mval2", F.when(F.col("version") == 2, F.lit(None)).otherwise(F.col("mval2")))


def soms_validate(df: DataFrame, sensors: DataFrame) -> DataFrame:
    """Add ``reject``: NULL, 'node' or 'type'."""
    d = df.join(sensors.select("tsm_id", "version", "number_of_segments"), "tsm_id")
    v = F.col("version")
    good = F.when(v == 2, F.col("type_num").isin(*MOISTURE_TYPES[2])).when(
        v == 3, F.col("type_num").isin(*MOISTURE_TYPES[3])
    ).otherwise(F.lit(True))
    return d.withColumn(
        "reject",
        F.when(F.col("node_id") > F.col("number_of_segments"), "node").when(~good, "type"),
    ).drop("number_of_segments")


def freq_to_kpa(df: DataFrame, coeff: DataFrame, key: str = "piezo_id") -> DataFrame:
    """Pore pressure from frequency and temperature by a per-device polynomial."""
    f, t = F.col("frequency_shift"), F.col("temperature")
    c = [F.col(f"c{i}") for i in range(6)]
    kpa = c[0] + c[1] * f + c[2] * t + c[3] * f * f + c[4] * f * t + c[5] * t * t
    return df.join(coeff, key).withColumn("kpa", kpa).drop(*[f"c{i}" for i in range(6)])
