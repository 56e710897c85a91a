"""Tilt to displacement, velocity and node-to-node comparisons."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.clock import clean_round
from .clean import NODE, apply_filters
from .series import _series, fill, resample_ffill, smooth


def linear_component(axis: str, length: Column | str) -> Column:
    """L * axis / |v|, which is L * sin of the tilt angle."""
    n = F.col(length) if isinstance(length, str) else length
    x, y, z = (F.col(a).cast("double") for a in ("x", "y", "z"))
    return clean_round(n * F.try_divide(F.col(axis).cast("double"), F.sqrt(x * x + y * y + z * z)), 4)


def to_linear(df: DataFrame, length: str = "segment_length") -> DataFrame:
    return df.withColumns({"xz": linear_component("z", length), "xy": linear_component("y", length)})


def depth_net(df: DataFrame, length: str = "segment_length") -> DataFrame:
    """Signed vertical part of a tilted segment and its horizontal distance."""
    L, xz, xy = F.col(length), F.col("xz"), F.col("xy")
    rest = L * L - xz * xz - xy * xy
    sign = F.when(F.col("x") < 0, -1.0).otherwise(1.0)
    return df.withColumns(
        {
            "depth": sign * F.coalesce(F.when(rest >= 0, F.sqrt(F.greatest(rest, F.lit(0.0)))), L),
            "net": F.sqrt(xz * xz + xy * xy),
        }
    )


def resultant(df: DataFrame, keys: Sequence[str] = NODE, length: str = "segment_length", tie: Sequence[str] = ("ts",)) -> DataFrame:
    """Movement vector against the node's first reading, with its angles."""
    first = df.groupBy(*keys).agg(
        *[F.min_by(a, F.struct(*tie)).alias(f"{a}0") for a in ("x", "y", "z")]
    )
    d = df.join(first, list(keys))
    dx, dy, dz = (F.col(a) - F.col(f"{a}0") for a in ("x", "y", "z"))
    mag = F.sqrt((dx * dx + dy * dy + dz * dz).cast("double"))
    x, y, z = (F.col(a).cast("double") for a in ("x", "y", "z"))
    return d.withColumns(
        {
            "resultant": mag * F.col(length) / 1024.0,
            "angle": F.acos(F.try_divide(dy.cast("double"), F.sqrt((dy * dy + dz * dz).cast("double")))),
            "beta": F.acos(F.try_divide(x, F.sqrt(x * x + y * y + z * z))),
        }
    ).drop("x0", "y0", "z0")


def node_series(readings: DataFrame, sensors: DataFrame, tie: Sequence[str] = ("ts",), n: int = 7) -> DataFrame:
    """Cleaned, gridded and smoothed xz / xy of every node over all its time."""
    clean = apply_filters(readings, NODE, tie)
    lin = to_linear(clean.join(sensors.select("tsm_id", "segment_length"), "tsm_id"))
    full = resample_ffill(lin, NODE, ["xz", "xy"])
    return smooth(full, NODE, ["xz", "xy"], n)


def velocity(df: DataFrame, keys: Sequence[str] = NODE, n: int = 7, start: Column | None = None, minutes: int = 30) -> DataFrame:
    """Rolling regression slope in m / day of series on a grid of ``minutes``.

    With rows equally far apart the slope is a sum of the last n values with
    fixed weights, so no regression is fitted per row. NULL where one of them
    is, or where there are fewer.
    """
    w = _series(keys)
    middle = (n - 1) / 2
    scale = sum((k - middle) ** 2 for k in range(n)) * minutes / 1440
    slope = lambda c: sum((F.lag(c, k).over(w) * (middle - k) for k in range(1, n)), F.col(c) * middle) / F.lit(scale)
    d = df.withColumns({f"vel_{c}": clean_round(slope(c), 4) for c in ("xz", "xy")})
    return d if start is None else d.filter(F.col("ts") >= start)


def linreg_displacement(df: DataFrame, keys: Sequence[str], value: str, n: int = 7, lag: int = 144, digits: int = 4) -> DataFrame:
    """Rolling line fit evaluated at the row, and its change over ``lag`` rows.

    Row numbers lie one apart, so only the values' mean and their covariance
    with the row number are updated over the frame, in the order and with the
    roundings of ``regr_slope`` and ``regr_intercept``, as columns: no
    aggregate runs per row. NULL where one of the values is, or where there
    are fewer.
    """
    w = _series(keys)
    own = list(df.columns)
    d = df.withColumns({"__x": F.row_number().over(w).cast("double"), **{f"__v{k}": F.lag(value, n - 1 - k).over(w).cast("double") for k in range(n - 1)}, f"__v{n - 1}": F.col(value).cast("double")})
    d = d.withColumns({"__mean": F.col("__v0"), "__cov": F.lit(0.0)})
    for k in range(1, n):
        v, mean = F.col(f"__v{k}"), F.col("__mean")
        d = d.withColumn("__mean", mean + (v - mean) / F.lit(k + 1.0))
        d = d.withColumn("__cov", F.col("__cov") + F.lit((k + 1) / 2) * (v - F.col("__mean")))
    slope = F.col("__cov") / F.lit(sum((k - (n - 1) / 2) ** 2 for k in range(n)))
    d = d.withColumn("__slope", slope)
    pred = F.col("__slope") * F.col("__x") + (F.col("__mean") - F.col("__slope") * (F.col("__x") - F.lit((n - 1) / 2)))
    d = d.select(*own, clean_round(pred, digits).alias("predicted"))
    return d.withColumn(
        "displacement", clean_round(F.col("predicted") - F.lag("predicted", lag).over(w), digits)
    )


def node_disp(df: DataFrame, keys: Sequence[str] = NODE, lag: int = 144) -> DataFrame:
    """Absolute three-day displacement of each axis."""
    w = _series(keys)
    return df.withColumns(
        {f"disp_{c}": clean_round(F.abs(F.col(c) - F.lag(c, lag).over(w)), 4) for c in ("xz", "xy")}
    )


def adjacent(df: DataFrame, cols: Sequence[str], sensor: str = "tsm_id") -> DataFrame:
    """Values of node - 1 (``up_``) and node + 1 (``down_``) at the same time."""
    w = W.partitionBy(sensor, "ts").orderBy("node_id")
    out = {}
    for c in cols:
        for name, step in (("up", -1), ("down", 1)):
            f = F.lag if step < 0 else F.lead
            near = f(F.struct("node_id", F.col(c).alias("v"))).over(w)
            out[f"{name}_{c}"] = F.when(near["node_id"] == F.col("node_id") + step, near["v"])
    return df.withColumns(out)


def adjacent_ratio(df: DataFrame, cols: Sequence[str], sensor: str = "tsm_id") -> DataFrame:
    """Largest neighbour axis over own smallest non-zero axis, in percent.

    Ratios outside (0, 1) are replaced by their reciprocal; infinite -> NULL.
    """
    d = adjacent(df, cols, sensor)
    own = F.least(*[F.nullif(F.col(c), F.lit(0.0)) for c in cols])
    out = {}
    for side in ("up", "down"):
        r = F.try_divide(F.greatest(*[F.col(f"{side}_{c}") for c in cols]), own)
        folded = F.when((r < 1) & (r > 0), r).otherwise(F.try_divide(F.lit(1.0), r))
        out[f"{side}_ratio"] = clean_round(folded * 100, 4)
    return d.withColumns(out)


def rolling_spearman(df: DataFrame, value: str, n: int = 144, keys: Sequence[str] = NODE, keep: Sequence[str] = ()) -> DataFrame:
    """Rank correlation of the last ``n`` grid rows with time, beside the columns ``keep``.

    Grouped-map over the series; one is bounded by the slot grid, and lies
    together already where it was windowed before. Inside, the rank sums follow
    from comparing each value with the n - 1 before it, one distance at a time
    for all rows, and nothing is sorted per row. Equal values share their mean
    rank; a window of one value has none. NaN counts as above all numbers, each
    apart.
    """
    d = df.select(*keys, "ts", *keep, value) if value not in keep else df.select(*keys, "ts", *keep)
    types = {f.name: f.dataType.simpleString() for f in d.schema.fields}
    given = [*keys, "ts", *keep]
    schema = ", ".join(f"`{c}` {types[c]}" for c in given) + ", rho double"

    def moving_rho(values: np.ndarray) -> np.ndarray:
        """Rank correlation of each run of n values with their order.

        The covariance of rank and position is half the sum, over the pairs of
        a run, of their distance, signed by which value is greater. A pair
        enters with its later value and leaves with its earlier one, so the
        sums of runs are differences of running totals; so is the tie
        correction, from the number of equals a value meets.
        """
        rho = np.full(len(values), np.nan)
        if len(values) < n:
            return rho
        code = np.unique(values, return_inverse=True, equal_nan=False)[1].astype(np.int32)
        new, gone, same_new, same_gone = np.zeros((4, len(code)), np.int32)
        tied = code.max() + 1 < len(code)
        for k in range(1, n):
            sign = np.sign(code[k:] - code[:-k])
            if tied:
                equal = sign == 0
                same_new[k:] += equal
                same_gone[:-k] += equal
            sign *= k
            new[k:] += sign
            gone[:-k] += sign

        def total(enter, leave):
            out = np.cumsum(enter, dtype=np.int64)[n - 1 :]
            out[1:] -= np.cumsum(leave, dtype=np.int64)[: len(out) - 1]
            return out

        met = lambda same: 3 * same.astype(np.int64) * (same + 1)
        ties = total(met(same_new), met(same_gone)).astype(float)
        spread = n * (n * n - 1) / 12
        covariance = total(new, gone) / 2
        den = np.sqrt(np.maximum(spread - ties / 12, 0) * spread)
        with np.errstate(invalid="ignore", divide="ignore"):
            rho[n - 1 :] = np.where(den > 0, covariance / den, np.nan)
        return rho

    def per_group(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("ts")
        rho = moving_rho(rows.column(value).to_numpy().astype(float))
        return rows.select(given).append_column("rho", pa.array(rho))

    return d.groupBy(*keys).applyInArrow(per_group, schema).withColumn("rho", clean_round(F.nanvl("rho", F.lit(None).cast("double")), 6))
