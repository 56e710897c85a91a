"""Interval algebra: merging evaluations, sessions, overlaps, as-of lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.clock import micros, span
from ..functions.scan import islands, last_before, max_before, previous, scan, time_chunk, value_bands
from ..settings import EVALUATION_GAP, EVENT_GAP

DAY = 86_400_000_000


def merge_alerts(
    evals: DataFrame, keys: Sequence[str], level: str, tie: Sequence[str] = (), gap: str = EVALUATION_GAP
) -> DataFrame:
    """Interval rows from point evaluations.

    An evaluation extends the running interval when the level is the same and
    the interval's end is at most ``gap`` old; otherwise it opens a new one. A
    second evaluation at the same time is covered and changes nothing.
    """
    one = evals.groupBy(*keys, "ts").agg(
        (F.min_by(level, F.struct(*tie)) if tie else F.min(level)).alias(level)
    )
    prev = {"__p": previous(F.struct(F.col("ts").alias("t"), F.col(level).alias("l")))}
    starts = (
        F.col("__p").isNull()
        | (F.col("__p.l") != F.col(level))
        | (F.col("__p.t") < F.col("ts") - F.expr(f"INTERVAL '{gap}'"))
    )
    return islands(
        one, keys, ["ts"], prev, starts,
        [F.min("ts").alias("ts"), F.max("ts").alias("ts_updated"), F.max(level).alias(level)],
    ).drop("__island")


def override_symbol(target: DataFrame, updates: DataFrame, keys: Sequence[str], level: str) -> DataFrame:
    """Replace the level of a row that has the same keys; add the rest."""
    both = target.withColumn("__v", F.lit(0)).unionByName(updates.withColumn("__v", F.lit(1)))
    others = [c for c in target.columns if c not in keys and c != level]
    return both.groupBy(*keys).agg(
        F.max_by(level, "__v").alias(level), *[F.min_by(c, "__v").alias(c) for c in others]
    ).select(*target.columns)


def event_sessions(
    public: DataFrame, keys: Sequence[str] = ("site_id",), order: Sequence[str] = ("ts", "event_id"), gap: str = EVENT_GAP,
    max_links: int | None = None,
) -> DataFrame:
    """Chain intervals of a site while the pause between them is within ``gap``.

    The pause is measured from the latest end seen so far. ``max_links`` keeps
    only that many links behind the newest interval of a chain.
    """
    prev = {"__end": max_before(F.col("ts_updated"))}
    starts = F.col("__end").isNull() | (F.col("__end") < F.col("ts") - F.expr(f"INTERVAL '{gap}'"))
    if max_links is None:
        return islands(
            public, keys, order, prev, starts,
            [F.min("ts").alias("event_start"), F.max("ts_updated").alias("event_end"), F.count(F.lit(1)).alias("links")],
            chunk_by="ts",
        ).drop("__island")
    from ..functions.scan import running_sum

    d = scan(public, keys, order, prev, time_chunk("ts"))
    d = d.withColumn("__new", F.when(starts, 1).otherwise(0).cast("bigint"))
    d = scan(d, keys, order, {"__island": running_sum(F.col("__new")), "__idx": running_sum(F.lit(1).cast("bigint"))}, time_chunk("ts"))
    last = d.groupBy(*keys, "__island").agg(F.max("__idx").alias("__last"))
    return (
        d.join(last, [*keys, "__island"])
        .filter(F.col("__idx") >= F.col("__last") - max_links)
        .groupBy(*keys, "__island")
        .agg(F.min("ts").alias("event_start"), F.max("ts_updated").alias("event_end"), F.count(F.lit(1)).alias("links"))
        .drop("__island")
    )


# --- joins on time ----------------------------------------------------------


def by_days(df: DataFrame, start: Column, end: Column, out: str = "__day") -> DataFrame:
    """One row per calendar day an interval touches, for an equality join."""
    return df.select("*", F.explode(F.sequence(F.to_date(start), F.to_date(end))).alias(out))


def as_of(
    events: DataFrame, states: DataFrame, keys: Sequence[str], cols: Sequence[str], id_cols: Sequence[str],
    state_id: str | None = None, strict: bool = True, size: int = DAY,
) -> DataFrame:
    """Latest state at (or strictly before) each event: union, then one scan.

    No nested loop and no per-event lookup; a hot key is split by time. Without
    keys all rows are one series, and quantiles of their times split it, so a
    day that most rows fall on is split too.
    """
    e = events.select("*", F.lit(None).alias("__s"), F.lit(0 if strict else 1).alias("__side"))
    packed = F.struct(F.col("ts").alias("__sts"), *[F.col(c) for c in cols])
    s = states.select(
        *keys, "ts", packed.alias("__s"), F.lit(1 if strict else 0).alias("__side"),
        *( [F.col(state_id).alias("__sid")] if state_id else [] ),
    )
    d = e.unionByName(s, allowMissingColumns=True)
    if state_id:
        order = ["ts", "__side", "__sid", *id_cols]
    else:
        order = ["ts", "__side", *id_cols]
    k = list(keys)
    if not k:
        d, k = d.withColumn("__all", F.lit(0)), ["__all"]
    d = d.withColumn("__isevent", F.col("__s").isNull())
    chunk = time_chunk("ts", size) if keys else value_bands(d.withColumn("__us", micros("ts")), "__us")
    out = scan(d.withColumn("__us", micros("ts")), k, order, {"__hit": last_before(F.col("__s"))}, chunk)
    out = out.filter("__isevent")
    keep = [c for c in events.columns]
    return out.select(*keep, F.col("__hit.__sts").alias("state_ts"), *[F.col(f"__hit.{c}").alias(c) for c in cols])


def overlapping(df: DataFrame, start: Column, end: Column, a: str = "ts", b: str = "ts_updated") -> DataFrame:
    """Intervals that share an instant with [start, end]."""
    return df.filter((F.col(a) <= end) & (F.col(b) >= start))


def disjoint(df: DataFrame, start: str, end: str) -> DataFrame:
    """Intervals that touch or overlap merged into one, whatever they belong to: columns start and end."""
    d = df.select(F.col(start).alias("__a"), F.greatest(start, end).alias("__b"), F.lit(0).alias("__all")).filter("__a IS NOT NULL AND __b IS NOT NULL").distinct()
    us = d.withColumn("__us", micros("__a"))
    fresh = F.col("__until").isNull() | (F.col("__until") < F.col("__a"))
    runs = islands(us, ["__all"], ["__a", "__b"], {"__until": max_before(F.col("__b"))}, fresh, [F.min("__a").alias(start), F.max("__b").alias(end)], chunk=value_bands(us, "__us"))
    return runs.select(start, end)


def remove_downtime(schedule: DataFrame, downtime: DataFrame, ts: str = "data_ts", shift: Column | None = None, salts: int | None = None) -> DataFrame:
    """Drop schedule rows inside any downtime; the time may be shifted first.

    Downtimes are merged, so that they are few, and cut into hours; each hour is
    met by the schedule rows of that hour in ``salts`` shares (a quarter of the
    shuffle partitions, 64 at most), so one day or hour that most rows fall on
    is no single task's.
    """
    salts = salts or min(64, max(1, int(schedule.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4))
    t = F.col(ts) + (shift if shift is not None else span(mins=0))
    d = schedule.withColumn("__t", t).withColumns({"__hour": F.date_trunc("hour", "__t").cast("timestamp_ntz"), "__salt": F.pmod(F.xxhash64(*schedule.columns), F.lit(salts)).cast("int")})
    hour = lambda c: F.date_trunc("hour", c).cast("timestamp_ntz")
    w = disjoint(downtime, "start_ts", "end_ts").select(F.col("start_ts").alias("__a"), F.col("end_ts").alias("__b"), F.explode(F.sequence(hour("start_ts"), hour("end_ts"), F.expr("INTERVAL 1 HOUR"))).alias("__whour"))
    w = w.select("*", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("__wsalt"))
    inside = (d["__hour"] == w["__whour"]) & (d["__salt"] == w["__wsalt"]) & (d["__t"] >= w["__a"]) & (d["__t"] <= w["__b"])
    return d.join(w, inside, "left_anti").drop("__t", "__hour", "__salt")


def movement_after(quakes: DataFrame, moves: DataFrame, days: int, key: str = "site_id") -> DataFrame:
    """Earliest movement at the same site within ``days`` after each quake."""
    q = by_days(quakes.select("eq_id", key, F.col("ts").alias("eq_ts")), F.col("eq_ts"), F.col("eq_ts") + span(days=days))
    m = moves.select(F.col(key), F.col("ts").alias("__m"), F.to_date("ts").alias("__day")).distinct()
    hit = q.join(m, [key, "__day"]).filter(
        (F.col("__m") >= F.col("eq_ts")) & (F.col("__m") <= F.col("eq_ts") + span(days=days))
    )
    first = hit.groupBy("eq_id", key).agg(F.min("__m").alias("movement_ts"))
    return quakes.join(first, ["eq_id", key], "left")


def rain_confounded(moves: DataFrame, rain_alerts: DataFrame, days: int = 3, key: str = "site_id") -> DataFrame:
    """Movements with a rain alert at the site in the days before."""
    m = by_days(moves, F.col("ts") - span(days=days), F.col("ts"))
    r = rain_alerts.select(F.col(key).alias("__k"), F.col("ts").alias("__r"), F.to_date("ts").alias("__rd")).distinct()
    hit = m.join(
        r, (m[key] == r["__k"]) & (m["__day"] == r["__rd"]) & (r["__r"] <= m["ts"]) & (r["__r"] >= m["ts"] - span(days=days)), "left_semi"
    )
    return hit.drop("__day").distinct()


def event_context(readings: DataFrame, events: DataFrame, keys: Sequence[str], id_col: str, lead_days: int = 1) -> DataFrame:
    """Sources and ids of the events a reading falls into.

    An event counts from a day before its start until its validity ends.
    """
    k = list(keys)
    e = by_days(
        events.select(*k, F.col("trigger_source"), F.col("trigger_id"), (F.col("ts") - span(days=lead_days)).alias("__a"), F.col("validity").alias("__b")),
        F.col("__a"), F.col("__b"),
    )
    r = readings.withColumn("__day", F.to_date("ts"))
    hit = r.join(e, [*k, "__day"]).filter((F.col("__a") <= F.col("ts")) & (F.col("__b") > F.col("ts")))
    one = hit.groupBy(*k, id_col, "trigger_source").agg(F.count(F.lit(1)).alias("__c"), F.min("trigger_id").alias("__t"))
    agg = one.groupBy(*k, id_col).agg(
        F.array_join(F.array_sort(F.collect_set("trigger_source")), ",").alias("sources"),
        F.sum("__c").alias("events"), F.min("__t").alias("first_trigger"),
    )
    return readings.join(agg, [*k, id_col], "left")


def public_level(public: DataFrame, at: Column, grace: str = EVENT_GAP) -> DataFrame:
    """Level of each site at a time; an interval stays valid ``grace`` past its end."""
    live = public.filter((F.col("ts") <= at) & (F.col("ts_updated") >= at - F.expr(f"INTERVAL '{grace}'")))
    return live.groupBy("site_id").agg(
        F.max_by("alert_level", F.struct("ts", "public_id")).alias("alert_level"), F.max("ts").alias("ts")
    )
