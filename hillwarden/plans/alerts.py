"""From operational triggers to notifications and their validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.clock import half_hour, span
from ..operators.intervals import by_days

QUIET_SOURCES = ("moms", "on demand")


def current_triggers(triggers: DataFrame, at: Column, days: int = 2) -> DataFrame:
    """Positive triggers of the last days, newest per (site, source, level)."""
    d = triggers.filter(
        (F.col("alert_level") > 0) & (F.col("ts") <= at) & (F.col("ts_updated") >= at - span(days=days))
        & ~F.col("trigger_source").isin(*QUIET_SOURCES)
    )
    w = W.partitionBy("site_id", "trigger_source", "alert_level").orderBy(F.col("ts_updated").desc(), F.col("trigger_id").desc())
    return d.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def retrigger(current: DataFrame, status: DataFrame, hours: int = 24) -> DataFrame:
    """Triggers that need a new status row: none yet, or the last is a day old."""
    last = status.groupBy("trigger_id").agg(F.max("ts_last_retrigger").alias("__l"))
    d = current.join(last, "trigger_id", "left")
    return d.filter(F.col("__l").isNull() | (F.col("__l") + span(hours=hours) < F.col("ts_updated"))).select(
        "trigger_id", F.col("ts_updated").alias("ts_last_retrigger")
    )


def valid_triggers(triggers: DataFrame, status: DataFrame) -> DataFrame:
    return triggers.join(status.filter("alert_status = -1").select("trigger_id").distinct(), "trigger_id", "left_anti")


def with_status(triggers: DataFrame, status: DataFrame) -> DataFrame:
    return triggers.join(status.select("trigger_id", "ts_last_retrigger", "alert_status"), "trigger_id", "left")


def apply_validation(triggers: DataFrame, status: DataFrame, public: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Outcome of validated surficial triggers: (triggers to add, public alerts to delete).

    A valid level-1 trigger becomes level 2. An invalid level 2 or 3 removes
    the public alert starting at its half hour, unless another valid trigger of
    at least its level starts there too.
    """
    s = triggers.filter("trigger_source = 'surficial'").join(status.select("trigger_id", "alert_status"), "trigger_id")
    add = s.filter("alert_level = 1 AND alert_status = 1").select(
        "site_id", F.col("ts_updated").alias("ts"), "ts_updated", F.lit("surficial").alias("trigger_source"), F.lit(2).alias("alert_level")
    )
    bad = s.filter("alert_level >= 2 AND alert_status = -1").select(
        "site_id", half_hour("ts_updated").alias("start"), F.col("alert_level").alias("__lv"), "trigger_id"
    )
    others = valid_triggers(triggers, status).groupBy("site_id", half_hour("ts").alias("start")).agg(F.max("alert_level").alias("__co"))
    drop = bad.join(others, ["site_id", "start"], "left").filter(F.col("__co").isNull() | (F.col("__co") < F.col("__lv")))
    keys = drop.select("site_id", F.col("start").alias("ts")).distinct()
    return add, public.join(keys, ["site_id", "ts"], "left_semi")


def sources_text(df: DataFrame, keys: list[str], name: str, out: str = "sources") -> DataFrame:
    """Distinct names per key as one ordered, comma-separated text.

    Names come from a code table, so the set stays small.
    """
    return df.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set(name)), ",").alias(out))


def alert_messages(
    due: DataFrame, rain_hits: DataFrame, node_hits: DataFrame, marker_hits: DataFrame
) -> DataFrame:
    """Text per due trigger: header, then what moved.

    ``due``: trigger_id, site_id, trigger_source, alert_level, event_start,
    ts_last_retrigger. Hits carry site_id, ts and a name: gauges since the
    event start, nodes of the last four hours, markers since the event start.
    """
    d = due.withColumn("__from", F.when(F.col("trigger_source") == "subsurface", F.col("ts_last_retrigger") - span(hours=4)).otherwise(F.col("event_start")))
    span_rows = by_days(d.select("trigger_id", "site_id", "trigger_source", "__from", F.col("ts_last_retrigger").alias("__to")), F.col("__from"), F.col("__to"))

    def tag(h: DataFrame, source: str) -> DataFrame:
        return h.select("site_id", F.col("ts").alias("__h"), F.to_date("ts").alias("__day"), F.col("name"), F.lit(source).alias("trigger_source"))

    nodes = node_hits.select("site_id", "ts", F.struct("sensor", "node_id").alias("sn"))
    hits = tag(rain_hits, "rainfall").unionByName(tag(marker_hits, "surficial"))
    named = span_rows.join(hits, ["site_id", "trigger_source", "__day"]).filter(F.col("__h").between(F.col("__from"), F.col("__to")))
    plain = named.groupBy("trigger_id").agg(F.array_join(F.array_sort(F.collect_set("name")), ",").alias("__t"))
    nh = nodes.select("site_id", F.col("ts").alias("__h"), F.to_date("ts").alias("__day"), "sn.sensor", "sn.node_id", F.lit("subsurface").alias("trigger_source"))
    nn = span_rows.join(nh, ["site_id", "trigger_source", "__day"]).filter(F.col("__h").between(F.col("__from"), F.col("__to")))
    per = nn.groupBy("trigger_id", "sensor").agg(
        F.concat("sensor", F.lit("("), F.array_join(F.transform(F.array_sort(F.collect_set("node_id")), lambda x: x.cast("string")), ","), F.lit(")")).alias("__s")
    )
    sub = per.groupBy("trigger_id").agg(F.array_join(F.array_sort(F.collect_set("__s")), ",").alias("__t"))
    text = plain.unionByName(sub)
    head = F.concat(F.lit("ALERT "), F.col("trigger_id").cast("string"), F.lit(" site "), F.col("site_id").cast("string"), F.lit(" "), F.col("trigger_source"), F.lit(" level "), F.col("alert_level").cast("string"))
    return due.join(text, "trigger_id", "left").select(
        "trigger_id", "site_id", F.concat(head, F.coalesce(F.concat(F.lit(":"), F.col("__t")), F.lit(""))).alias("message")
    )


def due_alerts(current: DataFrame, status: DataFrame) -> DataFrame:
    """Triggers whose status is not acknowledged yet."""
    acked = status.filter("user_id IS NOT NULL AND alert_status <> 0").select("trigger_id").distinct()
    return current.join(acked, "trigger_id", "left_anti")
