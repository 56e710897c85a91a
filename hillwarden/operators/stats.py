"""Counts, rates, curves and scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.clock import clean_round, seconds_between, span
from ..functions.scan import running_sum, scan, value_bands

# --- keys ------------------------------------------------------------------


def latest_rows(df: DataFrame, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """All rows at each key's latest time; the time comes from an aggregate."""
    last = df.groupBy(*keys).agg(F.max(ts).alias(ts))
    return df.join(last, [*keys, ts], "left_semi")


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key under a total order; ranked before the shuffle too."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def drop_all_duplicated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs once; every copy of a repeated key goes."""
    once = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__c")).filter("__c = 1").drop("__c")
    return df.join(once, list(keys), "left_semi")


def top_n(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    if not by:
        return df.orderBy(*order).limit(n)
    w = W.partitionBy(*by).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")


# --- counts ----------------------------------------------------------------


def percent_valid(df: DataFrame, keys: Sequence[str], test: Column) -> DataFrame:
    pct = F.count_if(test) * 100.0 / F.count(F.lit(1))
    return df.groupBy(*keys).agg(clean_round(pct, 2).alias("percent"))


def retention(raw: DataFrame, clean: DataFrame, keys: Sequence[str], end: Column, days: int = 3) -> DataFrame:
    """Share of recent raw rows that survive the filters."""
    def n(d, name):
        return d.filter((F.col("ts") > end - span(days=days)) & (F.col("ts") <= end)).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))

    return n(raw, "raw").join(n(clean, "kept"), list(keys), "left").select(
        *keys, "raw", F.coalesce("kept", F.lit(0)).alias("kept"),
        clean_round(F.try_divide(F.coalesce("kept", F.lit(0)) * 100.0, F.col("raw")), 2).alias("percent"),
    )


def period_stats(df: DataFrame, ts: str, metrics: dict[str, str]) -> DataFrame:
    """The same metrics by month, quarter and year, stacked."""
    d = df.withColumns({"__y": F.year(ts), "__q": F.quarter(ts), "__m": F.month(ts)})
    cols = ", ".join(f"{e} AS {n}" for n, e in metrics.items())
    text = f"""SELECT CASE WHEN grouping(__m) = 0 THEN 'month' WHEN grouping(__q) = 0 THEN 'quarter' ELSE 'year' END AS period,
        __y AS year, __q AS quarter, __m AS month, {cols} FROM {{d}} GROUP BY GROUPING SETS ((__y, __m), (__y, __q), (__y))"""
    return d.sparkSession.sql(text, d=d)


WEEKDAYS = ["M", "T", "W", "Th", "F", "Sa", "Su"]


def response_profile(acks: DataFrame, ts: str = "ts", site: str = "site_id") -> DataFrame:
    """Counts by (hour, site) and (weekday, site), stacked."""
    day = F.element_at(F.array(*[F.lit(x) for x in WEEKDAYS]), F.weekday(ts) + 1)
    d = acks.select(F.col(site).alias("site_id"), F.hour(ts).alias("hour"), day.alias("weekday"))
    return d.sparkSession.sql(
        "SELECT site_id, hour, weekday, count(*) AS n FROM {d} GROUP BY GROUPING SETS ((site_id, hour), (site_id, weekday))", d=d
    )


def trigger_validity(triggers: DataFrame, status: DataFrame) -> DataFrame:
    """Triggers and valid ones per source and year, the year starting in December."""
    one = status.groupBy("trigger_id").agg(F.min_by(F.struct("ts_last_retrigger", "alert_status"), "ts_last_retrigger").alias("s"))
    d = one.join(triggers.select("trigger_id", "trigger_source"), "trigger_id")
    return d.groupBy(F.year(F.add_months(F.to_date("s.ts_last_retrigger"), 1)).alias("year"), "trigger_source").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("s.alert_status") != -1).alias("valid")
    )


def measurement_compliance(sched: DataFrame, obs: DataFrame, key: str = "site_id", legacy: bool = False) -> DataFrame:
    """Measurements expected and received per site and month.

    A release expects one in the four hours up to half an hour after its data
    time; routine releases look back four hours more (not with ``legacy``).
    """
    end = F.col("data_ts") + span(mins=30)
    start = end - span(hours=4)
    if not legacy:
        start = start - F.when(F.col("event") != 1, span(hours=4)).otherwise(span(hours=0))
    s = sched.withColumns({"__a": start, "__b": end})
    s = s.withColumn("__day", F.explode(F.sequence(F.to_date("__a"), F.to_date("__b"))))
    o = obs.select(F.col(key), F.to_date("ts").alias("__day"), F.col("ts").alias("__o"))
    hit = s.join(o, [key, "__day"]).filter((F.col("__o") >= F.col("__a")) & (F.col("__o") < F.col("__b"))).select("release_id").distinct()
    d = sched.join(hit.withColumn("__r", F.lit(1)), "release_id", "left")
    return d.groupBy(key, F.year("data_ts").alias("year"), F.month("data_ts").alias("month")).agg(
        F.count(F.lit(1)).alias("expected"), F.count("__r").alias("received")
    )


def histogram(df: DataFrame, value: str, edges: Sequence[float]) -> DataFrame:
    """Counts per bin; the last bin is closed, values outside are not counted."""
    v = F.col(value)
    arr = F.array(*[F.lit(float(e)) for e in edges])
    n = len(edges) - 1
    b = F.when(v == float(edges[-1]), n).otherwise(F.width_bucket(v, F.lit(float(edges[0])), F.lit(float(edges[-1])), F.lit(n))) if _even(edges) else (
        F.when(v == float(edges[-1]), n).otherwise(F.size(F.filter(arr, lambda e: e <= v)))
    )
    return df.filter((v >= float(edges[0])) & (v <= float(edges[-1]))).groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def _even(edges: Sequence[float]) -> bool:
    w = (edges[-1] - edges[0]) / (len(edges) - 1)
    return all(abs(edges[i] - edges[0] - i * w) == 0 for i in range(len(edges)))


def prob_grid(df: DataFrame, x: str, y: str, hit: Column, x0: float, dx: float, nx: int, y0: float, dy: float, ny: int) -> DataFrame:
    """Share of hits in each cell of a 2-D grid, NULL where there is none."""
    def bins(c, lo, d, n):
        b = F.floor((F.col(c) - lo) / d)
        return F.when(F.col(c) == lo + n * d, n - 1).otherwise(b).cast("int")

    d = df.withColumns({"xbin": bins(x, x0, dx, nx), "ybin": bins(y, y0, dy, ny)})
    d = d.filter(F.col("xbin").between(0, nx - 1) & F.col("ybin").between(0, ny - 1))
    g = d.groupBy("xbin", "ybin").agg(F.count_if(hit).alias("hits"), F.count(F.lit(1)).alias("total"))
    return g.withColumn("probability", F.nullif(clean_round(F.col("hits") / F.col("total"), 6), F.lit(0.0)))


# --- classification quality --------------------------------------------------


def rates(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    """Derived scores; NULL where a denominator is zero."""
    tp, fp, fn, tn = (c.cast("double") for c in (tp, fp, fn, tn))
    tpr = F.try_divide(tp, tp + fn)
    fpr = F.try_divide(fp, fp + tn)
    out = {
        "tpr": tpr, "fpr": fpr, "specificity": F.try_divide(tn, tn + fp),
        "mcc": F.try_divide(tp * tn - fp * fn, F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))),
        "f1": F.try_divide(tp * 2, tp * 2 + fp + fn),
        "accuracy": F.try_divide(tp + tn, tp + tn + fp + fn),
        "corner_distance": F.sqrt((F.lit(1.0) - tpr) * (F.lit(1.0) - tpr) + fpr * fpr),
    }
    return {k: clean_round(v, 6).alias(k) for k, v in out.items()}


def confusion(df: DataFrame, pred: Column, actual: Column, keys: Sequence[str] = ()) -> DataFrame:
    g = df.groupBy(*keys).agg(
        F.count_if(pred & actual).alias("tp"), F.count_if(pred & ~actual).alias("fp"),
        F.count_if(~pred & actual).alias("fn"), F.count_if(~pred & ~actual).alias("tn"),
    )
    r = rates(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    return g.select(*keys, "tp", "fp", "fn", "tn", *r.values())


def roc(df: DataFrame, score: str, label: str, keys: Sequence[str] = (), bands: int | None = None) -> DataFrame:
    """Curve over every distinct score, counting scores at or above it.

    Scores are first reduced to one row per value, then summed from the top
    with a scan over bands that quantiles of the scores split, so that no key
    needs a single task, be the scores within 0 to 1 or of any other range.
    """
    g = df.groupBy(*keys, score).agg(
        F.sum(F.col(label).cast("bigint")).alias("__p"), F.sum((1 - F.col(label)).cast("bigint")).alias("__n")
    )
    sums = [F.sum("__p").alias("__pos"), F.sum("__n").alias("__neg")]
    if keys:
        g, k = g.join(g.groupBy(*keys).agg(*sums), list(keys)), list(keys)
    else:
        g = g.sparkSession.sql("SELECT *, (SELECT sum(__p) FROM {g}) AS __pos, (SELECT sum(__n) FROM {g}) AS __neg, 0 AS __all FROM {g}", g=g)
        k = ["__all"]
    d = scan(
        g, k, [score], {"tp": running_sum(F.col("__p")), "fp": running_sum(F.col("__n"))},
        value_bands(g, score, bands), reverse=True,
    )
    return d.select(
        *keys, F.col(score).alias("threshold"), "tp", "fp",
        clean_round(F.try_divide(F.col("tp").cast("double"), F.col("__pos")), 6).alias("tpr"),
        clean_round(F.try_divide(F.col("fp").cast("double"), F.col("__neg")), 6).alias("fpr"),
    )


def youden(curve: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Threshold with the largest tpr - fpr; ties to the highest threshold."""
    j = clean_round(F.col("tpr") - F.col("fpr"), 6)
    return curve.withColumn("j", j).groupBy(*keys).agg(
        F.max_by(F.struct("threshold", "tpr", "fpr", "j"), F.struct("j", "threshold")).alias("b")
    ).select(*keys, "b.*")


def sweep(df: DataFrame, value: str, label: str, keys: Sequence[str], step: float, last: float) -> DataFrame:
    """Rates at every threshold of a grid, predicting 'yes' at or below it.

    Values fall into the grid cell whose threshold first covers them; running
    sums over the cells give all thresholds at once, so the data is not
    copied per threshold. The grid bounds the rows per key.
    """
    n = int(round(last / step))
    cell = F.greatest(F.lit(1), F.ceil(F.col(value) / F.lit(step))).cast("int")
    g = df.groupBy(*keys, F.least(cell, F.lit(n + 1)).alias("__c")).agg(
        F.sum(F.col(label).cast("bigint")).alias("__p"), F.sum((1 - F.col(label)).cast("bigint")).alias("__q")
    )
    tot = g.groupBy(*keys).agg(F.sum("__p").alias("__pos"), F.sum("__q").alias("__neg"))
    full = tot.select(*keys, "__pos", "__neg", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("__c"))
    d = full.join(g, [*keys, "__c"], "left")
    w = W.partitionBy(*keys).orderBy("__c").rowsBetween(W.unboundedPreceding, 0)
    tp, fp = F.sum(F.coalesce("__p", F.lit(0))).over(w), F.sum(F.coalesce("__q", F.lit(0))).over(w)
    d = d.select(*keys, (F.col("__c") * step).alias("threshold"), tp.alias("tp"), fp.alias("fp"), "__pos", "__neg")
    return d.select(
        *keys, "threshold", "tp", "fp", (F.col("__pos") - F.col("tp")).alias("fn"), (F.col("__neg") - F.col("fp")).alias("tn"),
        clean_round(F.try_divide(F.col("tp").cast("double"), F.col("__pos")), 6).alias("tpr"),
        clean_round(F.try_divide(F.col("fp").cast("double"), F.col("__neg")), 6).alias("fpr"),
    )


def fit_plane(df: DataFrame, x: str, y: str, z: Column, digits: int = 6) -> DataFrame:
    """Least-squares z = a x + b y + c from centred power sums; one combinable pass."""
    d = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), z.alias("z")).filter("z IS NOT NULL")
    g = d.agg(
        F.covar_pop("x", "x").alias("xx"), F.covar_pop("x", "y").alias("xy"), F.covar_pop("y", "y").alias("yy"),
        F.covar_pop("x", "z").alias("xz"), F.covar_pop("y", "z").alias("yz"),
        F.avg("x").alias("mx"), F.avg("y").alias("my"), F.avg("z").alias("mz"),
    )
    det = F.col("xx") * F.col("yy") - F.col("xy") * F.col("xy")
    a = F.try_divide(F.col("xz") * F.col("yy") - F.col("yz") * F.col("xy"), det)
    b = F.try_divide(F.col("yz") * F.col("xx") - F.col("xz") * F.col("xy"), det)
    return g.select(
        clean_round(a, digits).alias("a"), clean_round(b, digits).alias("b"),
        clean_round(F.col("mz") - a * F.col("mx") - b * F.col("my"), digits).alias("c"),
    )


def spearman_with_order(df: DataFrame, keys: Sequence[str], value: str, order: str = "ts") -> DataFrame:
    """Rank correlation of a value with its row order, equal values averaged.

    For gridded series (one row per slot), whose length the window bounds.
    """
    w = W.partitionBy(*keys)
    ties = F.count(F.lit(1)).over(W.partitionBy(*keys, value))
    d = df.select(
        *keys, value,
        F.row_number().over(w.orderBy(order)).cast("double").alias("__i"),
        (F.rank().over(w.orderBy(value)) + (ties - 1) / 2.0).alias("__r"),
    )
    return d.groupBy(*keys).agg(
        F.try_divide(F.covar_pop("__i", "__r"), F.stddev_pop("__i") * F.stddev_pop("__r")).alias("rho"), (F.max(value) - F.min(value)).alias("spread")
    )


def _rising(rho: Column, spread: Column) -> tuple[Column, Column]:
    """Score of a rank correlation with time, and its plus signs."""
    # ten times the correlation, rounded half-even like the source of the rule
    score = F.when(rho > 0.5, F.floor(F.round((F.bround(rho, 1) - 0.5) * 10, 6))).otherwise(0).cast("int")
    return score, F.when(spread > 0.01, F.repeat(F.lit("+"), F.least(score, F.lit(4)))).otherwise("")


def node_annotation(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Node number with plus signs for a steadily growing displacement."""
    s = spearman_with_order(df, keys, value)
    score, plus = _rising(F.col("rho"), F.col("spread"))
    return s.select(
        *keys, clean_round("rho", 6).alias("rho"), score.alias("score"), F.concat(F.col("node_id").cast("string"), plus).alias("text")
    )


def annotations(df: DataFrame, keys: Sequence[str], values: Sequence[str], order: str = "ts") -> DataFrame:
    """`node_annotation` of several axes in one pass: keys and text_<axis>."""
    w = W.partitionBy(*keys)
    rank = lambda v: F.rank().over(w.orderBy(v)) + (F.count(F.lit(1)).over(W.partitionBy(*keys, v)) - 1) / 2.0
    d = df.select(*keys, *values, F.row_number().over(w.orderBy(order)).cast("double").alias("__i"), *[rank(v).alias(f"__r_{v}") for v in values])
    rho = lambda v: F.try_divide(F.covar_pop("__i", f"__r_{v}"), F.stddev_pop("__i") * F.stddev_pop(f"__r_{v}"))
    g = d.groupBy(*keys).agg(*[c for v in values for c in (rho(v).alias(f"__rho_{v}"), (F.max(v) - F.min(v)).alias(f"__spread_{v}"))])
    text = lambda v: F.concat(F.col("node_id").cast("string"), _rising(F.col(f"__rho_{v}"), F.col(f"__spread_{v}"))[1])
    return g.select(*keys, *[text(v).alias(f"text_{v}") for v in values])


def site_activity(triggers: DataFrame, site: str = "site_id", event: str = "event_id", letter: str = "trigger_type") -> DataFrame:
    """Activity scores of a site from its events' trigger letters.

    s / g / m are level-2 subsurface and surface movements, capitals level 3,
    R rain and E quakes; m counts as g. Reduced first to one row per
    (site, event, letter).
    """
    d = triggers.select(F.col(site), F.col(event), F.regexp_replace(F.regexp_replace(letter, "M", "G"), "m", "g").alias("t"))
    d = d.groupBy(site, event, "t").agg(F.count(F.lit(1)).alias("__c"))
    has = lambda *x: F.max(F.when(F.col("t").isin(*x), 1).otherwise(0))
    e = d.groupBy(site, event).agg(
        has("S").alias("S"), has("G").alias("G"), has("s").alias("s2"), has("g").alias("g2"), has("R").alias("R"), has("E").alias("E")
    )
    a3 = F.col("S") + F.col("G")
    # once an event reached level 3 its level-2 letters no longer count as an A2 event
    a2 = F.when(a3 == 0, F.col("s2") + F.col("g2")).otherwise(0)
    move = (a3 + F.col("s2") + F.col("g2")) > 0
    g = e.groupBy(site).agg(
        F.max(F.greatest("S", "s2")).alias("__s"), F.max(F.greatest("G", "g2")).alias("__g"), F.max(F.greatest("S", "G")).alias("__l3"),
        F.count_if(move).alias("__freq"), F.count_if(F.col("R") == 1).alias("rain_event"), F.count_if(F.col("E") == 1).alias("eq_event"),
        F.count_if(a3 == 2).alias("a3_both"), F.count_if(a3 == 1).alias("a3_single"),
        F.count_if(a2 == 2).alias("a2_both"), F.count_if(a2 == 1).alias("a2_single"),
    )
    n = F.col("__freq")
    return g.select(
        site,
        F.when((F.col("__s") == 1) & (F.col("__g") == 1), 2).when((F.col("__s") == 1) | (F.col("__g") == 1), 1).otherwise(0).alias("corr_event"),
        F.when(F.col("__l3") == 1, 4).when(n > 0, 3).otherwise(0).alias("max_event"),
        F.when(n >= 5, 4).when(n >= 3, 3).when(n >= 2, 2).when(n >= 1, 1).otherwise(0).alias("freq_event"),
        "rain_event", "eq_event", "a2_single", "a2_both", "a3_single", "a3_both",
        (F.col("a2_single") + F.col("a2_both") * 1.5 + F.col("a3_single") * 8 + F.col("a3_both") * 12).cast("double").alias("total"),
    )


# --- presence ---------------------------------------------------------------


def data_presence(devices: DataFrame, facts: DataFrame, key: str, now: Column, days: int = 3) -> DataFrame:
    """Last data time per device, whole days since, and a presence flag."""
    last = facts.filter(F.col("ts") <= now).groupBy(key).agg(F.max("ts").alias("last_data"))
    d = devices.join(last, key, "left")
    age = F.floor(seconds_between("last_data", now) / 86400.0)
    return d.withColumns(
        {
            "days": age,
            "presence": F.when(age <= days, 1).otherwise(0),
            "status": F.when(age <= days, "Active").otherwise("For Maintenance"),
        }
    )


# Logger names that are never checked.
EXCLUDED_V2 = ("testa", "testb", "testc", "bulg", "phig", "bgbg", "mycg", "nvcg")
EXCLUDED_V3 = ("madg", "bulg", "phig", "bgbg", "mycg", "nvcg")


def eligible_loggers_v2(loggers: DataFrame) -> DataFrame:
    n = F.col("logger_name")
    return loggers.filter(
        F.col("date_deactivated").isNull() & F.col("logger_type").isin("arq", "regular", "router") & ~n.isin(*EXCLUDED_V2)
        & ~n.like("%___r_%") & ~n.like("%___pz%") & ~n.like("%___x_%")
    )


def eligible_loggers_v3(loggers: DataFrame) -> DataFrame:
    """Kept as written: (type and rain name) or (gateway name and not excluded)."""
    n = F.col("logger_name")
    return loggers.filter(
        (F.col("logger_type").isin("gateway", "arq") & n.like("%___r_%")) | (n.like("%___g%") & ~n.isin(*EXCLUDED_V3))
    )


def uptime(alerts: DataFrame) -> DataFrame:
    """Sites up per time; a site is down when its alert holds ``nd`` or ``0``."""
    text = F.regexp_replace(F.lower("internal_alert"), "a0", "")
    return alerts.groupBy("ts").agg(F.count_if(~text.rlike("nd|0")).alias("site_count"))
