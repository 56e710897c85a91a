"""How promptly, completely and correctly warnings were handled, per shift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.clock import clean_round, release_time, seconds_between, shift_of, span
from ..operators.intervals import by_days


def timeliness(sent: DataFrame, unit_minutes: float, keys: Sequence[str] = ()) -> DataFrame:
    """Mean grade of a shift: a tenth off per unit of delay, nothing sent is 0."""
    late = F.greatest(F.lit(0.0), seconds_between("ts_due", "ts_written")) / (60.0 * unit_minutes)
    g = F.when(F.col("ts_written").isNull(), 0.0).otherwise(1.0 - late * 0.1)
    return sent.withColumn("shift_ts", shift_of("data_ts")).groupBy(*keys, "shift_ts").agg(clean_round(F.avg(g), 4).alias("grade"))


def web_timeliness(sent: DataFrame, unit_minutes: float = 3) -> DataFrame:
    """Delay in whole units, early releases count too, floor at zero."""
    late = F.greatest(F.lit(0.0), seconds_between("ts_due", "ts_release"), seconds_between("ts_release", "ts_start"))
    g = F.when(F.col("ts_release").isNull(), 0.0).otherwise(1.0 - F.least(F.lit(1.0), F.ceil(late / (60.0 * unit_minutes)) * 0.1))
    return sent.withColumn("shift_ts", shift_of("data_ts")).groupBy("shift_ts").agg(clean_round(F.avg(g), 4).alias("grade"))


def quality(counts: DataFrame, evals: DataFrame, weights: dict[str, float], keys: Sequence[str], cap: float | None = None) -> DataFrame:
    """(n - weighted errors) / n from the latest evaluation of each shift.

    ``counts``: keys, n; ``evals``: keys, ts, eval_id and the error columns.
    """
    last = evals.groupBy(*keys).agg(F.max_by(F.struct(*weights), F.struct("ts", "eval_id")).alias("e"))
    err = F.lit(0.0)
    for c, w in weights.items():
        err = err + F.coalesce(F.col(f"e.{c}"), F.lit(0)) * F.lit(w)
    if cap is not None:
        err = F.least(F.lit(cap), err)
    d = counts.join(last, list(keys), "left")
    return d.select(*keys, "n", clean_round((F.col("n") - err) / F.col("n"), 4).alias("grade"))


def notification_deductions(releases: DataFrame, notes: DataFrame, tags: DataFrame, lead_hours: int = 1) -> DataFrame:
    """Deductions for late or wrong notifications of raised and lowered sites.

    ``releases``: release_id, site_id, data_ts, shift_end. Notes and tags carry
    site_id and ts. Time: a tenth per started ten minutes past the release.
    Quality: one tag 0, none 1, repeats by the time of the first (0.2 / 0.6 / 1).
    """
    start = F.col("data_ts") - span(hours=lead_hours)
    d = releases.withColumns({"__a": start, "__end": release_time(start + span(hours=1))})
    w = by_days(d.select("release_id", "site_id", "__a", "shift_end"), F.col("__a"), F.col("shift_end"))

    def within(x: DataFrame) -> DataFrame:
        x = x.select("site_id", F.col("ts").alias("__t"), F.to_date("ts").alias("__day"))
        return w.join(x, ["site_id", "__day"]).filter(F.col("__t").between(F.col("__a"), F.col("shift_end")))

    n = within(notes).groupBy("release_id").agg(F.max("__t").alias("__last"))
    g = within(tags).groupBy("release_id").agg(F.count(F.lit(1)).alias("__n"), F.min("__t").alias("__first"))
    d = d.join(n, "release_id", "left").join(g, "release_id", "left")
    late = F.ceil(F.greatest(F.lit(0.0), seconds_between("__end", "__last")) / 600.0) * 0.1
    q = (
        F.when(F.coalesce("__n", F.lit(0)) == 0, 1.0).when(F.col("__n") == 1, 0.0)
        .when(F.col("__first") <= F.col("__a") + span(hours=1), 0.2).when(F.col("__first") <= F.col("__end"), 0.6).otherwise(1.0)
    )
    none = F.col("__last").isNull()
    return d.select(
        "release_id", "site_id", F.when(none, 1.0).otherwise(clean_round(late, 4)).alias("deduction_t"), F.when(none, 1.0).otherwise(q).alias("deduction_q")
    )


def reminder_check(sched: DataFrame, measured: DataFrame, reminded: DataFrame) -> DataFrame:
    """1 when exactly one happened: the site measured, or it was reminded."""
    remind = F.col("data_ts") - span(hours=2)
    start = F.col("data_ts") - span(mins=210) - F.when(F.col("event") != 1, span(hours=4)).otherwise(span(hours=0))
    d = sched.withColumns({"__a": start, "__r": remind})

    def any_in(x: DataFrame, lo: Column, hi: Column, name: str) -> DataFrame:
        w = by_days(d.select("release_id", "site_id", lo.alias("__lo"), hi.alias("__hi")), F.col("__lo"), F.col("__hi"))
        x = x.select("site_id", F.col("ts").alias("__t"), F.to_date("ts").alias("__day"))
        hit = w.join(x, ["site_id", "__day"]).filter((F.col("__t") >= F.col("__lo")) & (F.col("__t") < F.col("__hi")))
        return hit.select("release_id").distinct().withColumn(name, F.lit(1))

    m = any_in(measured, F.col("__a"), F.col("__r"), "__m")
    s = any_in(reminded, F.col("__r") - span(mins=5), F.col("__r") + span(mins=30), "__s")
    j = d.join(m, "release_id", "left").join(s, "release_id", "left")
    return j.select("release_id", "site_id", (F.coalesce("__m", F.lit(0)) + F.coalesce("__s", F.lit(0)) == 1).cast("int").alias("reminder"))


def evaluation_grade(shifts: DataFrame, evals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """1 within four hours of the shift end, then two fifteenths per started hour."""
    last = evals.groupBy(*keys).agg(F.max("ts").alias("__t"))
    d = shifts.join(last, list(keys), "left")
    hours = F.ceil(seconds_between(F.col("shift_end") + span(hours=4), F.col("__t")) / 3600.0)
    g = F.when(F.col("__t").isNull(), 0.0).when(hours <= 0, 1.0).otherwise((15.0 - F.least(F.lit(15), hours * 2)) / 15.0)
    return d.select(*keys, clean_round(g, 4).alias("grade"))


def _overlap_hours(a: Column, b: Column, c: Column, d: Column) -> Column:
    return F.greatest(F.lit(0.0), seconds_between(F.greatest(a, c), F.least(b, d)) / 3600.0)


def attendance(shifts: DataFrame, punches: DataFrame, grace_minutes: int = 15, full_hours: float = 12.5) -> DataFrame:
    """Share of a shift, widened by the grace, covered by clocked time."""
    g = span(mins=grace_minutes)
    s = shifts.withColumns({"__a": F.col("shift_ts") - g, "__b": F.col("shift_ts") + span(hours=12) + g})
    s = by_days(s, F.col("__a"), F.col("__b"))
    p = by_days(punches.select("staff_id", "punch_id", "time_in", "time_out"), F.col("time_in"), F.col("time_out"))
    hit = s.join(p, ["staff_id", "__day"]).select("staff_id", "shift_ts", "punch_id", _overlap_hours(F.col("__a"), F.col("__b"), F.col("time_in"), F.col("time_out")).alias("__h"))
    # a punch over midnight meets the shift on two days
    one = hit.groupBy("staff_id", "shift_ts", "punch_id").agg(F.max("__h").alias("__h"))
    tot = one.groupBy("staff_id", "shift_ts").agg(F.sum("__h").alias("__h"))
    return shifts.join(tot, ["staff_id", "shift_ts"], "left").select(
        "staff_id", "shift_ts", clean_round(F.coalesce("__h", F.lit(0.0)) / full_hours, 4).alias("grade")
    )


def availability(shifts: DataFrame, downtime: DataFrame, full_hours: float = 12.5) -> DataFrame:
    """One minus the share of a shift the system was down.

    Where downtime has a column ``reported``, only rows with 0 count: what was
    reported is not held against the shift.
    """
    if "reported" in downtime.columns:
        downtime = downtime.filter("reported = 0")
    e = F.col("shift_ts") + span(hours=12)
    s = by_days(shifts.select("shift_ts").distinct(), F.col("shift_ts"), e)
    w = by_days(downtime.select("down_id", "start_ts", "end_ts"), F.col("start_ts"), F.col("end_ts"))
    hit = s.join(w, "__day").filter((F.col("start_ts") <= e) & (F.col("end_ts") >= F.col("shift_ts")))
    one = hit.groupBy("shift_ts", "down_id").agg(F.max(_overlap_hours(F.col("shift_ts"), e, F.col("start_ts"), F.col("end_ts"))).alias("__h"))
    tot = one.groupBy("shift_ts").agg(F.sum("__h").alias("__h"))
    return shifts.join(tot, "shift_ts", "left").select("shift_ts", clean_round(F.lit(1.0) - F.coalesce("__h", F.lit(0.0)) / full_hours, 4).alias("grade"))


# Fixed value: how an evaluation names an empty list of contacts.
NO_CONTACTS = "NAN EEEE"


def shift_system_grades(shifts: DataFrame, releases: DataFrame, evals: DataFrame, downtime: DataFrame, wanted_contacts: int = 5) -> DataFrame:
    """System, bug-report and contact grades of each person's shift.

    ``shifts``: staff_id, shift_ts. ``releases``: data_ts. ``evals``: staff_id,
    shift_ts, bug_log, relayed, contacts; the first of those within a day of
    the shift's start counts. With a release in the shift the system grade and
    the bug grade stand apart; without one their mean is the system grade, or
    the system grade alone where no bug answer was given, and the contacts
    named count, five for a full mark.
    """
    k = ["staff_id", "shift_ts"]
    e = F.col("shift_ts") + span(hours=12)
    system = availability(shifts.select("shift_ts").distinct(), downtime).withColumnRenamed("grade", "system")
    # shifts start at fixed hours, so a release meets its shifts by day
    days = by_days(shifts.select("shift_ts").distinct(), F.col("shift_ts"), e)
    due = releases.select("data_ts", F.to_date("data_ts").alias("__day")).join(days, "__day")
    held = due.filter((F.col("data_ts") > F.col("shift_ts")) & (F.col("data_ts") <= e)).select("shift_ts").distinct().withColumn("__held", F.lit(True))
    v = evals.select("staff_id", F.col("shift_ts").alias("__t"), "bug_log", "relayed", "contacts", F.explode(F.array(F.date_sub(F.to_date("shift_ts"), 1), F.to_date("shift_ts"))).alias("__day"))
    near = shifts.withColumn("__day", F.to_date("shift_ts")).join(v, ["staff_id", "__day"]).filter((F.col("__t") >= F.col("shift_ts")) & (F.col("__t") <= F.col("shift_ts") + span(days=1)))
    one = near.groupBy(*k).agg(F.min_by(F.struct("bug_log", "relayed", "contacts"), F.struct("__t", "bug_log", "relayed", "contacts")).alias("__v"))
    d = shifts.join(system, "shift_ts").join(held, "shift_ts", "left").join(one, k, "left")
    answers = F.array_compact(F.array("__v.bug_log", "__v.relayed"))
    bug = F.when(F.size(answers) > 0, F.when(F.forall(answers, lambda a: a == "Yes"), 1.0).otherwise(0.0))
    named = F.when(F.col("__v.contacts") == NO_CONTACTS, 0.0).otherwise(F.least(F.lit(1.0), F.size(F.split("__v.contacts", ", ")) / F.lit(float(wanted_contacts))))
    release = F.coalesce("__held", F.lit(False))
    return d.select(
        *k, release.alias("release"),
        clean_round(F.when(release | bug.isNull(), F.col("system")).otherwise((F.col("system") + bug) / 2), 4).alias("system"),
        F.when(release, bug).alias("bug"),
        F.when(~release & F.col("__v").isNotNull() & F.col("__v.contacts").isNotNull(), clean_round(named, 4)).alias("contacts"),
    )


def log_grade(df: DataFrame, keys: Sequence[str], answers: Sequence[str]) -> DataFrame:
    """1 if every given answer is Yes, 0 otherwise, NULL without answers."""
    long = df.select(*keys, F.explode(F.array(*answers)).alias("__a"))
    return long.groupBy(*keys).agg(F.min(F.when(F.col("__a").isNotNull(), (F.col("__a") == "Yes").cast("int"))).alias("grade"))


def peer_rating(evals: DataFrame, person: str, ratings: Sequence[str], top: float = 5.0) -> DataFrame:
    """Mean of all given ratings as a percentage of the top mark."""
    long = evals.unpivot([person], list(ratings), "__q", "__v").filter("__v IS NOT NULL")
    return long.groupBy(person).agg(clean_round(F.avg("__v") * 100 / top, 4).alias("grade"), F.count(F.lit(1)).alias("ratings"))


def metric_facts(reports: DataFrame, metrics: DataFrame, flags: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Report rows with their metric id and one column per sub-metric -> (facts, rejects).

    ``reports.submetrics`` is an array of names; unknown metrics are rejected.
    """
    d = reports.join(metrics.select("type", "metric_name", "metric_id"), ["type", "metric_name"], "left")
    facts = d.filter("metric_id IS NOT NULL").withColumns({f: F.array_contains("submetrics", f).cast("int") for f in flags})
    return facts, d.filter("metric_id IS NULL").drop("metric_id")
