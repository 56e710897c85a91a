"""Warning release calendar, recipients and what was sent."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.clock import at, release_time, span
from ..operators.intervals import by_days

ROUTINE_DAYS = (2, 3, 5)  # ISO weekdays with routine releases


def site_name(special_municipality: tuple = (), special_sitio: tuple = (), key: str = "site_id") -> Column:
    """Display name of a site; a few sites go by municipality or sitio alone."""
    plain = F.lower(F.concat_ws(", ", "barangay", "municipality"))
    plain = F.trim(F.regexp_replace(F.replace(plain, F.lit("city"), F.lit("")), r"\.", ""))
    return (
        F.when(F.col(key).isin(*special_municipality), F.lower("municipality"))
        .when(F.col(key).isin(*special_sitio), F.replace(F.lower("sitio"), F.lit(" "), F.lit(" | ")))
        .otherwise(plain)
    )


def routine_schedule(seasons: DataFrame, plan: DataFrame, start: str, end: str) -> DataFrame:
    """Routine releases at 11:30 of the sites whose season plans that weekday.

    ``seasons``: site_id, month, season_type; ``plan``: season_type, iso_week_day.
    The calendar has a few rows a day of the range, however many sites there are,
    and is broadcast: Spark's estimate leaves out the months a season row is
    exploded from and would take the seasons for the smaller side.
    """
    spark = seasons.sparkSession
    days = spark.sql(
        f"SELECT d, month(d) AS month, weekday(d) + 1 AS iso_week_day FROM (SELECT explode(sequence(DATE'{start[:10]}', DATE'{end[:10]}')) AS d)"
    ).filter(F.col("iso_week_day").isin(*ROUTINE_DAYS))
    calendar = days.join(plan, "iso_week_day").select("month", "season_type", "d")
    return seasons.join(F.broadcast(calendar), ["month", "season_type"]).select(
        "site_id", (F.col("d").cast("timestamp_ntz") + span(mins=690)).alias("data_ts")
    )


def event_flags(rows: DataFrame) -> DataFrame:
    """Quake flag per event; observation flag per event and level."""
    eq = F.max(F.when(F.col("alert_symbol") == "E", 1).otherwise(0)).over(W.partitionBy("event_id"))
    ob = F.max(F.when(F.col("alert_symbol").isin("m", "M"), 1).otherwise(0)).over(W.partitionBy("event_id", "pub_sym_id"))
    return rows.withColumns({"eq": eq, "moms": F.greatest(ob, 1 - F.col("has_markers"))})


def _daylight(ts: Column) -> Column:
    return F.hour(release_time(ts)).between(8, 16).cast("int")


def event_schedule(rows: DataFrame, routine: DataFrame) -> DataFrame:
    """Onset, four-hourly, lowering and extended releases of every event.

    ``rows``: event_id, site_id, data_ts, alert_symbol, pub_sym_id, validity,
    has_markers (0 / 1), eq, moms. An event has a handful of rows, and its
    grid is bounded by its validity.
    """
    half = span(mins=30)
    ev = rows.groupBy("event_id", "site_id").agg(
        F.max("validity").alias("validity"), F.min("data_ts").alias("first_ts"), F.max("has_markers").alias("has_markers"),
        F.min(F.when(F.col("eq") == 1, F.col("data_ts"))).alias("eq_from"), F.min(F.when(F.col("moms") == 1, F.col("data_ts"))).alias("moms_from"),
        F.max_by("pub_sym_id", "data_ts").alias("last_sym"),
        F.array_distinct(F.collect_list(F.when(
            (F.hour("data_ts") % 4 == 3) & F.minute("data_ts").isin(0, 30), release_time("data_ts")))).alias("late"),
        F.collect_list(release_time("data_ts") - half).alias("next"),
    )
    carry = ["event_id", "site_id", "has_markers", "eq_from", "moms_from"]
    out = ["data_ts", "kind", "pub_sym_id", "permission", "meas"]

    days = routine.select("site_id", F.to_date("data_ts").alias("__d")).distinct().withColumn("__routine", F.lit(1))
    t = F.col("data_ts")
    on = rows.join(ev.select(*carry[:2], "first_ts", "eq_from", "moms_from"), ["event_id", "site_id"])
    on = on.join(days, (on.site_id == days.site_id) & (F.to_date(on.data_ts) == days["__d"]), "left").drop(days.site_id)
    mins = F.hour(t) * 60 + F.minute(t)
    opening = (F.col("__routine").isNotNull() & mins.between(570, 720)).cast("int")
    later = ((F.timestamp_diff("MINUTE", t, release_time(t)) <= 150) & (_daylight(t) == 1)).cast("int")
    onset = on.select(
        *carry, t, F.lit("onset").alias("kind"), "pub_sym_id",
        ((F.col("alert_symbol") == "D") | (F.col("pub_sym_id") == 4)).cast("int").alias("permission"),
        F.when(t == F.col("first_ts"), opening).otherwise(later).alias("meas"),
    )
    low_ts = F.col("validity") - half
    lowering = ev.select(
        *carry, low_ts.alias("data_ts"), F.lit("lowering").alias("kind"), F.col("last_sym").alias("pub_sym_id"),
        (F.col("last_sym") == 4).cast("int").alias("permission"), _daylight(low_ts).alias("meas"),
    )
    a, b = release_time("first_ts"), F.col("validity") - span(hours=4)
    grid = ev.filter(a <= b).select("*", F.explode(F.sequence(a, b, span(hours=4))).alias("r"))
    grid = grid.filter(~F.array_contains("late", F.col("r"))).withColumn("data_ts", F.col("r") - half)
    regular = grid.select(
        *carry, "data_ts", F.lit("regular").alias("kind"), F.lit(None).cast("int").alias("pub_sym_id"), F.lit(0).alias("permission"),
        F.when(F.array_contains("next", F.col("data_ts")), 0).otherwise(_daylight(F.col("data_ts"))).alias("meas"),
    )
    d = onset.unionByName(regular).unionByName(lowering)
    order = F.when(F.col("kind") == "regular", 0).when(F.col("kind") == "onset", 1).otherwise(2)
    w = W.partitionBy("event_id").orderBy("data_ts", order)
    d = d.withColumn("pub_sym_id", F.last("pub_sym_id", ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0)))
    marked = F.col("has_markers") == 1
    d = d.select(
        "event_id", "site_id", "data_ts", "pub_sym_id", "permission",
        (F.col("kind") == "onset").cast("int").alias("raising"), (F.col("kind") == "lowering").cast("int").alias("lowering"),
        F.lit(1).alias("event"), F.lit(0).alias("extended"),
        F.coalesce((F.col("data_ts") >= F.col("eq_from")).cast("int"), F.lit(0)).alias("eq"),
        F.when(marked, F.col("meas")).otherwise(0).alias("gndmeas"),
        F.when(~marked, F.col("meas")).when(F.col("data_ts") >= F.col("moms_from"), F.col("meas")).otherwise(0).alias("moms"),
    )
    day = F.to_date("validity").cast("timestamp_ntz")
    ext = ev.select("*", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("k")).select(
        "event_id", "site_id", (day + span(mins=F.lit(2130) + F.col("k") * 1440)).alias("data_ts"), F.lit(1).alias("pub_sym_id"), F.lit(0).alias("permission"),
        F.lit(0).alias("raising"), F.lit(0).alias("lowering"), F.lit(0).alias("event"), F.lit(1).alias("extended"), F.lit(0).alias("eq"),
        F.col("has_markers").alias("gndmeas"), (1 - F.col("has_markers")).alias("moms"),
    )
    return d.unionByName(ext)


def release_schedule(events: DataFrame, routine: DataFrame, start: Column, end: Column) -> DataFrame:
    """Event and routine releases, one per site and time, inside the range.

    The higher level wins, then the non-extended row. A site lowered before
    08:00 loses its 11:30 release of that day.
    """
    z = F.lit(0)
    base = routine.select(
        F.lit(None).cast("bigint").alias("event_id"), "site_id", "data_ts", F.lit(1).alias("pub_sym_id"), z.alias("permission"), z.alias("raising"),
        z.alias("lowering"), z.alias("event"), z.alias("extended"), z.alias("eq"), F.lit(1).alias("gndmeas"), z.alias("moms"),
    )
    d = events.unionByName(base)
    w = W.partitionBy("site_id", "data_ts").orderBy(
        F.col("pub_sym_id").desc(), "extended", F.col("event").desc(), F.col("raising").desc(), F.col("lowering").desc(), F.col("event_id").desc()
    )
    d = d.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")
    gone = events.filter((F.col("lowering") == 1) & (F.hour("data_ts") < 8)).select(
        "site_id", (F.to_date("data_ts").cast("timestamp_ntz") + span(mins=690)).alias("data_ts")
    ).distinct()
    d = d.join(gone, ["site_id", "data_ts"], "left_anti")
    return d.filter((F.col("data_ts") >= start - span(mins=30)) & (F.col("data_ts") <= end - span(mins=30)))


# --- due times ---------------------------------------------------------------


@dataclass(frozen=True)
class Policy:
    """Minutes: start after data time, target, per extra site, lowering, raising."""

    start: int
    due: int
    extra: int = 0
    lowering: int = 0
    raising: int | None = None


# Targets of each product.
POLICIES = {
    "sms": Policy(30, 5, 1, 15, 55), "bulletin": Policy(30, 10, 2, 15, 60), "web": Policy(20, 10, 0, 0, 50), "rain": Policy(30, 15),
}


def due_times(sched: DataFrame, policy: Policy) -> DataFrame:
    """Latest acceptable time per release.

    All routine releases of a slot count as one site.
    """
    special = (F.col("event") == 1) | (F.col("extended") == 1)
    n = sched.groupBy("data_ts").agg(F.count_if(special).alias("__s"), F.max((~special).cast("int")).alias("__r"))
    d = sched.join(n, "data_ts").withColumn("__n", F.col("__s") + F.col("__r"))
    mins = F.lit(policy.start + policy.due) + F.greatest(F.lit(0), F.col("__n") - 5) * policy.extra
    mins = mins + F.when(F.col("lowering") == 1, policy.lowering).otherwise(0)
    if policy.raising is not None:
        mins = F.when(F.col("raising") == 1, F.lit(policy.raising)).otherwise(mins)
    return d.withColumn("ts_due", F.col("data_ts") + span(mins=mins.cast("int"))).drop("__s", "__r", "__n")


def release_ts(day: Column, clock: Column, data_ts: Column) -> Column:
    """Release time from a date and minutes; a value before the data is a day late."""
    t = day.cast("timestamp_ntz") + span(mins=clock)
    return F.when(t < data_ts, t - span(days=1)).otherwise(t)


# --- recipients and matching ---------------------------------------------------

LOCAL_OFFICES = ("lewc", "blgu", "mlgu")


def recipients(contacts: DataFrame, staff: DataFrame) -> DataFrame:
    """Active recipients outside the staff with the lowest level they get.

    A restriction raises it by one; offices beyond the locality get events only.
    """
    d = contacts.filter("active = 1 AND receives = 1").join(staff.select("user_id").distinct(), "user_id", "left_anti")
    level = F.when(F.col("alert_restriction").isNotNull(), F.col("alert_restriction") + 1).when(
        ~F.col("org_name").isin(*LOCAL_OFFICES), 1
    ).otherwise(0)
    return d.select("user_id", "site_id", "org_name", level.alias("alert_level"))


def match_sent(sched: DataFrame, people: DataFrame, sent: DataFrame, hours: int = 4) -> DataFrame:
    """First message to each recipient within the hours after the data time.

    Joined on (site, user, day); recipients above the release level drop out.
    """
    due = sched.join(people, "site_id").filter(F.col("pub_sym_id") - 1 >= F.col("alert_level"))
    span_rows = by_days(due.select("release_id", "site_id", "user_id", "data_ts"), F.col("data_ts"), F.col("data_ts") + span(hours=hours))
    s = sent.select("site_id", "user_id", F.col("ts_written").alias("__t"), F.to_date("ts_written").alias("__day"))
    hit = span_rows.join(s, ["site_id", "user_id", "__day"]).filter(F.col("__t").between(F.col("data_ts"), F.col("data_ts") + span(hours=hours)))
    first = hit.groupBy("release_id", "user_id").agg(F.min("__t").alias("ts_written"))
    return due.join(first, ["release_id", "user_id"], "left")


def match_text(due: DataFrame, sent: DataFrame, hours: int = 4) -> DataFrame:
    """Messages to a number that name the site, and which figures they give.

    ``due``: release_id, mobile_id, name, data_ts, mm_values, percentage;
    ``sent``: mobile_id, ts_written, sms_msg. Equality on (mobile, day) first,
    the text test on what remains.
    """
    s = sent.select("mobile_id", "ts_written", "sms_msg", F.to_date("ts_written").alias("__day"))
    w = by_days(due, F.col("data_ts"), F.col("data_ts") + span(hours=hours))
    hit = w.join(s, ["mobile_id", "__day"]).filter(
        F.col("ts_written").between(F.col("data_ts"), F.col("data_ts") + span(hours=hours)) & F.contains("sms_msg", "name")
    )
    mm = F.col("sms_msg").contains("mm") & F.col("sms_msg").contains("threshold")
    g = hit.groupBy("release_id", "mobile_id").agg(
        F.min("ts_written").alias("ts_written"), F.max(mm.cast("int")).alias("__mm"), F.max(F.col("sms_msg").contains("%").cast("int")).alias("__pc")
    )
    d = due.join(g, ["release_id", "mobile_id"], "left")
    no_mm = (F.col("mm_values") == 1) & (F.coalesce("__mm", F.lit(0)) == 0)
    no_pc = (F.col("percentage") == 1) & (F.coalesce("__pc", F.lit(0)) == 0)
    text = F.when(no_mm & no_pc, "(mm and percentage)").when(no_mm, "(mm)").when(no_pc, "(percentage)")
    return d.withColumn("unwritten_info", text).drop("__mm", "__pc")


def unsent(matched: DataFrame, names: DataFrame) -> DataFrame:
    """Recipients without a message, per release; a site without a name keeps its rows."""
    return matched.filter("ts_written IS NULL").join(names, "site_id", "left").select("release_id", "site_id", "site_name", "user_id").distinct()


def missing_offices(matched: DataFrame, required: list[str]) -> DataFrame:
    """Required offices nobody of which was written to, per release."""
    g = matched.groupBy("release_id").agg(F.collect_set(F.when(F.col("ts_written").isNotNull(), F.col("org_name"))).alias("__got"))
    need = F.array(*[F.lit(r) for r in sorted(required)])
    return g.select("release_id", F.array_join(F.array_sort(F.array_except(need, "__got")), ",").alias("missing")).filter("missing <> ''")


def tagged_messages(messages: DataFrame, tags: DataFrame, contacts: DataFrame, start: Column, end: Column) -> DataFrame:
    """Tagged messages of a period with the sender's site and office."""
    m = messages.filter((F.col("ts") >= start) & (F.col("ts") <= end))
    return m.join(tags, "inbox_id").join(contacts.select("user_id", "site_id", "org_name"), "user_id", "left")


def to_validate(tagged: DataFrame, levels: DataFrame, at: Column, hours: int = 36) -> DataFrame:
    """Recent tagged observations whose marker level is still zero."""
    d = tagged.filter((F.col("ts") > at - span(hours=hours)) & (F.col("ts") <= at))
    return d.join(levels.filter("alert_level = 0").select("data_id"), "data_id").select(
        "data_id", F.concat(F.lit("validate "), F.col("site_id").cast("string"), F.lit(" "), F.date_format("ts", "yyyy-MM-dd HH:mm")).alias("message")
    )


def monitored(events: DataFrame, seasons: DataFrame, plan: DataFrame, slot: str) -> DataFrame:
    """Sites watched at a release slot: event, extended or routine."""
    t = at(slot)
    ev = events.groupBy("site_id").agg(
        F.max((F.col("ts_start") >= t - span(hours=4)).cast("int")).alias("ins"), F.max("validity").alias("validity")
    )
    active = (F.col("ins") == 1) | (F.col("validity") >= t)
    a = ev.filter(active).select("site_id", F.lit("event").alias("mon_type"))
    if not slot[11:13] == "12":
        return a
    x = ev.filter(~active & (F.col("validity") < F.lit(slot[:10]).cast("timestamp_ntz"))).select("site_id", F.lit("extended").alias("mon_type"))
    day = F.lit(slot[:10]).cast("date")
    r = seasons.filter(F.col("month") == F.month(day)).join(plan.filter(F.col("iso_week_day") == F.weekday(day) + 1), "season_type").select("site_id").distinct()
    r = r.join(a.unionByName(x), "site_id", "left_anti").withColumn("mon_type", F.lit("routine"))
    return a.unionByName(x).unionByName(r)
