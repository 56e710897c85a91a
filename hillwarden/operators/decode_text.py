"""People's and agencies' texts: observations, quakes, acknowledgements, tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.clock import span


def found(text: Column | str, pattern: str, group: int = 0) -> Column:
    """Regex match or NULL."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def without(text: Column, match: Column) -> Column:
    """Text with the first occurrence of a match removed, left-trimmed."""
    at = F.position(match, text)
    cut = F.concat(F.substr(text, F.lit(1), at - 1), F.substr(text, at + F.length(match)))
    return F.ltrim(F.when(at > 0, cut).otherwise(text))


# --- community observations ---------------------------------------------------

# Error code of the first stage that fails.
ERRORS = {
    "obv_type": 1, "site_code": 2, "date_conversion": 3, "date_no_matches": 4, "date_value_advance": 5,
    "measurement_no_matches": 6, "time_conversion": 7, "time_no_matches": 8, "time_out_of_bounds": 9,
    "weather_no_match": 10, "names_no_matches": 11, "re_parsing_error": 12,
}
# Spellings of site codes, weather words, month names.
SITE_ALIASES = {"man": "mng", "bat": "bto", "tag": "tga", "pan": "png", "pob": "jor"}
WEATHER = ["ARAW", "ULAN", "BAGYO", "LIMLIM", "AMBON", "ULAP", "SUN", "RAIN", "CLOUD", "DILIM", "HAMOG", "INIT"]
MONTHS = "JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC"
SHORT_MONTH = "[JFMASOND][AEPUCO][NBRYLGTVCP]"
LONG_MONTH = "[A-Z]{4,9}"
DAY = "[0-3]{0,1}[0-9]{1}"
YEAR = "20[12]{0,1}[1234567890]{0,1}"
GAP = r"[\. ,:]{0,3}"
# Month-first forms can be read; day-first ones are recognised, so that they
# stop the search, but their text never yields a date.
DATE_FORMS = [
    ("^" + SHORT_MONTH + GAP + DAY + GAP + YEAR, True),
    ("^" + DAY + GAP + SHORT_MONTH + GAP + YEAR, False),
    ("^" + LONG_MONTH + GAP + DAY + GAP + YEAR, True),
    ("^" + DAY + GAP + LONG_MONTH + GAP + YEAR, False),
]
CLOCK_FORMS = [
    r"\d{1,2} *:+ *\d{1,2} *[AP]\.*M\.*",
    r"\d{1,2} *[AP]\.*M\.*",
    r"\d{1,2} *:+ *\d{1,2} *N\.*N\.*",
    r"\d{1,2} *:+ *\d{1,2} +",
]
MEASUREMENT = r"(?<= )([A-Z] *\d{1,3}\.*\d{0,2} *C*M)"
NAME = r"(?:(?<= )|(?<=^))([A-Z]{4,})(?:(?= )|(?=$)|(?=\.$))"


def normalise_text(msg: str = "msg") -> Column:
    t = F.regexp_replace(F.upper(msg), " +", " ")
    t = F.regexp_replace(t, r"\.+", ".")
    t = F.regexp_replace(F.regexp_replace(t, ";", ":"), "\n", " ")
    return F.regexp_replace(F.trim(t), r"[\"#$%&'()*+\-/;<=>?@\[\\\]^_`{|}~]", " ")


def extract_observations(messages: DataFrame, sites: DataFrame, as_of: Column, max_age_days: int = 90) -> DataFrame:
    """One row per message with its fields, or ``err_code`` of the first failure.

    Each stage reads what the previous ones left and removes its own match.
    ``sites``: site_code, site_id. ``as_of`` stands for the current time.
    """
    e = ERRORS
    d = messages.withColumn("__t0", normalise_text())
    # kind of observation
    kind = found("__t0", r"^(ROUTINE\W+|R0UTINE\W+|EVENT\W+|EVNT\W+)")
    d = d.withColumn("__k", kind)
    d = d.withColumns(
        {
            "meas_type": F.when(F.col("__k").rlike("^R"), "ROUTINE").when(F.col("__k").isNotNull(), "EVENT"),
            "__t1": without(F.col("__t0"), F.col("__k")),
        }
    )
    # site
    code = F.lower(F.substring(F.element_at(F.split("__t1", " "), 1), 1, 3))
    alias = F.create_map(*[F.lit(x) for kv in SITE_ALIASES.items() for x in kv])
    d = d.withColumns({"site_code": F.coalesce(alias[code], code), "__t2": F.ltrim(F.substr("__t1", F.length(code) + 1))})
    d = d.join(sites.select("site_code", "site_id"), "site_code", "left")
    # date
    hit, first = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for pattern, month_first in reversed(DATE_FORMS):
        m = found("__t2", pattern)
        hit, first = F.coalesce(m, hit), F.when(m.isNotNull(), month_first).otherwise(first)
    d = d.withColumns({"__dm": hit, "__mf": first})
    bare = F.regexp_replace("__dm", "[^A-Z0-9]", "")
    digits = F.regexp_replace(bare, "[A-Z]+", "")
    pos = F.position(F.substring(bare, 1, 3), F.lit(MONTHS))
    month = F.when((pos > 0) & (pos % 3 == 1), ((pos + 2) / 3).cast("int"))
    ymd = F.concat_ws("-", F.substr(digits, F.length(digits) - 3), month, F.substr(digits, F.lit(1), F.length(digits) - 4))
    day = F.when(F.col("__mf") & month.isNotNull() & F.length(digits).between(5, 6), F.try_to_timestamp(ymd, F.lit("yyyy-M-d")).cast("timestamp_ntz"))
    d = d.withColumns({"__date": day, "__t3": without(F.col("__t2"), F.col("__dm"))})
    # time
    form, tm = F.lit(None).cast("int"), F.lit(None).cast("string")
    for n in range(len(CLOCK_FORMS) - 1, -1, -1):
        m = found("__t3", CLOCK_FORMS[n])
        form, tm = F.when(m.isNotNull(), n).otherwise(form), F.coalesce(m, tm)
    d = d.withColumns({"__form": form, "__tm": tm})
    clean = F.regexp_replace("__tm", "[^APM0-9:]", "")
    h = F.regexp_extract(clean, r"^(\d{1,2})(?::(\d{1,2}))?([AP]M)?$", 1).try_cast("int")
    mi = F.coalesce(F.regexp_extract(clean, r"^(\d{1,2})(?::(\d{1,2}))?([AP]M)?$", 2).try_cast("int"), F.lit(0))
    pm = clean.rlike("PM$")
    twelve = F.col("__form") <= 1
    hour = F.when(twelve, F.when(h.between(1, 12), h % 12 + F.when(pm, 12).otherwise(0))).otherwise(F.when(h.between(0, 23), h))
    d = d.withColumns({"__min": F.when(mi <= 59, hour * 60 + mi), "__t4": without(F.col("__t3"), F.col("__tm"))})
    d = d.withColumn("obs_ts", F.col("__date") + span(mins=F.col("__min")))
    # measurements
    padded = F.concat(F.lit(" "), F.col("__t4"))
    d = d.withColumns(
        {
            "__ms": F.regexp_extract_all(padded, F.lit(MEASUREMENT), F.lit(1)),
            "__t5": F.ltrim(F.regexp_replace(padded, MEASUREMENT, "")),
        }
    )
    # weather
    w = F.coalesce(*[found("__t5", rf"(?i)(?:(?<= )|(?<=^))[A-Z]*{k}[A-Z]*(?= )") for k in WEATHER])
    d = d.withColumn("weather", w)
    d = d.withColumn("__t6", without(F.col("__t5"), F.col("weather")))
    d = d.withColumn("__names", F.regexp_extract_all("__t6", F.lit(NAME), F.lit(1)))
    err = (
        F.when(F.col("__k").isNull(), e["obv_type"])
        .when(F.col("site_id").isNull(), e["site_code"])
        .when(F.col("__date").isNull(), e["date_no_matches"])
        .when((F.col("__date") > as_of) | (F.col("__date") < as_of - span(days=max_age_days)), e["date_value_advance"])
        .when(F.col("__tm").isNull(), e["time_no_matches"])
        .when(F.col("__min").isNull(), e["time_conversion"])
        .when((F.col("__min") > 19 * 60) | (F.col("__min") < 5 * 60), e["time_out_of_bounds"])
        .when(F.col("obs_ts") > as_of, e["date_value_advance"])
        .when(F.size("__ms") == 0, e["measurement_no_matches"])
        .when(F.col("weather").isNull(), e["weather_no_match"])
        .when(F.size("__names") == 0, e["names_no_matches"])
    )
    ok = err.isNull()
    value = lambda m: F.regexp_extract(m, r"\d{1,3}\.*\d{0,2}", 0).try_cast("double")
    meas = F.transform("__ms", lambda m: F.struct(F.substring(m, 1, 1).alias("marker_name"), value(m).alias("measurement")))
    fields = [
        err.alias("err_code"), *[F.when(ok, F.col(c)).alias(c) for c in ("meas_type", "site_id", "site_code", "obs_ts", "weather")],
        F.when(ok, F.array_join("__names", " ")).alias("observer_name"), F.when(ok, meas).alias("measurements"),
    ]
    # A generator, so that later filters on the outcome are not pushed into
    # (and do not repeat) the chain of stages above.
    return d.select("inbox_id", F.explode(F.array(F.struct(*fields))).alias("o")).select("inbox_id", "o.*")


def observation_measurements(obs: DataFrame) -> DataFrame:
    """One row per reported marker; a repeated name keeps its last value."""
    d = obs.filter("err_code IS NULL").select("inbox_id", "site_id", "obs_ts", F.posexplode("measurements").alias("p", "m"))
    return d.groupBy("inbox_id", "site_id", "obs_ts", F.col("m.marker_name").alias("marker_name")).agg(
        F.max_by("m.measurement", "p").alias("measurement")
    )


# --- quakes -------------------------------------------------------------------


def extract_quakes(messages: DataFrame) -> DataFrame:
    """Agency bulletin: every field but the issuer must be there."""
    m = "msg"
    date = F.upper(found(m, r"(?i)\d{1,2}[a-z]+\d{4}"))
    time = F.upper(F.regexp_replace(F.replace(found(m, r"(?i)\d{1,2}[:\.]\d{1,2} *[AP]M"), F.lit(" "), F.lit("")), r"\.", ":"))
    depth = found(found(m, r"(?i)(?<=D)\D+(?<=[\=\:]) *\d+((?= )|(?=K*M))"), r"\d+")
    stamp = F.try_to_timestamp(
        F.concat(F.lpad(found(date, r"^\d{1,2}"), 2, "0"), F.initcap(F.substring(found(date, r"[A-Z]+"), 1, 3)), F.substring(date, -4, 4), F.lit(" "), F.lpad(time, 7, "0")),
        F.lit("ddMMMyyyy hh:mma"),
    ).cast("timestamp_ntz")
    return messages.select(
        "inbox_id", stamp.alias("event_ts"),
        found(m, r"(?i)((?<=M[SBLVOW]=)|(?<=M=)|(?<=MLV=)|(?<=MWP=))\d+\.\d+(?= )").try_cast("double").alias("magnitude"),
        depth.try_cast("double").alias("depth"), found(m, r"(?i)\d+\.\d+(?=N)").try_cast("double").alias("latitude"),
        found(m, r"(?i)\d+\.\d+(?=E)").try_cast("double").alias("longitude"), found(m, r"(?i)(?<=<)[A-Z/]+(?=>)").alias("issuer"),
    ).dropna(subset=["event_ts", "magnitude", "depth", "latitude", "longitude"])


def extract_posts(messages: DataFrame) -> DataFrame:
    """Labelled post form: Date and Time, Magnitude, Depth, Location with province."""
    m = "msg"
    stamp = F.try_to_timestamp(F.trim(found(m, r"(?<=Date and Time:)[ \:\-\w\d]*[AP]M")), F.lit("dd MMM yyyy - hh:mm a"))
    coord = r"(?<=Location =)([ \d\.]*)N[ \,]*([ \d\.]*)(?=E)"
    place = found(m, r"(?<=Location =)([ \d\.\w\,\-°]*)\(([ \w\)\(]*)(?=\))", 2)
    num = lambda c: F.trim(c).try_cast("double")
    return messages.select(
        "inbox_id", stamp.cast("timestamp_ntz").alias("event_ts"), num(found(m, r"(?<=Magnitude =)[ \d\.]*")).alias("magnitude"),
        num(found(m, r"(?<=Depth =)[ \d\.]*(?=kilometers)")).alias("depth"), num(found(m, coord, 1)).alias("latitude"),
        num(found(m, coord, 2)).alias("longitude"), F.trim(F.element_at(F.split(place, r"\("), -1)).alias("province"),
    ).dropna(subset=["event_ts", "magnitude", "depth", "latitude", "longitude", "province"])


CELLS = ["event_ts", "latitude", "longitude", "depth", "magnitude", "location"]


def html_cells(html: str = "html") -> Column:
    """Array of table rows, each an array of non-empty cell texts."""
    rows = F.regexp_extract_all(html, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))
    text = lambda c: F.regexp_replace(F.trim(F.regexp_replace(F.regexp_replace(c, r"(?s)<[^>]*>", "\u0001"), r"\s*\u0001\s*", "\u0001")), "\u0001", "")
    cells = lambda r: F.filter(
        F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<td[^>]*>(.*?)</td>"), F.lit(1)), lambda c: F.trim(text(c))), lambda x: x != ""
    )
    return F.filter(F.transform(rows, cells), lambda r: F.size(r) > 0)


def extract_html_events(pages: DataFrame) -> DataFrame:
    """Quake rows of a page; a row with two events' cells splits in two."""
    n = len(CELLS)
    d = pages.select("page_id", F.explode(html_cells()).alias("__r"))
    half = (F.size("__r") / 2).cast("int")
    split = F.when(F.size("__r") == n, F.array("__r")).otherwise(
        F.array(F.slice(F.col("__r"), F.lit(1), half), F.slice(F.col("__r"), half + 1, F.size("__r")))
    )
    d = d.select("page_id", F.explode(split).alias("__c")).filter(F.size("__c") == n)
    d = d.select("page_id", *[F.col("__c")[k].alias(c) for k, c in enumerate(CELLS)])
    exact = F.element_at(F.split("location", r"\("), 1)
    last = F.element_at(F.split("location", r"\("), -1)
    return d.withColumns(
        {
            "event_ts": F.coalesce(*[F.try_to_timestamp("event_ts", F.lit(f)) for f in ("dd MMMM yyyy - hh:mm a", "dd MMM yyyy - hh:mm a", "yyyy-MM-dd HH:mm:ss")]).cast("timestamp_ntz"),
            **{c: F.col(c).try_cast("double") for c in ("latitude", "longitude", "depth", "magnitude")},
            "province": F.regexp_replace(last, r"^\)+|\)+$", ""),
            "municipality": F.rtrim(F.try_element_at(F.split(exact, "of "), F.lit(2))),
        }
    ).filter("event_ts IS NOT NULL")


# --- acknowledgements and sync ------------------------------------------------

# Validity words.
VALIDITY = {"validating": 0, "valid": 1, "invalid": -1}


def extract_acks(messages: DataFrame) -> DataFrame:
    """Status id, validity and remarks; texts without either give nothing."""
    words = F.create_map(*[F.lit(x) for kv in VALIDITY.items() for x in kv])
    remarks = found("msg", r"(?i)(?<=\d ).+(?=($|\r|\n))")
    d = messages.withColumns({"stat_id": found("msg", r"(?i)(?<=K )\d+(?= )").try_cast("bigint"), "__r": remarks})
    d = d.withColumn("__w", found("__r", r"(?i)(in)*valid(ating)*"))
    return d.select(
        "inbox_id", "stat_id", words[F.lower("__w")].alias("alert_status"), F.col("ts").alias("ts_ack"),
        F.trim(without(F.col("__r"), F.col("__w"))).alias("remarks"), "sim_num",
    ).filter("stat_id IS NOT NULL AND alert_status IS NOT NULL")


# Sync keys and the tables they feed.
SYNC_TABLES = {
    "RiskAssessmentSummary": "risk_assessment_summary",
    "RiskAssessmentFamilyRiskProfile": "family_profile",
    "RiskAssessmentHazardData": "hazard_data",
    "RiskAssessmentRNC": "resources_and_capacities",
    "FieldSurveyLogs": "field_survey_logs",
    "SurficialDataCurrentMeasurement": "ground_measurement",
    "SurficialDataMomsSummary": "manifestations_of_movements",
    "MoMsReport": "manifestations_of_movements",
}


def decode_sync(messages: DataFrame) -> DataFrame:
    """Key, then rows split by ``||`` and fields by ``<*>``."""
    tables = F.create_map(*[F.lit(x) for kv in SYNC_TABLES.items() for x in kv])
    f = F.split("msg", ":", 2)  # values may hold colons
    d = messages.withColumn("__f", f).filter(F.size("__f") >= 2)
    d = d.select("inbox_id", "ts", tables[F.col("__f")[0]].alias("target"), F.posexplode(F.split(F.col("__f")[1], r"\|\|")).alias("row_no", "__row"))
    return d.filter("target IS NOT NULL").select("inbox_id", "ts", "target", "row_no", F.split("__row", r"<\*>").alias("fields"))


def decode_sync_rain(messages: DataFrame, gauges: DataFrame) -> DataFrame:
    """Eight ``|?=`` fields starting with a known gauge name."""
    d = messages.withColumn("__f", F.split("msg", r"\|\?=")).filter(F.size("__f") == 8)
    g = lambda i: F.col("__f")[i]
    d = d.select(
        "inbox_id", g(0).alias("gauge_name"), F.try_to_timestamp(g(1)).cast("timestamp_ntz").alias("ts"), g(2).try_cast("double").alias("rain"),
        g(3).try_cast("double").alias("temperature"), g(4).try_cast("double").alias("humidity"), g(5).try_cast("double").alias("battery1"),
        g(6).try_cast("double").alias("battery2"), g(7).try_cast("int").alias("csq"),
    )
    return d.join(gauges.select("gauge_name"), "gauge_name", "left_semi").withColumn("gauge_name", F.lower("gauge_name"))
