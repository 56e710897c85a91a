"""Which decoder a text message belongs to, and what became of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.clock import span

# Message formats, tried in this order.
LOGGER_ROUTES = [
    ("extensometer", r"^[A-Z]{3}X[A-Z]{1}\*U\*"),
    ("lidar", r"^[A-Z]{3}L[A-Z]{1}\*L\*"),
    ("piezo", r"\*FF|PZ\*"),
    ("v1", r"[A-Z]{4}DUE\*[A-F0-9]+\*.*"),
    ("v2", r"^[A-Z]{4,5}\*[xyabcdXYABCD]\*[A-F0-9]+\*[0-9]+T?$"),
    ("b64", r"^[A-Z]{5}\*[A-Za-z0-9/+]{2}\*[A-Za-z0-9/+]+\*[0-9]{12}$"),
    ("v1", r"[A-Z]{4}\*[A-F0-9]+\*[0-9]+$"),
    ("diagnostics", r"^[A-Z]{4,7}\*[m]\*"),
    ("rain_csv", r"^\w{4,7},[\d\/:,]+"),
    ("rain_arq", r"ARQ\+[0-9\.\+/\- ]+$"),
    ("rssi", r"^(COORDINATOR|GATEWAY)(\*|$)"),
    ("tilt_vector", r"[A-Z]{5,6}\*[R,F]+\*"),
    ("tilt_vector_v2", r"[A-Z]{3}N[A-Z]{1}\*[0,1]:+"),
    ("gnss", r"^[A-Z]{3}U[A-Z]{1}:"),
]
# Formats of people's messages, matched on upper-cased text.
USER_ROUTES = [
    ("earthquake", r"EQINFO"),
    ("acknowledgement", r"^ACK \d+ .+"),
    ("observation", r"^ *(R(O|0)*U*TI*N*E )|(EVE*NT )"),
]
# Status texts and their codes, first match wins.
STATUS_CODES = [
    (r"NO DATA FROM SENS", 1),
    (r"PARSED", 2),
    (r"^\w{4,5}\*0\*\*[0-9]{10,12}", 2),
    (r"^ \*", 3),
    (r"^\*[0-9]{10,12}$", 3),
    (r"^[A-F0-9]+\*[0-9]{10,12}$", 3),
    (r"^[A-F0-9]+\*[A-F0-9]{10,13}", 3),
    (r"^[A-F0-9]+\*[A-F0-9]{6,7}", 3),
    (r"REGISTERED", 4),
    (r"SERVER NUMBER", 5),
    (r"^MANUAL RESET", 6),
    (r"POWER UP", 7),
    (r"SYSTEM STARTUP", 8),
    (r"SMS RESET", 9),
    (r"POWER SAVING DEACTIVATED", 10),
    (r"POWER SAVING ACTIVATED", 11),
    (r"NODATAFROMSENS", 12),
    (r"^\w{4,5}\*[xyabcXYABC]\*[A-F0-9]+$", 13),
    (r"!\*", 15),
]


# Routes that count as handled whatever their decoder finds.
ALWAYS_HANDLED = ("rain_csv", "rain_arq", "status", "acknowledgement")
ROUTES = [*dict.fromkeys(n for n, _ in LOGGER_ROUTES), *(n for n, _ in USER_ROUTES), "status", "unknown"]


def _cascade(text: Column, rules, default: Column) -> Column:
    out = None
    for value, pattern in rules:
        hit = text.rlike(pattern)
        out = F.when(hit, F.lit(value)) if out is None else out.when(hit, F.lit(value))
    return out.otherwise(default)


def status_code(msg: str = "msg", codes=STATUS_CODES) -> Column:
    """Code of a status text; ``codes`` takes other texts, such as a maker's full wording."""
    return _cascade(F.upper(msg), [(c, p) for p, c in codes], F.lit(None).cast("int"))


def classify_status(messages: DataFrame) -> DataFrame:
    return messages.withColumn("status_code", status_code())


def route(messages: DataFrame) -> DataFrame:
    """Add ``route``: the first format that fits, status, or unknown.

    Where messages have a ``source``, texts of the table of loggers are tried
    against logger formats and status texts, those of the table of users
    against people's formats only. Without it, or where it is neither, all are
    tried in that order.
    """
    status = F.when(status_code().isNotNull(), "status").otherwise("unknown")
    logger = _cascade(F.col("msg"), LOGGER_ROUTES, status)
    user = _cascade(F.upper("msg"), USER_ROUTES, F.lit("unknown"))
    any_of = _cascade(F.col("msg"), LOGGER_ROUTES, _cascade(F.upper("msg"), USER_ROUTES, status))
    if "source" not in messages.columns:
        return messages.withColumn("route", any_of)
    return messages.withColumn("route", F.when(F.col("source") == "loggers", logger).when(F.col("source") == "users", user).otherwise(any_of))


def last_ten(number: str) -> Column:
    return F.substring(F.regexp_replace(number, r"\D", ""), -10, 10)


def resolve_sender(messages: DataFrame, mobiles: DataFrame) -> DataFrame:
    """Logger behind a number; the newest activation of the number wins."""
    w = W.partitionBy("__num").orderBy(F.col("date_activated").desc(), F.col("mobile_id").desc())
    one = mobiles.withColumn("__num", last_ten("sim_num")).withColumn("__rn", F.row_number().over(w)).filter("__rn = 1")
    one = one.select("__num", "logger_id", "mobile_id")
    return messages.withColumn("__num", last_ten("sim_num")).join(one, "__num", "left").drop("__num")


def handled() -> Column:
    """Routed messages that count as handled even if no row came of them.

    Rain texts, status texts and acknowledgements always do, a router's signal
    list if its type and time can be read (its routers may all be unknown),
    and texts of people that fit no format.
    """
    field = lambda n: F.try_element_at(F.split("msg", r"\*"), F.lit(n))
    signal = (F.col("route") == "rssi") & field(2).startswith("RSSI,") & F.try_to_timestamp(field(3), F.lit("yyMMddHHmmss")).isNotNull()
    return F.col("route").isin(*ALWAYS_HANDLED) | F.coalesce(signal, F.lit(False)) | F.coalesce((F.col("route") == "unknown") & (F.col("source") == "users"), F.lit(False))


def with_outcome(routed: DataFrame, decoded_ids: DataFrame) -> DataFrame:
    """Add ``read_status``: 1 for messages that some decoder turned into rows or that count as handled, -1 for the rest."""
    if "source" not in routed.columns:
        routed = routed.withColumn("source", F.lit(None).cast("string"))
    ok = decoded_ids.select("inbox_id").distinct().withColumn("__ok", F.lit(1))
    return routed.join(ok, "inbox_id", "left").withColumn("read_status", F.when((F.col("__ok") == 1) | handled(), 1).otherwise(-1)).drop("__ok")


def parse_ledger(routed: DataFrame, decoded_ids: DataFrame) -> DataFrame:
    """Outcome of every routed message; none is ever read again."""
    return with_outcome(routed, decoded_ids).select("inbox_id", "read_status")


def sensors_to_evaluate(tilt: DataFrame, key: str = "tsm_name") -> DataFrame:
    """Sensors that just sent data, once each, ten minutes after their latest."""
    return tilt.groupBy(key).agg((F.max("ts") + span(mins=10)).alias("evaluate_at"))


def count_items(messages: DataFrame, status: str | None = None, minutes: int = 5) -> DataFrame:
    """Messages per bucket and table, optionally only those with a status prefix."""
    from ..functions.clock import floor_to

    d = messages if status is None else messages.filter(F.col("status").startswith(status))
    return d.groupBy(floor_to("ts", minutes).alias("bucket"), "source").agg(F.count(F.lit(1)).alias("items"))
