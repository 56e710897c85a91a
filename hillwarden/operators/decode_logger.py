"""Logger messages to typed rows, in native string functions.

Every decoder takes messages (inbox_id, msg, sim_num, ts) of its route and
returns one row per decoded item with the inbox id. A message that fails is
simply absent; the ledger turns absence into a dead letter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .routing import resolve_sender


def hexint(c: Column) -> Column:
    """Hex text -> int, NULL unless it is all hex digits."""
    return F.when(c.rlike("^[0-9A-Fa-f]+$"), F.conv(c, 16, 10).cast("int"))


def part(text: Column, i: int, sep: str = r"\*") -> Column:
    """i-th separated part, 0-based, NULL beyond the end."""
    return F.try_element_at(F.split(text, sep), F.lit(i + 1))


def pieces(text: Column, width: int | Column, partial: bool = False) -> Column:
    """Array of fixed-width slices; the last one may be short if asked for."""
    w = width if isinstance(width, Column) else F.lit(width)
    n = (F.ceil(F.length(text) / w) if partial else F.floor(F.length(text) / w)).cast("int")
    return F.when(n >= 1, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substr(text, i * w + 1, w)))


def minute(text: Column, *formats: str) -> Column:
    """First format that parses, cut to the minute."""
    t = F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])
    return F.date_trunc("minute", t).cast("timestamp_ntz")


def second(text: Column, fmt: str = "yyMMddHHmmss") -> Column:
    return F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz")


def unhex(c: Column) -> Column:
    """Hex text known to be clean -> int."""
    return F.conv(c, 16, 10).cast("int")


def swapped(p: Column, at: int) -> Column:
    """Three hex digits stored low byte first."""
    return unhex(F.concat(F.substr(p, F.lit(at + 2), F.lit(1)), F.substr(p, F.lit(at), F.lit(2))))


def twos(v: Column, bits: int) -> Column:
    return F.when(v > 2 ** (bits - 1), v - 2**bits).otherwise(v)


def sub(p: Column, at: int, n: int) -> Column:
    return F.substr(p, F.lit(at), F.lit(n))


# --- subsurface, version 1 ---------------------------------------------------


def decode_v1(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Hex nodes of 15 digits: id 2, x 3, y 3, z 3, moisture 4 -> (tilt, soms)."""
    line = F.regexp_replace(F.regexp_replace(F.regexp_replace("msg", "DUE", ""), ",", "*"), "/", "")
    line = F.substr(line, F.lit(1), F.length(line) - 2)
    d = messages.withColumn("__line", line)
    own_clock = F.substring("__line", 1, 4) != "PUGB"
    stamp = F.when(own_clock, minute(F.substring(part(F.col("__line"), 2), 1, 10), "yyMMddHHmm")).otherwise(F.col("ts"))
    d = d.select(
        "inbox_id", F.lower(F.substring("__line", 1, 4)).alias("tsm_name"), stamp.alias("ts"), part(F.col("__line"), 1).alias("__data")
    ).filter(F.col("ts").isNotNull() & F.col("__data").rlike("^[0-9A-F]{15,}$"))
    d = d.select("inbox_id", "tsm_name", "ts", F.explode(pieces(F.col("__data"), 15)).alias("p"))
    h = lambda at, n: unhex(sub(F.col("p"), at, n))
    d = d.select("inbox_id", "tsm_name", "ts", h(1, 2).alias("node_id"), *[h(at, 3).alias(a) for at, a in ((3, "x"), (6, "y"), (9, "z"))], h(12, 4).alias("mval1"))
    d = d.withColumns({a: F.when(F.col(a) > 1024, F.col(a) - 4096).otherwise(F.col(a)) for a in "xyz"})
    return d.drop("mval1"), d.select("inbox_id", "tsm_name", "ts", "node_id", "mval1")


# --- subsurface, versions 2 and 3 --------------------------------------------

# Type bytes of the old comma form and the letter they stand for.
OLD_FORMS = [("20|0B", "x"), ("21|0C", "y"), ("6F|15|0A", "b"), ("70|1A|0D", "c")]
V2_FORM = r"^([A-Z]{5})\*([xyabcdXYABCD])\*([A-F0-9]+)\*([^*]+)$"
CLOCKS = ("yyMMddHHmmss", "yyyyMMddHHmmss")


def _v2_parts(messages: DataFrame, letters: str) -> DataFrame:
    """inbox_id, tsm_name, letter, data, ts of well-formed messages.

    Every derived column reads the text once, so that filters pushed below
    the projections stay small.
    """
    old = F.col("msg")
    for types, letter in OLD_FORMS:
        old = F.regexp_replace(old, rf"^([A-Z]{{5}}),([^,]{{2}}(?:{types})[^,]*),([^,]*)$", rf"$1*{letter}*$2*$3")
    old = F.regexp_replace(old, "/", "")
    d = messages.withColumn("__m", F.when(F.contains("msg", F.lit(",")), old).otherwise(F.col("msg")))
    take = lambda k: F.regexp_extract("__m", V2_FORM, k)
    d = d.filter(F.col("__m").rlike(V2_FORM) & F.upper(take(2)).isin(*letters))
    d = d.select(
        "inbox_id", F.col("ts").alias("__sent"), F.col("__m").rlike(r"^SINSA\*.\*[A-F0-9]+\* *0{12} *$").alias("__unset"),
        F.lower(take(1)).alias("tsm_name"), F.upper(take(2)).alias("letter"),
        # one stray digit in the middle of a full-length message
        F.regexp_replace(take(3), "^(.{72}).(.{63})$", "$1$2").alias("data"),
        minute(F.regexp_replace(take(4), "[^0-9]", ""), *CLOCKS).alias("ts"),
    )
    return d.withColumn("ts", F.when(F.col("__unset"), F.col("__sent")).otherwise(F.col("ts"))).filter("ts IS NOT NULL").drop("__sent", "__unset")


def decode_v2(messages: DataFrame) -> DataFrame:
    """Hex nodes of 15 digits: id 2, type 2, swapped x y z 3 each, battery 2.

    A message that ends inside a node is rejected as a whole.
    """
    d = _v2_parts(messages, "XY").filter(F.col("data").rlike("^([0-9A-F]{15})*([0-9A-F]{14})?$"))
    p = F.col("p")
    d = d.select("inbox_id", "tsm_name", "ts", F.explode(pieces(F.col("data"), 15, partial=True)).alias("p"))
    d = d.select(
        "inbox_id", "tsm_name", "ts", unhex(sub(p, 1, 2)).alias("node_id"), unhex(sub(p, 3, 2)).alias("type_num"),
        *[swapped(p, at).alias(a) for at, a in ((5, "x"), (8, "y"), (11, "z"))],
        ((unhex(sub(p, 14, 2)) + 200) / F.lit(100.0)).alias("batt"),
    )
    return d.withColumns({a: twos(F.col(a), 12) for a in "xyz"})


def _temperature(t: Column, typ: Column) -> Column:
    return F.when((t >= 1022) & typ.isin(23, 24), 0).otherwise(t)


def decode_temp(messages: DataFrame) -> DataFrame:
    """Hex nodes of 8 digits: id 2, type 2, temperature 4."""
    d = _v2_parts(messages, "D").filter(F.col("data").rlike("^([0-9A-F]{8})*([0-9A-F]{5,7})?$"))
    p = F.col("p")
    d = d.select("inbox_id", "tsm_name", "ts", F.explode(pieces(F.col("data"), 8, partial=True)).alias("p"))
    d = d.select(
        "inbox_id", "tsm_name", "ts", unhex(sub(p, 1, 2)).alias("node_id"), unhex(sub(p, 3, 2)).alias("type_num"), unhex(sub(p, 5, 4)).alias("temp_val")
    )
    return d.withColumn("temp_val", _temperature(F.col("temp_val"), F.col("type_num")))


# Node commands of raw and calibrated moisture messages.
RAW_COMMANDS = (110, 111, 21, 10)
CALIBRATED_COMMANDS = (112, 113, 26, 13)


def _layout(width: int, commands) -> Column:
    """struct(width, n, bad): items before the first unknown command, and it."""
    # command 13 marks the newer layout, always ten digits wide
    w = F.when(F.col("__newer"), 10).otherwise(width)
    cmd = F.transform(pieces(F.col("data"), w), lambda p: unhex(F.substr(p, F.lit(3), F.lit(2))))
    odd = F.filter(cmd, lambda c: ~c.isin(*commands))
    bad = F.try_element_at(odd, F.lit(1))
    n = F.when(bad.isNull(), F.size(cmd)).otherwise(F.array_position(cmd, bad).cast("int") - 1)
    return F.struct(w.alias("width"), n.alias("n"), bad.alias("bad"))


def decode_soms(messages: DataFrame) -> DataFrame:
    """Moisture values; layouts are tried in a fixed order until one fits.

    Letter B starts raw (10 digits), C calibrated (7). A known command of the
    other kind switches kind; anything else falls back to the padded width
    (12 or 6), which keeps the items before its first unknown command. A
    message that starts inside a node is left to the dead letters.
    """
    d = _v2_parts(messages, "BC")
    start = unhex(F.substring("data", 1, 2))
    d = d.withColumns({"__raw": F.col("letter") == "B", "__newer": unhex(F.substring("data", 3, 2)) == 13})
    d = d.filter(~F.when(F.col("__raw"), start.isin(*RAW_COMMANDS)).otherwise(start.isin(*CALIBRATED_COMMANDS)))
    d = d.withColumns(
        {
            "__r10": _layout(10, RAW_COMMANDS), "__r12": _layout(12, RAW_COMMANDS),
            "__c7": _layout(7, CALIBRATED_COMMANDS), "__c6": _layout(6, CALIBRATED_COMMANDS),
        }
    )
    r, c = F.col("__r10"), F.col("__c7")
    as_cal = F.when(c["bad"].isNull(), c).otherwise(F.col("__c6"))
    as_raw = F.when(r["bad"].isNull(), r).otherwise(F.col("__r12"))
    pick = F.when(F.col("__raw"), F.when(r["bad"].isin(112, 113, 26), as_cal).otherwise(as_raw)).otherwise(
        F.when(c["bad"].isin(110, 111, 21), as_raw).otherwise(as_cal)
    )
    d = d.select("inbox_id", "tsm_name", "ts", "data", pick.alias("k"))
    d = d.select("inbox_id", "tsm_name", "ts", "k", F.posexplode(pieces(F.col("data"), F.col("k.width"))).alias("i", "p")).filter("i < k.n")
    p, w = F.col("p"), F.col("k.width")
    one = unhex(F.concat(sub(p, 7, 1), sub(p, 5, 2))).cast("double")
    two = unhex(F.concat(sub(p, 10, 1), sub(p, 8, 2))).cast("double")
    return d.select(
        "inbox_id", "tsm_name", "ts", unhex(sub(p, 1, 2)).alias("node_id"), unhex(sub(p, 3, 2)).alias("type_num"),
        F.when(w != 6, one).alias("mval1"), F.when(w >= 10, two).otherwise(0.0).alias("mval2"),
    )


# --- base 64 ----------------------------------------------------------------

# Digit order.
B64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
TILT_12 = (11, 12, 32, 33, 41, 42)
TILT_16 = (51, 52)
TEMPS = (22, 23, 24)


def b64int(text: Column, n: int) -> Column:
    """n base-64 digits, most significant first."""
    out = None
    for k in range(n):
        digit = F.position(F.substr(text, F.lit(k + 1), F.lit(1)), F.lit(B64)) - 1
        out = digit if out is None else out * 64 + digit
    return out.cast("int")


def decode_b64(messages: DataFrame, renumbered: tuple[str, ...] = ("KNRTB",)) -> tuple[DataFrame, DataFrame]:
    """Compact form -> (tilt, temp). ``renumbered`` sensors have shifted node ids."""
    form = r"^([^*]{5})\*([A-Za-z0-9/+]{2})\*([A-Za-z0-9/+]+)\*([0-9]{12})$"
    take = lambda k: F.regexp_extract("msg", form, k)
    d = messages.filter(F.col("msg").rlike(form)).select(
        "inbox_id", take(1).alias("__name"), b64int(take(2), 2).alias("type_num"), take(3).alias("data"), minute(take(4), "yyMMddHHmmss").alias("ts")
    ).filter("ts IS NOT NULL")

    # pieces must be whole: digits missing at the end would read as small values
    size = F.when(F.col("type_num").isin(*TILT_12), 9).when(F.col("type_num").isin(*TILT_16), 12).when(F.col("type_num").isin(*TEMPS), 3)
    d = d.withColumn("__w", size).filter(F.length("data") % F.col("__w") == 0)
    d = d.select("inbox_id", "__name", "ts", "type_num", "__w", F.explode(pieces(F.col("data"), F.col("__w"))).alias("p"))
    p = F.col("p")
    d = d.withColumn("__id", b64int(sub(p, 1, 1), 1))
    moved = F.when(F.col("__id").between(6, 11), F.col("__id") + 1).when(F.col("__id") == 0, 6).otherwise(F.col("__id"))
    d = d.withColumn("node_id", F.when(F.col("__name").isin(*renumbered), moved).otherwise(F.col("__id")))

    def axes(rows: DataFrame, digits: int, bits: int) -> DataFrame:
        vals = {a: b64int(sub(p, 2 + k * digits, digits), digits) for k, a in enumerate("xyz")}
        vals["batt"] = b64int(sub(p, 2 + 3 * digits, 2), 2)
        r = rows.withColumns(vals)
        out = {a: twos(F.col(a), bits) for a in "xyz"}
        out["batt"] = (twos(F.col("batt"), 12) + 200) / F.lit(100.0)
        return r.withColumns(out)

    tilt = axes(d.filter("__w = 9"), 2, 12).unionByName(axes(d.filter("__w = 12"), 3, 16))
    name = F.lower("__name").alias("tsm_name")
    tilt = tilt.select("inbox_id", name, "ts", "node_id", "type_num", "x", "y", "z", "batt")
    temp = d.filter("__w = 3").withColumn("t", b64int(sub(p, 2, 2), 2)).select(
        "inbox_id", name, "ts", "node_id", "type_num", _temperature(F.col("t"), F.col("type_num")).alias("temp_val")
    )
    return tilt, temp


# --- logger state ------------------------------------------------------------


def decode_diag(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Current / voltage pairs -> (volt, unsent); the last pair has stat 99."""
    line = F.regexp_replace("msg", "DUE|PZ", "")
    d = messages.withColumn("__f", F.split(line, r"\*"))
    d = d.withColumn("ts", minute(F.element_at("__f", -1), "yyMMddHHmmss")).filter("ts IS NOT NULL AND size(__f) >= 5")
    n = F.greatest(F.lit(1), F.floor((F.size("__f") - 3) / 2).cast("int"))
    d = d.withColumn(
        "__n",
        F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda i: F.struct(
                F.when(i == n - 1, 99).otherwise(i).alias("stat"),
                F.try_element_at(F.col("__f"), 3 + i * 2).alias("curr"), F.try_element_at(F.col("__f"), 4 + i * 2).alias("volt"),
            ),
        ),
    )
    name = F.lower(F.col("__f")[0]).alias("tsm_name")
    volt = d.select("inbox_id", name, "ts", F.explode("__n").alias("n")).select(
        "inbox_id", "tsm_name", "ts", "n.stat", F.trim("n.curr").try_cast("double").alias("curr_draw"),
        F.trim(F.element_at(F.split("n.volt", ">"), 1)).try_cast("double").alias("batt_volt"),
    )
    unsent = d.select(
        "inbox_id", "sim_num", name, "ts",
        F.trim(F.try_element_at(F.split(F.element_at("__n", -1)["volt"], ">"), F.lit(2))).try_cast("int").alias("unsent"),
    )
    return volt, unsent


def decode_rssi(messages: DataFrame, routers: DataFrame) -> DataFrame:
    """Router signal list; names not in the registry are dropped."""
    d = messages.withColumns(
        {"__data": part(F.col("msg"), 1), "ts": second(part(F.col("msg"), 2))}
    ).filter("ts IS NOT NULL AND __data LIKE 'RSSI,%'")
    rest = F.regexp_replace("__data", r"^RSSI,[^,]*,", "")
    d = d.select("inbox_id", "ts", F.explode(F.regexp_extract_all(rest, F.lit(r"([A-Z]+,\d+,(?:\d*\.\d+)?)"), F.lit(1))).alias("__i"))
    d = d.select(
        "inbox_id", "ts", F.lower(part(F.col("__i"), 0, ",")).alias("router_name"), part(F.col("__i"), 1, ",").cast("int").alias("rssi_val"),
        F.nullif(part(F.col("__i"), 2, ","), F.lit("")).try_cast("double").alias("battery"),
    )
    return d.join(routers.select("router_name", "logger_id"), "router_name").select("inbox_id", "ts", "logger_id", "router_name", "rssi_val", "battery")


# --- rain -------------------------------------------------------------------


def decode_rain_arq(messages: DataFrame, mobiles: DataFrame, gauges: DataFrame, default: float = 0.5) -> DataFrame:
    """Tip counts times the gauge's resolution. Unknown senders are dropped.

    ``gauges``: logger_id, gauge_name, resolution.
    """
    line = F.regexp_replace("msg", r"(?<=\+) (?=\+)", "NULL")
    d = resolve_sender(messages, mobiles).join(gauges, "logger_id").withColumn("__f", F.split(line, r"\+"))
    f = lambda i: F.try_element_at(F.col("__f"), F.lit(i + 1))
    tips = f(1).try_cast("int")
    return d.select(
        "inbox_id", F.lower("gauge_name").alias("gauge_name"), F.try_to_timestamp(f(13), F.lit("yyMMdd/HHmmss")).cast("timestamp_ntz").alias("ts"),
        (tips * F.coalesce("resolution", F.lit(default))).alias("rain"), f(10).try_cast("double").alias("temperature"),
        f(11).try_cast("double").alias("humidity"), f(3).try_cast("double").alias("battery1"), f(4).try_cast("double").alias("battery2"),
        f(9).try_cast("int").alias("csq"),
    ).filter("ts IS NOT NULL AND rain IS NOT NULL")


# Logger models that report under their own name.
OWN_NAME_MODELS = (23, 24, 25, 26)


def decode_rain_csv(messages: DataFrame, loggers: DataFrame | None = None) -> DataFrame:
    """Comma forms: nine fields (version 3) or six (version 5).

    Empty middle fields become zero. ``loggers``: sim_num suffix resolved
    beforehand into columns logger_name, model_id on ``messages``; without
    them the name comes from the text.
    """
    cols = messages.columns
    line = F.regexp_replace("msg", r"[^A-Z0-9,\/:\.\-]", "")
    line = F.when(F.size(F.split(line, ",")) > 9, F.regexp_replace(line, r",$", "")).otherwise(line)
    line = F.regexp_replace(line, r"(?<=,)(?=(,|$))", "NULL")
    line = F.regexp_replace(line, r"(?<=,)NULL(?=,)", "0.0")
    five = F.size(F.split("msg", ",")) == 6
    d = messages.withColumns({"__l": line, "__five": five})
    f = lambda i: part(F.col("__l"), i, ",")
    name3 = F.concat(F.regexp_replace(f(0), ".$", ""), F.lit("G"))
    if "logger_name" in cols:
        own = F.col("model_id").isin(*OWN_NAME_MODELS) | F.col("__five")
        name = F.coalesce(F.when(own, F.col("logger_name")), F.when(F.col("__five"), f(0)).otherwise(name3))
    else:
        name = F.when(F.col("__five"), f(0)).otherwise(name3)
    stamp3 = F.try_to_timestamp(F.regexp_extract("__l", r"\d{2}/\d{2}/\d{2},\d{2}:\d{2}:\d{2}", 0), F.lit("MM/dd/yy,HH:mm:ss"))
    stamp5 = F.try_to_timestamp(f(5), F.lit("yyMMddHHmmss"))
    v5 = F.col("__five")
    csq = F.when(v5, f(4)).otherwise(f(8))
    full = csq != "NULL"
    return d.filter(csq.isNotNull()).select(
        "inbox_id", F.lower(name).alias("gauge_name"), F.when(v5, stamp5).otherwise(stamp3).cast("timestamp_ntz").alias("ts"),
        F.when(v5, f(2)).otherwise(f(6)).try_cast("double").alias("rain"),
        F.when(full, F.when(v5, f(1)).otherwise(f(5)).try_cast("double")).alias("temperature"),
        F.when(full, F.when(v5, f(3)).otherwise(f(7)).try_cast("double")).alias("battery1"),
        F.when(full, csq.try_cast("int")).alias("csq"),
    ).filter("ts IS NOT NULL")


# --- other devices -----------------------------------------------------------


def decode_piezo(messages: DataFrame) -> DataFrame:
    """Hex fixed point: frequency 2+2+2 digits, temperature 2+2."""
    line = F.regexp_replace(F.replace("msg", F.lit("*p*"), F.lit("*")), r"\*\*", "*")
    d = messages.withColumn("__f", F.split(line, r"\*"))
    name = F.regexp_replace(F.lower(F.col("__f")[0]), "due|pz|ff", "")
    name = F.when(F.length(name) == 3, F.concat(name, F.lit("pz"))).otherwise(name)
    data = F.regexp_replace(F.try_element_at(F.col("__f"), F.lit(2)), "F", "")
    h = lambda at: hexint(F.substr(data, F.lit(at), F.lit(2)))
    stamp = minute(F.try_element_at(F.col("__f"), F.lit(3)), "yyMMddHHmmss", "yyMMddHHmm")
    return d.select(
        "inbox_id", name.alias("piezo_name"), F.when(F.year(stamp) < 2009, F.col("ts")).otherwise(stamp).alias("ts"),
        (h(1) * 100 + h(3) + h(5) * F.lit(0.01)).alias("frequency_shift"), (h(7) + h(9) * F.lit(0.01)).alias("temperature"),
    ).filter("ts IS NOT NULL AND frequency_shift IS NOT NULL AND temperature IS NOT NULL")


# Two-letter keys and their columns.
EXTENSOMETER_KEYS = {"LA": "lag", "MX": "abs_max_val", "MI": "abs_max_index", "TP": "temp_val"}
LIDAR_KEYS = {"LR": "dist", "BV": "voltage", "BI": "current", "TP": "temp_val"}


def _keyed(messages: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Key:value items and the trailing twelve-digit time; none decoded drops the row."""
    found = F.regexp_extract_all("msg", F.lit(r"(?<=\*)([A-Za-z]{2}:[0-9\.]*)(?=\*)"), F.lit(1))
    # later repeats of a key win, hence the filter per key and its last element
    d = messages.withColumn("__kv", found)
    pick = lambda k: F.try_element_at(F.filter("__kv", lambda x: F.substring(x, 1, 2) == k), F.lit(-1))
    d = d.withColumns({c: F.substr(pick(k), F.lit(4)).try_cast("double") for k, c in keys.items()})
    return d.withColumn("ts", second(F.regexp_extract("msg", r"(?<=\*)[0-9]{12}$", 0))).filter(
        F.col("ts").isNotNull() & F.coalesce(*keys.values()).isNotNull()
    ).drop("__kv")


def decode_extensometer(messages: DataFrame) -> DataFrame:
    d = _keyed(messages, EXTENSOMETER_KEYS)
    return d.select("inbox_id", F.lower(part(F.col("msg"), 0)).alias("extensometer_name"), "ts", *EXTENSOMETER_KEYS.values())


def _axes(field: Column, prefix: str) -> list[Column]:
    v = F.split(F.regexp_replace(field, r"^[^:]*:", ""), ",")
    return [F.try_element_at(v, F.lit(k + 1)).try_cast("double").alias(f"{prefix}_{a}") for k, a in enumerate("xyz")]


def decode_lidar(messages: DataFrame) -> DataFrame:
    d = _keyed(messages, LIDAR_KEYS)
    d = d.select(
        "inbox_id", F.lower(part(F.col("msg"), 0)).alias("lidar_name"), "ts", *LIDAR_KEYS.values(),
        *_axes(part(F.col("msg"), 5), "ac"), *_axes(part(F.col("msg"), 6), "mg"), *_axes(part(F.col("msg"), 7), "gr"),
    )
    return d.filter("ac_z IS NOT NULL AND mg_z IS NOT NULL AND gr_z IS NOT NULL")


VECTOR = ["ac_x", "ac_y", "ac_z", "mg_x", "mg_y", "mg_z", "gr_x", "gr_y", "gr_z", "temp"]


def decode_tilt_vector(messages: DataFrame) -> DataFrame:
    """Ten decimal values and a time, comma-separated."""
    f = F.split(part(F.col("msg"), 2), ",")
    return messages.withColumn("__f", f).select(
        "inbox_id", F.lower(part(F.col("msg"), 0)).alias("logger_name"), part(F.col("msg"), 1).alias("type"),
        minute(F.try_element_at(F.col("__f"), F.lit(11)), "yyMMddHHmmss").alias("ts"),
        *[F.try_element_at(F.col("__f"), F.lit(k + 1)).try_cast("double").alias(c) for k, c in enumerate(VECTOR)],
    ).filter("ts IS NOT NULL")


def decode_tilt_vector_v2(messages: DataFrame) -> DataFrame:
    """Up to two nodes of ten 16-bit hex values, then taps, clock and supply."""
    body = F.split(part(F.col("msg"), 1), ";")
    d = messages.withColumns({"__b": body, "ts": minute(part(F.col("msg"), 2), "yyMMddHHmmss")}).filter("ts IS NOT NULL AND size(__b) >= 3")
    tail = F.split(F.col("__b")[2], ",")
    d = d.select(
        "inbox_id", F.lower(part(F.col("msg"), 0)).alias("logger_name"), "ts", F.explode(F.slice("__b", 1, 2)).alias("__n"),
        F.try_element_at(tail, F.lit(1)).try_cast("int").alias("taps"), F.try_element_at(tail, F.lit(2)).try_cast("double").alias("temp_rtc"),
        F.try_element_at(tail, F.lit(3)).try_cast("double").alias("volt"),
    ).withColumn("__v", F.split("__n", "[:,]")).filter("size(__v) >= 11")
    d = d.select(
        "inbox_id", "logger_name", "ts", F.col("__v")[0].try_cast("int").alias("node_id"),
        *[hexint(F.col("__v")[k + 1]).alias(c) for k, c in enumerate(VECTOR)], "taps", "temp_rtc", "volt",
    ).dropna(subset=["node_id", *VECTOR])
    return d.withColumns({c: F.when(F.col(c) >= 32768, F.col(c) - 65536).otherwise(F.col(c)) for c in VECTOR})


def decode_gnss(messages: DataFrame) -> DataFrame:
    left = part(F.col("msg"), 0)
    d = messages.withColumns({"__p": F.split(part(left, 1, ":"), ","), "__q": F.split(part(left, 2, ":"), ",")})
    g = lambda a, k: F.try_element_at(F.col(a), F.lit(k)).try_cast("double")
    return d.select(
        "inbox_id", F.lower(part(left, 0, ":")).alias("logger_name"), minute(part(F.col("msg"), 1), "yyMMddHHmmss").alias("ts"),
        g("__p", 1).alias("latitude"), g("__p", 2).alias("longitude"), g("__p", 3).alias("msl"), g("__p", 4).alias("prec"),
        g("__q", 1).alias("temp"), g("__q", 2).alias("volt"),
    ).filter("ts IS NOT NULL")
