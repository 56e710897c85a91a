"""Personal data: high-recall span generators, boosted trees over format and context, calibrated thresholds."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hillwarden.llm.tables import keep, row_key

KINDS = ["email", "ip", "card", "phone"]

# The stated forms. Look-behinds and possessive runs only spare retries that cannot match; a repeated group is
# possessive, since a greedy one recurses once per repetition and a long run of digits would overflow the stack.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

# Wider forms of the same kinds: spelt-out or bracketed signs, no country sign, other separators.
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?: ?[\[({]at[\])}] ?| at |@)[A-Za-z0-9-]+(?:(?: ?[\[({]dot[\])}] ?| dot |\.)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\.)[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[\x20.-]?[0-9]){12,18}(?![0-9])",
    "phone": r"(?<![0-9+(])\+?(?:[0-9]{1,3}[\x20.-])?\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}

CUES = {"email": r"e-?mail|contact|write|mail", "ip": r"\bip\b|host|server|address", "card": r"card|visa|credit|payment", "phone": r"phone|call|tel|mobile|fax"}
NEED = {"email": r"@|(?i)[\[({ ]at[\])} ]", "ip": r"[0-9]\.[0-9]|[0-9][\[(]\.[\])]", "card": r"[0-9](?:[\x20.-]?[0-9]){12}", "phone": r"\+[0-9]|[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}"}

FEATURES = ["kind", "length", "digits", "letters", "separators", "luhn", "octets", "brackets", "before", "after", "cue", "digit_near", "groups"]
SPAN = "array<struct<start:bigint,end:bigint,found:string>>"


def located(text: Column, pattern: str) -> Column:
    """Non-overlapping matches from the left: start, end (code points, end exclusive) and the match."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    zipped = F.arrays_zip(found.alias("m"), F.slice(gaps, F.lit(1), F.greatest(F.lit(1), F.size(found))).alias("g"))
    walk = F.aggregate(
        zipped,
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPAN).alias("out")),
        lambda a, x: F.struct(
            (a["at"] + F.length(x["g"]) + F.length(x["m"])).cast("long").alias("at"),
            F.array_append(
                a["out"],
                F.struct(
                    (a["at"] + F.length(x["g"])).cast("long").alias("start"), (a["at"] + F.length(x["g"]) + F.length(x["m"])).cast("long").alias("end"), x["m"].alias("found")
                ),
            ).cast(SPAN).alias("out"),
        ),
    )["out"]
    return F.when(F.size(found) > 0, walk).otherwise(F.array().cast(SPAN))


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check sum."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int")))
    return F.aggregate(values, F.lit(0), lambda a, v: (a + F.coalesce(v, F.lit(0))).cast("int")) % 10 == 0


def digits_of(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def octets_fit(found: Column) -> Column:
    parts = F.split(F.regexp_replace(found, r"[^0-9.]", ""), r"\.")
    return F.forall(parts, lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3) & F.forall(parts, lambda p: F.coalesce(F.substring(F.regexp_replace(p, "^0+(?=.)", ""), 1, 4).try_cast("int") <= 255, F.lit(False)))


def passes(kind: str, found: Column) -> Column:
    digits = digits_of(found)
    if kind == "ip":
        return octets_fit(found)
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _passing(kind: str):
    return lambda s: passes(kind, s["found"])


def _placed(kind: int):
    return lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))


def _in_context(kind: int):
    return lambda s: F.struct(
        F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["found"].alias("found"),
        F.substring(F.col("text"), F.greatest(F.lit(1), s["start"].cast("int") - 23), F.least(F.lit(24), s["start"].cast("int"))).alias("before"),
        F.substring(F.col("text"), s["end"].cast("int") + 1, F.lit(8)).alias("after"),
    )


def spans(docs: DataFrame) -> DataFrame:
    """docs (rk, doc_id, text) with `base` (kind, start, end) and, for candidates, `wide` (kind, start, end, found, before, after)."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("rk", "doc_id", text.alias("text"))
    for k in KINDS:
        rows = rows.withColumn(f"has_{k}", F.rlike("text", F.lit(NEED[k])))
        rows = rows.withColumn(f"base_{k}", F.when(F.col(f"has_{k}"), F.filter(located(F.col("text"), BASE[k]), _passing(k))).otherwise(F.array().cast(SPAN)))
        rows = rows.withColumn(f"wide_{k}", F.when(F.col(f"has_{k}"), located(F.col("text"), WIDE[k])).otherwise(F.array().cast(SPAN)))
    base = F.concat(*[F.transform(f"base_{k}", _placed(i)) for i, k in enumerate(KINDS)])
    wide = F.concat(*[F.transform(f"wide_{k}", _in_context(i)) for i, k in enumerate(KINDS)])
    return rows.select("rk", "doc_id", base.alias("base"), wide.alias("wide"))


def features(candidates: DataFrame) -> DataFrame:
    """Format and context of candidates (kind, found, before, after); signs by which the stated forms differ are left out."""
    f, digits = F.col("found"), digits_of(F.col("found"))
    side = lambda c: F.when(c == "", 0).when(F.rlike(c, F.lit("[0-9]")), 1).when(F.rlike(c, F.lit(r"\p{L}")), 2).when(F.rlike(c, F.lit(r"\s")), 3).otherwise(4)
    cue = F.lit(False)
    for i, k in enumerate(KINDS):
        cue = cue | ((F.col("kind") == i) & F.rlike(F.lower("before"), F.lit(CUES[k])))
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(f, r"^\+[0-9]{1,3}[\x20.-]", ""), r" ?[\[({]?\bat\b[\])}]? ?", "@"), r" ?[\[({]?\bdot\b[\])}]? ?", ".")
    return candidates.select(
        "*",
        F.col("kind").cast("double").alias("f_kind"), F.length(plain).cast("double").alias("f_length"), F.least(F.length(digits_of(plain)), F.lit(30)).cast("double").alias("f_digits"),
        F.length(F.regexp_replace(plain, r"[^\p{L}]", "")).cast("double").alias("f_letters"), F.length(F.regexp_replace(plain, r"[\p{L}0-9]", "")).cast("double").alias("f_separators"),
        F.when((F.col("kind") == 2) & (F.length(digits) >= 13), luhn(digits)).otherwise(F.lit(False)).cast("double").alias("f_luhn"),
        F.when(F.col("kind") == 1, octets_fit(F.regexp_replace(f, r"[\[\]()]", ""))).otherwise(F.lit(False)).cast("double").alias("f_octets"),
        F.rlike(plain, F.lit(r"[(\[{]")).cast("double").alias("f_brackets"), side(F.substring("before", -1, 1)).cast("double").alias("f_before"),
        side(F.substring("after", 1, 1)).cast("double").alias("f_after"), cue.cast("double").alias("f_cue"),
        (F.rlike("before", F.lit(r"[0-9][^\p{L}]{0,3}$")) | F.rlike("after", F.lit(r"^[^\p{L}]{0,3}[0-9]"))).cast("double").alias("f_digit_near"),
        F.size(F.split(plain, r"[^\p{L}0-9]+")).cast("double").alias("f_groups"),
    )


def detect(docs: DataFrame, *, trees: int = 8, depth: int = 3, precision: float = 0.98) -> DataFrame:
    """One row per row of docs: doc_id, rk, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    Spans of the stated forms always stay; n_* and base_sha256 are of those.
    Wider generators propose overlapping candidates. Boosted trees learn from
    seven tenths of all candidates, by hash, which look and stand like spans
    of the stated forms; a kind's threshold is the lowest at which the other
    three tenths, held out of the fit, reach `precision`. Accepted
    candidates that overlap no stated span, nor a better one, are added.
    Where candidates are all alike, nothing is learned or added.

    Null text counts as empty and has no span. Spans are in code points, end
    exclusive. Repeated rows get equal results. Texts are read whole and other
    columns not at all.
    """
    rows = keep(spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("rk"), "text")))
    some = rows.where(F.size("wide") > 0).dropDuplicates(["rk"])
    flat = some.select("rk", "base", F.explode_outer("wide").alias("w")).select("rk", "base", "w.*")
    touch = F.exists("base", lambda b: (b["start"] < F.col("end")) & (b["end"] > F.col("start")))
    same = F.exists("base", lambda b: (b["kind"] == F.col("kind")) & (b["start"] < F.col("end")) & (b["end"] > F.col("start")))
    flat = keep(features(flat.withColumn("touch", touch).withColumn("label", same.cast("double")).drop("base")))
    sizes = {r["label"]: r["n"] for r in flat.groupBy("label").agg(F.count("*").alias("n")).collect()}
    added = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
    if sizes.get(0.0, 0) >= 10 and sizes.get(1.0, 0) >= 10:
        chosen = _accept(flat, sum(sizes.values()), trees, depth, precision)
        rows = rows.join(chosen, "rk", "left")
        added = F.coalesce(F.col("added"), added)
    order = lambda s: F.array_sort(s.cast("array<struct<kind:int,start:bigint,end:bigint>>"))
    text = lambda s: F.array_join(
        F.transform(order(s), lambda x: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ","
    )
    count = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")
    return rows.select(
        "doc_id", "rk", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)], F.sha2(text(F.col("base")), 256).alias("base_sha256"),
        text(F.concat("base", added)).alias("spans"), F.size(added).cast("long").alias("n_added"),
    )


def _accept(flat: DataFrame, total: int, trees: int, depth: int, precision: float) -> DataFrame:
    """rk and `added` spans: candidates over their kind's threshold that touch no stated span and no better candidate."""
    lot = F.pmod(F.xxhash64("rk", "kind", "start", F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    part = F.when(lot < 0.7, 0).otherwise(1)
    # MLlib looks for splits in a sample of the square of maxBins, 10,000 rows at least; so wide it takes every row
    bins = max(32, math.isqrt(total) + 1)
    columns = [f"f_{x}" for x in FEATURES]
    flat = flat.withColumn("part", part)
    model = Pipeline(
        stages=[
            VectorAssembler(inputCols=columns, outputCol="features"),
            GBTClassifier(labelCol="label", featuresCol="features", maxIter=trees, maxDepth=depth, maxBins=bins, seed=3, stepSize=0.3),
        ]
    ).fit(flat.where("part = 0").select("label", *columns))
    scored = keep(model.transform(flat).withColumn("p", vector_to_array("probability")[1]).select("rk", "kind", "start", "end", "touch", "label", "part", "p"))
    # candidates held out of the fit set the thresholds
    heights = scored.where("part = 1").groupBy("kind", F.floor(F.col("p") * 100).cast("int").alias("bin")).agg(F.sum("label").alias("good"), F.count("*").alias("n")).collect()
    limit = {}
    for kind in range(len(KINDS)):
        good = n = 0.0
        for r in sorted((r for r in heights if r["kind"] == kind), key=lambda r: -r["bin"]):
            good, n = good + r["good"], n + r["n"]
            if n >= 20 and good / n >= precision:
                limit[kind] = max(0.5, r["bin"] / 100)
    over = F.lit(False)
    for kind, p in limit.items():
        over = over | ((F.col("kind") == kind) & (F.col("p") >= p))
    free = scored.where(over & ~F.col("touch")).groupBy("rk").agg(F.array_sort(F.collect_set(F.struct((-F.col("p")).alias("q"), "start", "end", "kind"))).alias("c"))
    one = "array<struct<kind:int,start:bigint,end:bigint>>"
    picked = F.aggregate(
        "c", F.array().cast(one),
        lambda a, x: F.when(
            F.exists(a, lambda b: (b["start"] < x["end"]) & (b["end"] > x["start"])), a
        ).otherwise(F.array_append(a, F.struct(x["kind"].cast("int").alias("kind"), x["start"].alias("start"), x["end"].alias("end"))).cast(one)),
    )
    return free.select("rk", picked.alias("added"))
