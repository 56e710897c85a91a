"""Benchmark decontamination by winnowing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hillwarden.llm.tables import keep, row_key

SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Stands in a document's prints once, so that its row is met after they are dealt out.
SELF = -(1 << 63)


def words_of(text: Column) -> Column:
    """Words in order, A-Z lowered (other letters as they are). Null has none."""
    ascii_only = F.lower(text)
    lowered = F.when(F.rlike(text, F.lit(r"[^\x00-\x7F]")), F.translate(text, UPPER, LOWER)).otherwise(ascii_only)
    return F.filter(F.split(F.coalesce(lowered, F.lit("")), SPLIT), lambda w: w != "")


def gram_size(window: int) -> int:
    """Words in a k-gram for windows of so many: the largest of 1, 2, 4, 8 that fits."""
    return 1 << (min(8, window).bit_length() - 1)


def with_prints(rows: DataFrame, sizes: list[int]) -> DataFrame:
    """rows (with `words`) and a column `prints`: of every window its least k-gram hash, each once.

    k-grams double up from words, and so do least values over runs of k-grams.
    Every step is a column of its own that the next reads twice, so Catalyst
    does not put it, as a whole, inside the next one's lambda.
    """
    largest = max(gram_size(n) for n in sizes)
    rows = rows.withColumn("grams1", F.transform("words", lambda w: F.xxhash64(w)))
    k = 1
    while k < largest:
        g = F.col(f"grams{k}")
        rows = rows.withColumn(f"grams{2 * k}", F.zip_with(g, F.slice(g, k + 1, F.size(g)), lambda x, y: F.xxhash64(x, y)))
        k *= 2
    prints = []
    for n in sizes:
        k = gram_size(n)
        left, done, at = n - k + 1, 1, f"grams{k}"
        while done < left:
            step = min(done, left - done)
            m = F.col(at)
            at = f"least{n}_{done + step}"
            rows = rows.withColumn(at, F.zip_with(m, F.slice(m, step + 1, F.size(m)), lambda x, y: F.least(x, y)))
            done += step
        prints.append(F.when(F.size("words") >= n, F.slice(at, 1, F.size("words") - n + 1)).otherwise(F.array().cast("array<bigint>")))
    return rows.withColumn("prints", F.array_distinct(F.concat(F.array(F.lit(SELF)), *prints)))


def starts(sizes: list[int]) -> Column:
    """Where windows of `size` begin that hold a k-gram of hash `print`."""
    def of(n: int) -> Column:
        k = gram_size(n)
        places = F.filter(F.sequence(F.lit(0), F.size("words") - k), lambda i: F.get(f"grams{k}", i) == F.col("print"))
        around = lambda p: F.sequence(F.greatest(F.lit(0), p - (n - k)), F.greatest(F.lit(0), F.least(p, F.size("words") - n)))
        return F.when(F.size("words") >= n, F.array_distinct(F.flatten(F.transform(places, around))))

    out = F.lit(None).cast("array<int>")
    for n in sizes:
        out = F.when(F.col("size") == n, of(n)).otherwise(out)
    return out


def gram_at(start: Column, size: Column) -> Column:
    return F.array_join(F.slice("words", start + 1, size), " ")


def contamination(docs: DataFrame, benchmark: DataFrame, *, window: int = 10, max_broadcast: int = 2_000_000) -> DataFrame:
    """One row per row of docs: doc_id, rk, n_words, n_hit, n_items, items_sha256, contaminated.

    Winnowing keeps, of each window's k-gram hashes (k is 8 for the usual
    window), the least. Any span as long as a window thus has a print in
    common with it. Prints of documents are joined to those of the benchmark's
    windows; a hit is extended to every window around it, which is compared
    word for word, so the result is exact. Benchmark windows up to
    `max_broadcast` are broadcast, so texts are not shuffled; beyond that
    narrow rows are joined by shuffle, and then the words of documents hit.

    A word inside any occurrence of an item window counts as hit. An item
    shorter than the window is one window; null, empty and wordless items and
    texts have none. Repeated items count once per item_id; windows of items
    without an id are hits of no item. Repeated rows of docs get equal results.
    Texts of any length are read whole; other columns are ignored.
    """
    items = keep(benchmark.select(F.col("item_id"), words_of(F.col("text")).alias("words")).where(F.size("words") > 0))
    items = items.withColumn("size", F.least(F.size("words"), F.lit(window)))
    grams = keep(
        items.select("item_id", "size", "words", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("size"))).alias("start"))
        .select("item_id", "size", F.slice("words", F.col("start") + 1, F.col("size")).alias("words"))
        .withColumn("gram", F.array_join("words", " "))
    )
    sizes = sorted(r["size"] for r in grams.select("size").distinct().collect()) or [window]  # at most `window` values
    windows = grams.groupBy("size", "gram").agg(F.first("words").alias("words"))
    wanted = keep(with_prints(windows, sizes).select("size", F.explode_outer("prints").alias("print")).where(F.col("print") != SELF).distinct())
    owners = keep(grams.groupBy("size", "gram").agg(F.collect_set(F.col("item_id").cast("string")).alias("items")))
    small = max(wanted.count(), owners.count()) <= max_broadcast
    side = F.broadcast if small else (lambda d: d)

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("rk"), words_of(F.col("text")).alias("words"))
    read = with_prints(base, sizes)
    carried = sorted({f"grams{gram_size(n)}" for n in sizes})
    # explode() would push a filter on the array's size, and with it the whole expression, below every step of it
    found = read.select("doc_id", "rk", "words", *carried, F.explode_outer("prints").alias("print"))
    itself = F.col("print") == SELF
    if small:
        near = found.join(side(wanted), "print", "left").where(F.col("size").isNotNull() | itself)
    else:
        hit = keep(found.select("rk", "print").where(~itself).join(wanted, "print").distinct())
        near = found.where(itself).select("doc_id", "rk", "words", *carried).join(hit.unionByName(hit.select("rk").distinct().select("rk", F.lit(SELF).alias("print"), F.lit(None).cast("int").alias("size"))), "rk", "left")
        near = near.withColumn("print", F.coalesce("print", F.lit(SELF)))
    at = F.when(itself, F.array(F.struct(F.lit(-1).alias("start"), F.lit("").alias("gram")))).otherwise(
        F.transform(starts(sizes), lambda i: F.struct(i.alias("start"), gram_at(i, F.col("size")).alias("gram")))
    )
    around = near.select("doc_id", "rk", F.when(itself, F.size("words")).alias("n"), "size", F.explode_outer(at).alias("w"))
    hits = around.select("doc_id", "rk", "n", "size", "w.start", "w.gram").join(side(owners), ["size", "gram"], "left").where("n is not null or items is not null")
    rows = hits.groupBy("rk", "doc_id").agg(
        F.max("n").cast("long").alias("n_words"), F.count("n").cast("int").alias("copies"),
        F.collect_set(F.when(F.col("items").isNotNull(), F.struct("start", "size"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    covered = F.aggregate(
        F.array_sort("spans"),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda a, x: F.struct(
            (a["n"] + F.greatest(F.lit(0), x["start"] + x["size"] - F.greatest(x["start"], a["end"]))).alias("n"), F.greatest(a["end"], x["start"] + x["size"]).alias("end")
        ),
    )["n"]
    result = rows.select(
        "doc_id", "rk", "n_words", covered.cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"), "copies",
    )
    return result.withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies")


# The same in DuckDB's SQL, by a plain join of all windows.
SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{SPLIT}'), lambda w: w <> '') AS words FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{SPLIT}'), lambda w: w <> '') AS words FROM benchmark),
bs AS (SELECT item_id, words, least(len(words), 10) AS size FROM b WHERE len(words) > 0),
bg AS (SELECT DISTINCT item_id, size, array_to_string(words[i + 1:i + size], ' ') AS gram FROM (SELECT *, unnest(range(0, len(words) - size + 1)) AS i FROM bs)),
dg AS (SELECT r, size, i, array_to_string(words[i + 1:i + size], ' ') AS gram FROM (SELECT r, words, size, unnest(range(0, len(words) - size + 1)) AS i FROM d, (SELECT DISTINCT size FROM bs))),
h AS (SELECT r, size, i, item_id FROM dg JOIN bg USING (size, gram)),
c AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + size)) AS p FROM h) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS items FROM (SELECT DISTINCT r, item_id::VARCHAR AS x FROM h) GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, c.n IS NOT NULL AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)"""
