"""Exact deduplication by two passes over a bitmap of text hashes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hillwarden.llm.tables import MAX_BITS, bitmap, bits_for, fresh, keep, probe, row_key, slot_of

WHITE = r"[\x20\x09-\x0D]+"
LAST = 2**63 - 1


def digest(text: str = "text") -> Column:
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), WHITE, " "), 256))


def exact_dedup(docs: DataFrame, *, salts: int = 256, slices: int | None = None) -> DataFrame:
    """One row per row of docs: doc_id, rk (row key), keep_id, group_size, kept, text_sha256.

    Texts are read once, into a stored table of digests. Pass one puts each
    digest into a Bloom filter that counts: slots hit more than once become a
    bitmap. Pass two tests every digest against it; those that miss are unique
    and pass straight through, never shuffled. Only the others are grouped,
    over `salts` shares per digest, so a group of any size is spread. A bitmap
    has MAX_BITS at most; a larger corpus is cut by hash into slices with a
    bitmap each, so the share of falsely suspected rows stays low at any size.

    Null text counts as empty. Of equal texts the smallest doc_id stays (nulls
    last); of repeated rows with that doc_id, one. Texts of any length are
    hashed whole. An empty table gives no rows. Other columns are ignored.
    """
    rows = docs.count()
    slices = slices or max(1, -(-rows * 4 // MAX_BITS))
    bits = bits_for(-(-rows // slices))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("rk"), digest().alias("sha"))
    base = base.withColumn("slice", F.pmod(F.xxhash64("sha", F.lit(3)), F.lit(slices)).cast("int"))
    base = keep(base, *["slice"] * (slices > 1))
    return reduce(DataFrame.unionByName, (_decide(base.where(F.col("slice") == k), bits, salts, slices > 1) for k in range(slices)))


def _decide(base: DataFrame, bits: int, salts: int, store: bool) -> DataFrame:
    slot = slot_of(F.col("sha"), bits)
    twice = base.select(slot.alias("slot")).groupBy("slot").count().where("count > 1")
    tagged = probe(base, slot, keep(bitmap(twice)), "again")
    alone = tagged.where(~F.col("again")).select(
        "doc_id", "rk", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha"
    )
    # kept in a table, so that the row numbers do not change between reads
    again = keep(
        tagged.where("again")
        .select("doc_id", "rk", "sha", F.monotonically_increasing_id().alias("rid"))
        .withColumn("salt", F.pmod(F.xxhash64("rid"), F.lit(salts)).cast("int"))
        .withColumn("place", F.struct(F.coalesce("doc_id", F.lit(LAST)).alias("doc"), "rid"))
    )
    shares = keep(again.groupBy("sha", "salt").agg(F.min("place").alias("first"), F.count("*").alias("n")))
    groups = shares.groupBy("sha").agg(F.min("first").alias("first"), F.sum("n").alias("group_size"))
    by_share = keep(shares.select("sha", "salt").join(groups, "sha"))
    grouped = again.join(by_share, ["sha", "salt"]).select(
        "doc_id", "rk", F.when(F.col("first.doc") < LAST, F.col("first.doc")).alias("keep_id"), "group_size",
        (F.col("first.rid") == F.col("rid")).alias("kept"), "sha",
    )
    out = alone.unionByName(grouped).withColumn("text_sha256", F.lower(F.hex("sha"))).drop("sha")
    return keep(out) if store else out


def first_copies(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """Rows of docs that stay, with all their columns, whatever their names.

    Rows without a copy miss a bitmap of the copied rows' keys and are not
    shuffled. Equal rows with the same doc_id share a key; one of them stays.
    """
    rk, hit, stays = fresh(docs, "rk", "bm_hit", "xd_kept")
    copied = keep(decisions.where("group_size > 1").groupBy(F.col("rk").alias(rk)).agg(F.bool_or("kept").alias(stays)))
    bits = bits_for(copied.count())
    words = keep(bitmap(copied.select(slot_of(F.col(rk), bits).alias("slot"))))
    tagged = probe(docs.withColumn(rk, row_key()), slot_of(F.col(rk), bits), words, hit)
    free = tagged.where(~F.col(hit)).select(docs.columns)
    held = tagged.where(F.col(hit)).join(copied, rk, "left").where(F.coalesce(F.col(stays), F.lit(True)))
    return free.unionByName(held.dropDuplicates([rk]).select(docs.columns))
