"""Intermediate tables in the shared folder, and bounded bitmap filters."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest bitmap that is broadcast: 2**27 bits are at most 2,097,152 pairs of longs.
MAX_BITS = 1 << 27

_local: dict[str, str] = {}
_kept: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """Folder of spark.checkpoint.dir; one is made up only where it is unset and the master is local."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if sc.applicationId not in _local:
        _local[sc.applicationId] = tempfile.mkdtemp(prefix="hillwarden-llm-")
    return _local[sc.applicationId]


def keep(df: DataFrame, *by: str) -> DataFrame:
    """Writes df (in folders by `by`) to the shared folder and reads it back, so that later plans start from stored rows.

    The table is removed when the driver's JVM ends, or by `release`.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/hillwarden-llm/{uuid.uuid4().hex}"
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    _kept.append(path)
    return spark.read.schema(df.schema).parquet(path)


def kept_so_far() -> int:
    """Mark for `release`: how many tables have been kept."""
    return len(_kept)


def release(spark: SparkSession, mark: int) -> None:
    """Removes the tables that were kept since `mark`, but not the last one.

    For tables that no frame still in use reads: what a stage has built before its own rows were kept.
    """
    jvm = spark._jvm
    gone = _kept[mark:-1]
    del _kept[mark:-1]
    for path in gone:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def bits_for(rows: int, per_row: int = 16) -> int:
    """Power of two of bits for so many keys, between 2**16 and MAX_BITS."""
    return min(MAX_BITS, max(1 << 16, 1 << (max(1, rows * per_row) - 1).bit_length()))


def slot_of(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(7)), F.lit(bits))


def bitmap(slots: DataFrame) -> DataFrame:
    """One row per 64-bit word that has a set bit, from a frame with a column `slot`."""
    return slots.groupBy(F.shiftright("slot", 6).alias("bm_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(slot & 63))")).alias("bm_bits")
    )


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Column names like the wanted ones that df does not have (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def probe(df: DataFrame, slot: Column, words: DataFrame, into: str) -> DataFrame:
    """df with a boolean column `into`: whether the bitmap has the row's slot. Its size is bounded by MAX_BITS."""
    at, word, bits = fresh(df, "bm_slot", "bm_word", "bm_bits")
    words = words.select(F.col("bm_word").alias(word), F.col("bm_bits").alias(bits))
    joined = df.withColumn(at, slot).join(F.broadcast(words), F.shiftright(F.col(at), 6) == F.col(word), "left")
    hit = F.coalesce(F.expr(f"(shiftrightunsigned(`{bits}`, int(`{at}` & 63)) & 1) = 1"), F.lit(False))
    return joined.withColumn(into, hit).drop(at, word, bits)


def row_key(text: str = "text", doc_id: str = "doc_id") -> Column:
    """64-bit key of a row's id and whole text; rows that are equal in both share it."""
    return F.xxhash64(F.col(doc_id), F.col(text), F.isnull(text), F.lit(11))


def without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of docs whose row key is not in keys (a frame with one column `rk`), with all their columns.

    Rows that miss a bounded bitmap of the keys pass straight through; only
    the others are shuffled for the exact anti join. Columns of docs keep their
    values, whatever their names. Repeated rows share a key; an empty keys
    frame keeps all rows.
    """
    rk, hit = fresh(docs, "rk", "bm_hit")
    bits = bits_for(keys.count())
    words = keep(bitmap(keys.select(slot_of(F.col("rk"), bits).alias("slot"))))
    tagged = probe(docs.withColumn(rk, row_key()), slot_of(F.col(rk), bits), words, hit)
    free = tagged.where(~F.col(hit)).select(docs.columns)
    held = tagged.where(F.col(hit)).join(keys.select(F.col("rk").alias(rk)), rk, "left_anti").select(docs.columns)
    return free.unionByName(held)
