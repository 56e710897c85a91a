"""Partitioned tables on plain files: upserts that touch only what changes, and appends that a replayed batch repeats safely.

Files are replaced by dynamic partition overwrite, from rows that are staged
first, so a job that dies half-way leaves either the old partitions or a
complete staged copy to finish from. One writer per table at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .tables import upsert, upsert_accumulate


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _fs(spark, path)
    fs.delete(where, True)


def _staged(path: str) -> str:
    """Staging folder beside a table, not inside it."""
    head, _, tail = path.rstrip("/").rpartition("/")
    return f"{head}/_staged-{tail}"


def _install(spark: SparkSession, path: str, by: str) -> None:
    """Put the staged partitions in place of the table's, then drop the staged copy."""
    rows = spark.read.parquet(_staged(path))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    remove(spark, _staged(path))


def finish(spark: SparkSession, path: str, by: str) -> None:
    """Complete a replacement that was cut off; an incomplete staged copy is dropped."""
    staged = _staged(path)
    if exists(spark, f"{staged}/_SUCCESS"):
        _install(spark, path, by)
    elif exists(spark, staged):
        remove(spark, staged)


def replace_partitions(rows: DataFrame, path: str, by: str) -> None:
    """Replace the partitions that ``rows`` name; files of all others stay as they are.

    ``rows`` may read the table itself: they are stored before it is touched.
    """
    rows.repartition(by).write.mode("overwrite").partitionBy(by).parquet(_staged(path))
    _install(rows.sparkSession, path, by)


def _touched(path: str, updates: DataFrame, by: str, most: int = 10_000) -> DataFrame:
    """Rows of the partitions the updates fall into; up to ``most`` partition values are listed, so that the scan skips the rest."""
    old = updates.sparkSession.read.schema(updates.schema).parquet(path)
    parts = updates.select(by).distinct()
    some = [r[0] for r in parts.limit(most + 1).collect()]
    if len(some) <= most:
        return old.filter(_one_of(by, some))
    parts = parts.withColumnRenamed(by, "__by")
    return old.join(parts, old[by].eqNullSafe(parts["__by"]), "left_semi")


def _one_of(by: str, values: list) -> Column:
    known = F.col(by).isin(*[v for v in values if v is not None])
    return known | F.col(by).isNull() if None in values else known


def _into(path: str, updates: DataFrame, by: str, merge) -> None:
    spark = updates.sparkSession
    finish(spark, path, by)
    old = _touched(path, updates, by) if exists(spark, path) else updates.limit(0)
    replace_partitions(merge(old.select(updates.columns), updates), path, by)


def upsert_into(path: str, updates: DataFrame, keys: Sequence[str], by: str, version: str) -> None:
    """Upsert into a table of files partitioned by ``by``; per key the last version wins in every column.

    ``by`` must be one of the keys or follow from them, or a key would be
    looked for in the wrong partition. Only partitions with updates are read
    and rewritten. Applying the same updates twice changes nothing.
    """
    cols = [*updates.columns]
    _into(path, updates, by, lambda old, new: upsert(old, new, [*keys] if by in keys else [*keys, by], version).select(cols))


def accumulate_into(path: str, updates: DataFrame, keys: Sequence[str], sums: Sequence[str], by: str) -> None:
    """Add counters to a table of files partitioned by ``by``, one of the keys. Not safe to apply twice."""
    if by not in keys:
        raise ValueError("the partition column must be a key")
    _into(path, updates, by, lambda old, new: upsert_accumulate(old, new, keys, sums).select(updates.columns))


# --- appends of numbered batches -----------------------------------------------


def begin_batch(spark: SparkSession, out: str, batch: int) -> bool:
    """Note that a batch starts; true if it may have started before.

    The note is written before any row. Batches are numbered upwards and a
    batch only starts once those before it are done, so only the last one
    noted can have left rows of an attempt that died.
    """
    note = f"{out}/_started"
    if exists(spark, f"{note}/_SUCCESS"):
        before = spark.read.schema("batch long").parquet(note).agg(F.max("batch")).first()[0]
        if before is not None and before >= batch:
            return True
        again = False
    else:
        again = exists(spark, note)  # the note itself was cut off
    spark.createDataFrame([(batch,)], "batch long").coalesce(1).write.mode("overwrite").parquet(note)
    return again


def drop_batch(spark: SparkSession, path: str, batch: int, by: str) -> None:
    """Take the rows of one batch out of a table; only partitions that hold some are rewritten."""
    finish(spark, path, by)
    if not exists(spark, path):
        return
    table = spark.read.parquet(path)
    hit = table.filter(F.col("batch") == batch)
    parts = [r[0] for r in hit.select(by).distinct().collect()]  # days of one micro-batch
    if not parts:
        return
    left = table.filter(_one_of(by, parts) & ((F.col("batch") != batch) | F.col("batch").isNull()))
    kept = {r[0] for r in left.select(by).distinct().collect()}
    if kept:
        replace_partitions(left, path, by)
    for value in parts:
        if value not in kept:
            remove(spark, f"{path}/{by}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}")


def append_batch(rows: DataFrame, path: str, batch: int, by: str, value: Column) -> DataFrame:
    """Append rows with their batch number, one file a partition; returns what the batch has stored."""
    spark = rows.sparkSession
    d = rows.withColumns({by: value, "batch": F.lit(batch).cast("long")})
    d.repartition(by).write.mode("append").partitionBy(by).parquet(path)
    return spark.read.schema(d.schema).parquet(path).filter(F.col("batch") == batch)
