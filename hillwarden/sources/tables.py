"""Reading sensor families and writing results as Spark tables or files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F



def read_family(df: DataFrame, start: str, end: str, names: Sequence[int | str] | None = None, key: str = "tsm_id", cols: Sequence[str] = ("*",), exclusive: bool = False) -> DataFrame:
    """Time-bounded, projected slice of one family; bounds and names reach the scan.

    Literal bounds on the raw time column and an IN list on the partition
    column are what Parquet filters and partition pruning can use.
    """
    a, b, t = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz"), F.col("ts")
    d = df.filter((t > a) & (t < b)) if exclusive else df.filter((t >= a) & (t <= b))
    if names is not None:
        d = d.filter(F.col(key).isin(*names))
    return d.select(*cols)


def write_family(df: DataFrame, path: str, key: str = "tsm_id") -> None:
    """One long table per family, partitioned by day and clustered by sensor."""
    (
        df.withColumn("day", F.to_date("ts")).repartition("day", key).sortWithinPartitions("day", key, "ts")
        .write.mode("overwrite").partitionBy("day").parquet(path)
    )


def resolve_sensors(dim: DataFrame, at: Column) -> DataFrame:
    live = (F.col("date_deactivated").isNull() | (F.col("date_deactivated") >= at)).cast("int")
    return dim.groupBy("tsm_name").agg(F.max_by("tsm_id", F.struct(live, -F.col("tsm_id"))).alias("tsm_id"))


def current_sensors(dim: DataFrame, end: Column) -> DataFrame:
    """Latest activated sensor of each logger not deactivated by ``end``."""
    live = dim.filter(F.col("date_deactivated").isNull() | (F.col("date_deactivated") > end))
    return live.groupBy("logger_id").agg(F.max_by("tsm_id", F.struct("date_activated", -F.col("tsm_id"))).alias("tsm_id"))


def read_marker_csv(spark: SparkSession, path: str) -> DataFrame:
    """Marker sheet with tidy headers: upper-case site, title-case marker, parsed time."""
    raw = spark.read.csv(path, header=True)
    d = raw.select(*[F.col(f"`{c}`").alias(c.strip().lower().replace(" ", "_")) for c in raw.columns])
    return d.withColumns(
        {
            "site_code": F.upper(F.trim("site_code")), "marker_name": F.initcap(F.trim("marker_name")),
            "ts": F.try_to_timestamp("ts").cast("timestamp_ntz"), "meas": F.col("meas").try_cast("double"),
        }
    )


# --- writes without MERGE ------------------------------------------------------


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Target after the updates; per key the last version wins in every column.

    One combinable aggregate instead of a ranked window.
    """
    cols = target.columns
    both = target.withColumn("__src", F.lit(0)).unionByName(updates.select(*cols).distinct().withColumn("__src", F.lit(1)))
    rest = [c for c in cols if c not in keys]
    return both.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct("__src", version)).alias("r")).select(
        *[F.col(c) if c in keys else F.col(f"r.{c}").alias(c) for c in cols]
    )


def upsert_accumulate(target: DataFrame, updates: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """On conflict the counters add up."""
    return target.unionByName(updates).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def insert_missing(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.unionByName(new.join(target.select(*keys).distinct(), list(keys), "left_anti").select(*target.columns))


def incremental(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Source rows beyond the target's high-water mark (all, if it is empty)."""
    return source.sparkSession.sql(
        f"SELECT s.* FROM {{s}} s WHERE s.{key} > coalesce((SELECT max({key}) FROM {{t}}), (SELECT min({key}) FROM {{s}}) - 1)",
        s=source, t=target,
    )


def normalise_poll(df: DataFrame, since: Column, key: str = "rain_id") -> DataFrame:
    """Polled text rows: 19-character time, numeric rain, one row per time, newer only."""
    d = df.select(key, F.try_to_timestamp(F.substring("ts_text", 1, 19)).cast("timestamp_ntz").alias("ts"), F.col("rain_text").try_cast("double").alias("rain"))
    d = d.filter(F.col("ts") > since)
    return d.groupBy(key, "ts").agg(F.max("rain").alias("rain"))


def placeholder_rows(windows: DataFrame, data: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One -1 row at the end of every polled window without data.

    ``windows``: keys, start_ts, end_ts of at most a day or so; joined by day.
    """
    k = list(keys)
    w = windows.select(*k, "start_ts", "end_ts", F.explode(F.sequence(F.to_date("start_ts"), F.to_date("end_ts"))).alias("__day"))
    d = data.select(*k, F.col("ts").alias("__t"), F.to_date("ts").alias("__day"))
    hit = w.join(d, [*k, "__day"]).filter((F.col("__t") > F.col("start_ts")) & (F.col("__t") <= F.col("end_ts")))
    have = hit.select(*k, "start_ts", "end_ts").distinct()
    return windows.join(have, [*k, "start_ts", "end_ts"], "left_anti").select(*k, F.col("end_ts").alias("ts"), F.lit(-1.0).alias("rain"))


def sync_catalogue(known: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """Gauges to add and to close: (gauge_name, change).

    Sources carry gauge_name, latitude, longitude, deactivated; names must
    mention rain and coordinates must be set.
    """
    now = first.unionByName(second).filter(
        F.lower("gauge_name").rlike("rain") & (F.col("latitude") != 0) & (F.col("longitude") != 0)
    ).groupBy("gauge_name").agg(F.max(F.col("deactivated").cast("int")).alias("off"))
    new = now.filter("off = 0").join(known.select("gauge_name"), "gauge_name", "left_anti").select("gauge_name", F.lit("new").alias("change"))
    closed = now.filter("off = 1").join(known.filter("NOT deactivated").select("gauge_name"), "gauge_name", "left_semi").select("gauge_name", F.lit("deactivated").alias("change"))
    return new.unionByName(closed)


def to_nested_json(df: DataFrame, keys: Sequence[str], item: Sequence[str], path: str | None = None) -> DataFrame:
    """One JSON document per key (keys should include a time bucket to bound it)."""
    d = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*item))).alias("series"))
    if path is not None:
        d.write.mode("overwrite").json(path)
    return d.select(*keys, F.to_json("series").alias("series"))


def map_codes(df: DataFrame, col: str, codes: dict, out: str) -> DataFrame:
    """Code -> text by a map literal."""
    return df.withColumn(out, F.create_map(*[F.lit(x) for kv in codes.items() for x in kv])[F.col(col)])


def status_text(status: DataFrame, keys: Sequence[str], names: dict[int, str]) -> DataFrame:
    """Newest status of each key as text."""
    d = status.groupBy(*keys).agg(F.max_by("status", "date_identified").alias("status"))
    return map_codes(d, "status", names, "text")
