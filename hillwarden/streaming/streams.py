"""Structured Streaming twins of the batch operators.

Event times must be TIMESTAMP (watermarks reject TIMESTAMP_NTZ). Every query
takes a streaming DataFrame and returns one; the caller chooses the sink, the
trigger and a checkpoint folder that all executors share.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..operators import decode_logger as D, decode_text as X, routing as RT
from ..sources import sinks as SK


def file_stream(spark: SparkSession, path: str, schema: str, max_files: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def timed(df: DataFrame, delay: str, ts: str = "ts") -> DataFrame:
    """Cast the event time and set the watermark."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


# --- decoding ----------------------------------------------------------------

Registries = dict[str, DataFrame]

# family -> (route, decoder of that route with the registries of the batch, time column)
FAMILIES: dict[str, tuple[str, Callable[[DataFrame, Registries], DataFrame], str]] = {
    "tilt_v2": ("v2", lambda m, r: D.decode_v2(m), "ts"),
    "soms_v2": ("v2", lambda m, r: D.decode_soms(m), "ts"),
    "temp_v2": ("v2", lambda m, r: D.decode_temp(m), "ts"),
    "tilt_v1": ("v1", lambda m, r: D.decode_v1(m)[0], "ts"),
    "soms_v1": ("v1", lambda m, r: D.decode_v1(m)[1], "ts"),
    "tilt_b64": ("b64", lambda m, r: D.decode_b64(m)[0], "ts"),
    "temp_b64": ("b64", lambda m, r: D.decode_b64(m)[1], "ts"),
    "volt": ("diagnostics", lambda m, r: D.decode_diag(m)[0], "ts"),
    "unsent": ("diagnostics", lambda m, r: D.decode_diag(m)[1], "ts"),
    "rain": ("rain_csv", lambda m, r: D.decode_rain_csv(m), "ts"),
    "rain_tips": ("rain_arq", lambda m, r: D.decode_rain_arq(m, r["mobiles"], r["gauges"]), "ts"),
    "router_signal": ("rssi", lambda m, r: D.decode_rssi(m, r["routers"]), "ts"),
    "extensometer": ("extensometer", lambda m, r: D.decode_extensometer(m), "ts"),
    "lidar": ("lidar", lambda m, r: D.decode_lidar(m), "ts"),
    "gnss": ("gnss", lambda m, r: D.decode_gnss(m), "ts"),
    "tilt_vector": ("tilt_vector", lambda m, r: D.decode_tilt_vector(m), "ts"),
    "tilt_vector_v2": ("tilt_vector_v2", lambda m, r: D.decode_tilt_vector_v2(m), "ts"),
    "piezo": ("piezo", lambda m, r: D.decode_piezo(m), "ts"),
    "quakes": ("earthquake", lambda m, r: X.extract_quakes(m), "event_ts"),
    "acknowledgements": ("acknowledgement", lambda m, r: X.extract_acks(m), "ts_ack"),
    # a text is judged at its own time of arrival, so a replay gives the same
    "observations": ("observation", lambda m, r: X.extract_observations(m, r["sites"], F.col("ts")).filter("err_code IS NULL").drop("err_code"), "obs_ts"),
    "status": ("status", lambda m, r: RT.classify_status(m).select("inbox_id", "ts", "sim_num", "status_code"), "ts"),
    "sync": ("unknown", lambda m, r: X.decode_sync(m), "ts"),
}


def decode_batch(messages: DataFrame, out: str, batch: int, registries: Registries, families=FAMILIES) -> None:
    """Write every family, the outcome ledger and the dead letters of one batch.

    One pass routes the batch into a staging table partitioned by route, which
    the next batch replaces; every family reads its route's files only, and a
    route without rows is not decoded. The tables are partitioned by day (of
    the row's time; of arrival for ledger and dead letters), so their folders
    do not grow with the number of batches. Rows carry the batch number: where
    a batch may have run before, its rows are taken out first, so the tables
    hold each message's rows exactly once. Messages need inbox_id, msg,
    sim_num, ts and source.
    """
    spark = messages.sparkSession
    if SK.begin_batch(spark, out, batch):
        for name in (*families, "ledger", "dead_letters"):
            SK.drop_batch(spark, f"{out}/{name}", batch, "day")
    staging, routed = f"{out}/_routed", RT.route(messages)
    routed.write.mode("overwrite").partitionBy("route").parquet(staging)
    routed = spark.read.schema(routed.schema).parquet(staging)
    present = {r[0] for r in routed.select("route").distinct().collect()}  # at most one row a route
    ids = routed.select("inbox_id").limit(0)
    for name, (source, decode, time) in families.items():
        if source in present:
            rows = decode(routed.filter(F.col("route") == source).drop("route"), registries)
            ids = ids.unionByName(SK.append_batch(rows, f"{out}/{name}", batch, "day", F.to_date(time)).select("inbox_id"))
    judged = RT.with_outcome(routed, ids)
    SK.append_batch(judged.select("inbox_id", "ts", "read_status"), f"{out}/ledger", batch, "day", F.to_date("ts"))
    SK.append_batch(judged.filter("read_status = -1").drop("read_status"), f"{out}/dead_letters", batch, "day", F.to_date("ts"))


def decode_stream(messages: DataFrame, out: str, checkpoint: str, registries: Callable[[], Registries], families=FAMILIES, **trigger):
    """Start the decoding stream; the checkpoint takes the place of a read flag.

    ``registries`` is called for every batch and gives the senders, gauges,
    routers and sites as they are then.
    """
    return (
        messages.writeStream.foreachBatch(lambda b, n: decode_batch(b, out, n, registries(), families))
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    )


def enrich_batch(messages: DataFrame, out: str, batch: int, mobiles: DataFrame) -> None:
    """Write one batch's messages with the logger behind their number, partitioned by day of arrival."""
    spark = messages.sparkSession
    if SK.begin_batch(spark, out, batch):
        SK.drop_batch(spark, f"{out}/enriched", batch, "day")
    SK.append_batch(RT.resolve_sender(messages, mobiles), f"{out}/enriched", batch, "day", F.to_date("ts"))


def enrich_stream(messages: DataFrame, mobiles: Callable[[], DataFrame], out: str, checkpoint: str, **trigger):
    """Start a stream-static join with senders.

    A static side inside a streaming plan keeps the files it was planned with.
    Here ``mobiles`` is called for every batch, so a number that is registered
    between two batches is known in the second.
    """
    return (
        messages.writeStream.foreachBatch(lambda b, n: enrich_batch(b, out, n, mobiles()))
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    )


# --- windows -----------------------------------------------------------------


def rain_stream(rain: DataFrame, delay: str = "1 day", width: str = "30 minutes", id: str | None = None) -> DataFrame:
    """Half-hourly sums per gauge; rows later than a day are dropped and counted by Spark.

    ``id``: column of a row's own id; repeats inside the delay then count once,
    and late rows are counted one by one (`LateRows`).
    """
    d = timed(rain, delay).filter("rain >= 0")
    d = d.dropDuplicatesWithinWatermark([id]) if id else d
    return d.groupBy("rain_id", F.window("ts", width)).agg(F.sum("rain").alias("rain")).select("rain_id", F.col("window.start").alias("ts"), "rain")


def item_stream(messages: DataFrame, delay: str = "1 day", width: str = "5 minutes") -> DataFrame:
    d = timed(messages, delay)
    return d.groupBy("source", F.window("ts", width)).agg(F.count(F.lit(1)).alias("items")).select("source", F.col("window.start").alias("bucket"), "items")


def trending_stream(evals: DataFrame, keys: list[str], level: str, delay: str = "1 hour", more_than: int = 3) -> DataFrame:
    """Three-hour windows every half hour with more than ``more_than`` positive evaluations."""
    d = timed(evals, delay).filter(F.col(level) > 0)
    g = d.groupBy(*keys, F.window("ts", "3 hours", "30 minutes")).agg(F.count(F.lit(1)).alias("n"), F.max(level).alias("level"))
    return g.filter(F.col("n") > more_than).select(*keys, F.col("window.end").alias("ts"), "n", "level")


def event_session_stream(points: DataFrame, keys: list[str], delay: str = "1 hour", gap: str = "30 minutes") -> DataFrame:
    d = timed(points, delay)
    g = d.groupBy(*keys, F.session_window("ts", gap)).agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("last_ts"))
    return g.select(*keys, F.col("session_window.start").alias("event_start"), "last_ts", "n")


def dedupe_stream(df: DataFrame, keys: list[str], delay: str = "2 days") -> DataFrame:
    return timed(df, delay).dropDuplicatesWithinWatermark(keys)


def ack_stream(alerts: DataFrame, acks: DataFrame, within: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Alerts with their acknowledgement inside the bound, or without one."""
    a = timed(alerts, delay).alias("a")
    b = timed(acks.select(F.col("stat_id").alias("ack_id"), F.col("ts").alias("ts_ack"), "alert_status"), delay, "ts_ack").alias("b")
    on = F.expr(f"a.stat_id = b.ack_id AND b.ts_ack >= a.ts AND b.ts_ack <= a.ts + INTERVAL {within}")
    return a.join(b, on, "leftOuter").select("a.stat_id", "a.ts", "b.ts_ack", "b.alert_status")


# --- state -------------------------------------------------------------------
# Rows wait in a map state until the watermark has passed them, then they are
# applied in time order. A batch's rows of a key are sorted and put down in
# segments of up to SEGMENT rows; one value holds the key's state, its only timer
# and the segments' first times. So a batch costs a few state calls a key and one
# a segment, and what is due is merged a segment at a time, never all at once.
# The processors use only pandas, so the workers need not have this package.

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MINUTE = 60_000_000  # microseconds
SEGMENT, HELD, EMITTED = 2_000, 200_000, 10_000  # rows: of a segment, sorted at a time, handed on at a time


def _stateful(df: DataFrame, key: str, fold, out: str, columns: list[str], value: str | None = None, tie: str | None = None, initial: DataFrame | None = None) -> DataFrame:
    """Apply ``fold`` to each key's rows in the order (ts, tie), once the watermark has passed them.

    ``fold(state, rows, floor)``: state is a tuple of three integers or Nones
    that begins with an integer, or None; rows a list of (time, tie, value) with
    times in microseconds, floor the time before which no more rows will come.
    It returns the new state (None to forget the key), a list of result tuples
    (key excluded; None or integers, times for columns of type timestamp) and
    the time after which it must be asked again, or None. It may be called for a
    part of the rows that are due, with a floor up to which they are whole.
    ``initial`` holds (key, since, a registration time) of keys that may never
    send a row; their state starts as (since, None, 1).

    State of this kind needs the RocksDB store; it is set for the session
    unless another store was chosen.
    """
    import numpy as np
    from pyspark.sql.streaming import StatefulProcessor

    conf = df.sparkSession.conf
    if conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider"):
        conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    minute, kinds = MINUTE, [c.strip().split(" ")[1] for c in out.split(",")]
    segment, held_rows, emitted, nat = SEGMENT, HELD, EMITTED, -(2**63)

    class Processor(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.run = handle.getValueState("run", "a bigint, b bigint, c bigint, ask bigint, timer bigint, next bigint, id array<bigint>, first array<bigint>")
            self.wait = handle.getMapState("wait", "segment bigint", "t array<bigint>, tie array<bigint>, v array<bigint>")

        def _load(self):
            """State, time to ask at, timer, number of the next segment, segments as (first time, number)."""
            r = self.run.get()
            if r is None:
                return None, None, None, 0, []
            return (None if r[0] is None else tuple(r[:3])), r[3], r[4], r[5], [*zip(r[7], r[6])]

        def _save(self, state, ask, timer, following, segments, gone=None) -> None:
            """``gone``: a timer that has expired and is removed by Spark."""
            if state is None and not segments:
                if timer is not None and timer != gone:
                    self.handle.deleteTimer(timer)
                self.run.clear()
                return
            times = ([min(segments)[0]] if segments else []) + ([ask] if ask is not None else [])
            due = (min(times) // minute + 1) * minute // 1000 if times else None
            if due != timer:
                if timer is not None and timer != gone:
                    self.handle.deleteTimer(timer)
                if due is not None:
                    self.handle.registerTimer(due)
            self.run.update((*(state or (None, None, None)), ask, due, following, [n for _, n in segments], [t for t, _ in segments]))

        def _put(self, rows, following, segments) -> int:
            """Sorted rows (three arrays) as new segments; returns the number after them."""
            for k in range(0, len(rows[0]), segment):
                self.wait.updateValue((following,), tuple(c[k : k + segment].tolist() for c in rows))
                segments.append((int(rows[0][k]), following))
                following += 1
            return following

        @staticmethod
        def _sorted(parts):
            t, tie, v = (np.concatenate(c) for c in zip(*parts))
            by = np.lexsort((v, tie, t))
            return t[by], tie[by], v[by]

        def handleInputRows(self, key, rows, timerValues):
            state, ask, timer, following, segments = self._load()
            parts, n = [], 0
            for b in rows:
                t = b["us"].to_numpy(dtype="int64")
                zero = np.zeros(len(t), dtype="int64")
                parts.append((t, b["tie"].to_numpy(dtype="int64") if "tie" in b else zero, b["value"].to_numpy(dtype="int64") if "value" in b else zero))
                n += len(t)
                if n >= held_rows:
                    following = self._put(self._sorted(parts), following, segments)
                    parts, n = [], 0
            if parts:
                following = self._put(self._sorted(parts), following, segments)
            self._save(state, ask, timer, following, segments)
            return iter([])

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            mine = expiredTimerInfo.getExpiryTimeInMs()
            state, ask, timer, following, segments = self._load()
            if timer != mine:
                return
            floor = timerValues.getCurrentWatermarkInMs() * 1000 // minute * minute
            due = sorted(s for s in segments if s[0] < floor)
            segments = [s for s in segments if s[0] >= floor]
            held, found = tuple(np.empty(0, dtype="int64") for _ in range(3)), []
            for k, (_, number) in enumerate(due):
                more = tuple(np.array(c, dtype="int64") for c in self.wait.getValue((number,)))
                self.wait.removeKey((number,))
                held = self._sorted([held, more]) if len(held[0]) else more
                upto = due[k + 1][0] if k + 1 < len(due) else floor  # what comes later is not before that
                cut = int(np.searchsorted(held[0], upto))
                if cut and k + 1 < len(due):
                    state, new, ask = fold(state, [*zip(*(c[:cut].tolist() for c in held))], upto)
                    held = tuple(c[cut:] for c in held)
                    found += new
                    if len(found) >= emitted:
                        yield self._table(key, found)
                        found = []
            cut = int(np.searchsorted(held[0], floor))
            state, new, ask = fold(state, [*zip(*(c[:cut].tolist() for c in held))], floor)
            following = self._put(tuple(c[cut:] for c in held), following, segments)
            self._save(state, ask, timer, following, segments, mine)
            found += new
            if found:
                yield self._table(key, found)

        def handleInitialState(self, key, initialState, timerValues) -> None:
            since = int(initialState["since"].min())
            _, _, ask = fold((since, None, 1), [], since)
            self._save((since, None, 1), ask, None, 0, [])

        def close(self) -> None:
            pass

        @staticmethod
        def _table(key, found):
            data = {columns[0]: pd.Series([key[0]] * len(found), dtype="object" if key[0] is None or isinstance(key[0], str) else "int64")}
            for n, (name, kind) in enumerate(zip(columns[1:], kinds[1:])):
                values = [f[n] for f in found]
                if kind == "timestamp":
                    data[name] = pd.Series(np.array([nat if v is None else v for v in values], dtype="int64").view("datetime64[us]"))
                else:
                    data[name] = pd.Series(values, dtype="bool" if kind == "boolean" else "int64")
            return pd.DataFrame(data)

    cols = [F.col(key), F.col("ts"), F.unix_micros("ts").alias("us")]
    cols += [F.col(value).cast("long").alias("value")] if value else []
    cols += [F.col(tie).cast("long").alias("tie")] if tie else []
    start = initial.select(F.col(key), F.unix_micros(F.col("since").cast("timestamp")).alias("since")).groupBy(key) if initial is not None else None
    return df.select(*cols).groupBy(key).transformWithStateInPandas(Processor(), out, "append", "EventTime", start)


def _micros(**span) -> int:
    return int(pd.Timedelta(**span) / pd.Timedelta(microseconds=1))


def merge_alert_stream(evals: DataFrame, key: str, level: str, delay: str = "1 hour", gap_minutes: int = 90, tie: str | None = None) -> DataFrame:
    """Alert intervals; an interval is emitted once it can no longer grow.

    Rows are applied in time order, to the microsecond, those of equal time by
    ``tie`` (the first wins), so late rows inside the delay merge as in the
    batch operator.
    """
    gap = _micros(minutes=gap_minutes)

    def fold(state, rows, floor):
        start, end, lv = state or (None, None, None)
        out = []
        for t, _, v in rows:
            if end is not None and t <= end:
                continue
            if end is not None and v == lv and t - end <= gap:
                end = t
            else:
                if end is not None:
                    out.append((start, end, lv))
                start, end, lv = t, t, v
        if end is not None and end + gap < floor:
            out.append((start, end, lv))
            end = None
        return (None, out, None) if end is None else ((start, end, lv), out, end + gap)

    kt = dict(evals.dtypes)[key]
    return _stateful(timed(evals, delay), key, fold, f"{key} {kt}, ts timestamp, ts_updated timestamp, {level} int", [key, "ts", "ts_updated", level], level, tie).withColumn(level, F.col(level).cast("int"))


def cooldown_stream(triggers: DataFrame, key: str, hours: int = 24, delay: str = "1 hour") -> DataFrame:
    """First trigger of a key, then silence until more than a day after the last emitted one."""
    hold = _micros(hours=hours)

    def fold(state, rows, floor):
        last = state[0] if state else None
        out = []
        for t, _, _ in rows:
            if last is None or t > last + hold:
                out.append((t,))
                last = t
        if last is None or last + hold < floor:
            return None, out, None
        return (last, None, None), out, last + hold

    kt = dict(triggers.dtypes)[key]
    return _stateful(timed(triggers, delay), key, fold, f"{key} {kt}, ts timestamp", [key, "ts"])


def silence_stream(facts: DataFrame, key: str, hours: int = 72, delay: str = "1 hour", registry: DataFrame | None = None) -> DataFrame:
    """One row for every silence of more than ``hours``: last_ts, and whether nothing had ever come.

    Each pause between two rows of a device and the pause after its last one
    count, whatever the batches were. ``registry`` (key, since) adds devices
    that may never send: their silence is counted from ``since`` and last_ts is
    null. A silence is reported when it is long enough, once.
    """
    hold = _micros(hours=hours)

    def fold(state, rows, floor):
        last, told, never = state or (None, None, 0)
        out = []
        report = lambda: out.append((None if never else last, bool(never)))
        for t, _, _ in rows:
            if last is not None and not told and t - last > hold:
                report()
            if last is None or never or t > last:
                last, told, never = t, None, 0
        if last is not None and not told and last + hold < floor:
            report()
            told = 1
        return (None, out, None) if last is None else ((last, told, never), out, None if told else last + hold)

    kt = dict(facts.dtypes)[key]
    return _stateful(timed(facts, delay), key, fold, f"{key} {kt}, last_ts timestamp, never boolean", [key, "last_ts", "never"], initial=registry)


# --- late rows -----------------------------------------------------------------


class LateRows(StreamingQueryListener):
    """Counts rows that came behind the watermark, by batch and operator, and keeps the counts in a table if told where.

    Add it with ``spark.streams.addListener``. Rows of the operators above and
    of deduplication are counted one by one; a windowed sum counts what it has
    summed before the state, so ``rain_stream`` can be told the rows' id, and
    then drops late rows before it sums.
    """

    def __init__(self, spark: SparkSession | None = None, path: str | None = None):
        self.spark, self.path, self.counts = spark, path, {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        rows = [(str(p.id), str(p.runId), int(p.batchId), n, int(o.numRowsDroppedByWatermark)) for n, o in enumerate(p.stateOperators) if o.numRowsDroppedByWatermark]
        self.counts.update({r[:4]: r[4] for r in rows})
        if rows and self.path:
            self.spark.createDataFrame(rows, "query string, run string, batch long, operator int, late long").coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def total(self, query: str | None = None) -> int:
        return sum(n for k, n in self.counts.items() if query in (None, k[0]))
