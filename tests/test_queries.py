"""Registered queries against their SQL, and the shape of their plans."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from hillwarden.catalog.fixtures import TABLES

from conftest import SF

SAMPLE = [
    "clean_readings", "node_alerts", "rain_rolling_totals", "rain_gaps", "rainfall_alerts", "merge_alert_intervals", "event_starts",
    "marker_levels_recomputed", "marker_displacement", "quake_alerts", "nearest_gauges", "on_duty", "event_context", "roc_curve",
    "threshold_sweep", "upsert_triggers", "release_schedule", "sent_matching", "attendance", "stream_rain_sums",
    "stream_decoded", "stream_enriched", "stream_alert_intervals", "stream_silence",
]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    return str(v) if v is not None else None


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(v) for v in r) for r in df.select(*cols).collect()), key=str)
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in at) for r in cur.fetchall()), key=str)
    assert got == want


@pytest.mark.parametrize("name", ["clean_readings", "node_alerts", "quake_alerts", "nearest_gauges", "merge_alert_intervals", "event_starts", "untagged_rain", "movement_after_quake", "roc_curve", "on_duty"])
def test_no_nested_loops(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_time_bounds_reach_the_scan(spark):
    plan = entry.queries()["bounded_rain"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts" in plan and "LessThan(ts" in plan
