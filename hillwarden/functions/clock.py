"""Time expressions. All work on TIMESTAMP and TIMESTAMP_NTZ alike."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def at(ts: str) -> Column:
    """Literal wall-clock time."""
    return F.lit(ts).cast("timestamp_ntz")


def micros(c: ColumnLike) -> Column:
    return F.timestamp_diff("MICROSECOND", at("1970-01-01"), col(c))


def seconds_between(a: ColumnLike, b: ColumnLike) -> Column:
    """(b - a) in seconds, as double."""
    return F.timestamp_diff("MICROSECOND", col(a), col(b)) / F.lit(1e6)


def span(**parts) -> Column:
    """Day-time interval from days / hours / mins / secs, columns or numbers."""
    lits = {k: (v if isinstance(v, Column) else F.lit(v)) for k, v in parts.items()}
    if "secs" in lits:
        lits["secs"] = lits["secs"].cast("decimal(18,6)")
    return F.make_dt_interval(**lits)


def floor_to(c: ColumnLike, minutes: int) -> Column:
    """Largest multiple of ``minutes`` since the epoch at or before ``c``."""
    return col(c) - span(secs=F.pmod(micros(c), F.lit(minutes * 60_000_000)) / 1e6)


def half_hour(c: ColumnLike) -> Column:
    return floor_to(c, 30)


def right_closed_slot(c: ColumnLike, minutes: int = 30) -> Column:
    """Left edge of the bin (t, t + minutes] holding ``c``."""
    return floor_to(col(c) - F.expr("INTERVAL '0.000001' SECOND"), minutes)


def release_time(c: ColumnLike, hours: int = 4) -> Column:
    """Next release boundary strictly after ``c``."""
    return floor_to(c, hours * 60) + span(hours=hours)


def shift_of(c: ColumnLike) -> Column:
    """Start (08:00 or 20:00) of the 12-hour shift holding ``c``."""
    return floor_to(col(c) - span(hours=8), 720) + span(hours=8)


def next_shift(c: ColumnLike) -> Column:
    return shift_of(c) + span(hours=12)


def roster_shift(day: ColumnLike, half: ColumnLike) -> Column:
    """Roster day plus AM / PM label -> 08:00 or 20:00."""
    return col(day).cast("timestamp_ntz") + span(
        hours=F.when(F.upper(col(half)) == "AM", 8).otherwise(20)
    )


def quarter_start(c: ColumnLike) -> Column:
    return F.date_trunc("quarter", col(c)).cast("timestamp_ntz")


def quarter_end(c: ColumnLike) -> Column:
    """First instant of the next quarter."""
    return F.add_months(F.to_date(quarter_start(c)), 3).cast("timestamp_ntz")


def clean_round(c: ColumnLike, digits: int) -> Column:
    """Half-up rounding without negative zero."""
    return F.round(col(c), digits) + F.lit(0.0)
