"""Event-time helpers on zone-less timestamps (session zone must be UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the feed format.
EVENT_TIME_PATTERN = "yyyy-MM-dd HH:mm:ss.SSS"
EVENT_TIME_CHARS = 23
EPOCH = "1970-01-01 00:00:00"


def ntz(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("timestamp_ntz")


def micros(col: Column | str) -> Column:
    return F.unix_micros((F.col(col) if isinstance(col, str) else col).cast("timestamp"))


def from_micros(us: Column) -> Column:
    return F.timestamp_micros(us).cast("timestamp_ntz")


def shift(col: Column | str, seconds: int) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c + F.make_dt_interval(secs=F.lit(seconds))


def floor_div(a: Column, b: int) -> Column:
    """Integer floor division that also holds before 1970."""
    return ((a - F.pmod(a, F.lit(b))) / F.lit(b)).cast("long")


def step_floor(ts: Column | str, step_us: int) -> Column:
    """Number of the last grid point at or before ``ts``."""
    return floor_div(micros(ts), step_us)


def step_ceil(ts: Column | str, step_us: int) -> Column:
    """Number of the first grid point at or after ``ts``.

    A bar stamped exactly on a grid point belongs to the window that ends there.
    """
    return floor_div(micros(ts) + F.lit(step_us - 1), step_us)


def step_time(no: Column | str, step_us: int) -> Column:
    c = F.col(no) if isinstance(no, str) else no
    return from_micros(c * F.lit(step_us))


def trade_event_time(text: Column | str) -> Column:
    """Trade clock: a fixed-width text pattern; anything else becomes 1970."""
    c = F.col(text) if isinstance(text, str) else text
    cut = F.substring(F.replace(c, F.lit("T"), F.lit(" ")), 1, EVENT_TIME_CHARS)
    parsed = F.try_to_timestamp(cut, F.lit(EVENT_TIME_PATTERN)).cast("timestamp_ntz")
    return F.coalesce(parsed, F.lit(EPOCH).cast("timestamp_ntz"))


def iso_millis(text: Column | str) -> Column:
    """ISO-8601 text with a zone to epoch milliseconds, sub-millisecond cut off."""
    c = F.col(text) if isinstance(text, str) else text
    return F.unix_millis(F.try_to_timestamp(c))


def millis_time(ms: Column | str) -> Column:
    c = F.col(ms) if isinstance(ms, str) else ms
    return F.timestamp_millis(c).cast("timestamp_ntz")
