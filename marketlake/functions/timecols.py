"""Time helpers for TIMESTAMP_NTZ columns that hold UTC wall clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EASTERN = "America/New_York"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_eastern(ts, zone: str = EASTERN) -> Column:
    """UTC wall clock -> local wall clock (DST aware), stays NTZ."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(ts))


def to_utc(ts, zone: str = EASTERN) -> Column:
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), _col(ts))


def floor_to(ts, unit: str) -> Column:
    """date_trunc returns a zoned TIMESTAMP; cast back so NTZ stays NTZ."""
    return F.date_trunc(unit, _col(ts)).cast("timestamp_ntz")


def ceil_to(ts, unit: str) -> Column:
    c = _col(ts)
    fl = floor_to(c, unit)
    step = F.expr(f"interval 1 {unit}")
    return F.when(fl == c, fl).otherwise(fl + step)


def elapsed_micros(a, b) -> Column:
    return F.timestamp_diff("MICROSECOND", _col(a), _col(b))


def elapsed_minutes(a, b) -> Column:
    return elapsed_micros(a, b) / 6e7


def elapsed_hours(a, b) -> Column:
    return elapsed_micros(a, b) / 3.6e9


def second_boundaries(a, b) -> Column:
    """Number of whole-second boundaries crossed from a to b (warehouse datediff)."""
    return F.timestamp_diff("SECOND", floor_to(a, "second"), floor_to(b, "second"))
