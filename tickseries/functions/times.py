"""Event times, calendar columns and time buckets as native Spark expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CALENDAR = ("year", "month", "day", "hour", "minute")

# Seconds per grain. In UTC these have a fixed length, so the bucket start is plain integer arithmetic.
FIXED_GRAINS = {"second": 1, "minute": 60, "hour": 3_600, "day": 86_400}
CALENDAR_GRAINS = ("week", "month", "quarter", "year")

# Microseconds per unit of an epoch value. A feed states its unit; it is never guessed from the values.
EPOCH_UNITS = {"epoch_s": Decimal(1_000_000), "epoch_ms": Decimal(1_000), "epoch_us": Decimal(1), "epoch_ns": Decimal("0.001")}

TS_FORMATS = (*EPOCH_UNITS, "timestamp", "string", "string_or_ms")

# The years 1 to 9999 in microseconds.
FIRST_MICROS, LAST_MICROS = -62_135_596_800_000_000, 253_402_300_799_999_999


def _from_epoch(c: Column, unit: str) -> Column:
    """The instant of an epoch number or its text; null if it is no number or lies outside the years 1 to 9999."""
    number, micros = c.try_cast("decimal(30,9)"), EPOCH_UNITS[unit]
    fits = number.between(F.lit(Decimal(FIRST_MICROS) / micros), F.lit(Decimal(LAST_MICROS) / micros))
    return F.when(fits, F.timestamp_micros(F.floor(number * F.lit(micros)).cast("bigint")))


def event_time(column: Column | str, ts_format: str) -> Column:
    """The instant in `column`. Values that cannot be read or lie outside the years 1 to 9999 become null, never an error.

    The formats name the unit of epoch numbers (fractions count), or `timestamp` (a time type or its text) or `string` (text).
    `string_or_ms` is for text that holds a date or epoch milliseconds. A feed in another unit than it
    states shows as years out of range, which the report of the job counts.
    """
    c = F.col(column) if isinstance(column, str) else column
    if ts_format in EPOCH_UNITS:
        return _from_epoch(c, ts_format)
    if ts_format == "timestamp":
        return c.try_cast("timestamp")
    if ts_format == "string":
        return F.try_to_timestamp(c)
    if ts_format == "string_or_ms":
        text = c.cast("string")
        # A date has a hyphen after its year, at the earliest in the second place.
        return F.when(F.locate("-", text) > 1, F.try_to_timestamp(text)).otherwise(_from_epoch(text, "epoch_ms"))
    raise ValueError(f"ts_format must be one of {TS_FORMATS}, not {ts_format!r}")


def calendar_columns(ts: Column | str) -> dict[str, Column]:
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "hour": F.hour(ts),
        "minute": F.minute(ts),
    }


def with_calendar(df: DataFrame, ts: Column | str) -> DataFrame:
    """Add year, month, day, hour and minute in one projection."""
    return df.withColumns(calendar_columns(ts))


def time_bucket(ts: Column | str, grain: str | int) -> Column:
    """Start of the bucket of `grain` (a unit name, or a length in seconds) that holds `ts`."""
    c = F.col(ts) if isinstance(ts, str) else ts
    if grain in CALENDAR_GRAINS:
        return F.date_trunc(grain, c)
    seconds = FIXED_GRAINS[grain] if isinstance(grain, str) else int(grain)
    micros = F.unix_micros(c.cast("timestamp"))
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(seconds * 1_000_000)))
