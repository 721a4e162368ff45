"""Which date a run computes, and which date it reads."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Local time is UTC + 5 h 30 min; runs started by hand carry this
# word in their id. A date cast to a string has the form yyyy-MM-dd.
LOCAL_OFFSET = "INTERVAL '05:30' HOUR TO MINUTE"
LOCAL_OFFSET_MICROS = 19_800_000_000
DAY_MICROS = 86_400_000_000
MANUAL_MARK = "manual"


def _local_day(utc: Column) -> Column:
    """Local day of a point in time, whatever the session's time zone.

    A ``timestamp`` is a point in time and is counted from the epoch; a ``timestamp_ntz``
    is read as UTC. The branch is chosen while planning, as the type is a constant.
    """
    micros = F.unix_micros(utc.cast("timestamp")) + F.lit(LOCAL_OFFSET_MICROS)
    since_epoch = F.floor(micros / F.lit(DAY_MICROS)).cast("int")
    counted = F.date_add(F.lit("1970-01-01").cast("date"), since_epoch)
    plain = F.to_date(utc.cast("timestamp_ntz") + F.expr(LOCAL_OFFSET))
    return F.when(F.typeof(utc) == "timestamp", counted).otherwise(plain)


def local_date(utc: Column) -> Column:
    """Local calendar date of a UTC timestamp, as ``yyyy-MM-dd``."""
    return _local_day(utc).cast("string")


def _configured_day(configured: Column) -> Column:
    """One-digit months and days are accepted, as in 2023-5-5; anything else raises."""
    day = F.to_date(F.try_to_timestamp(configured, F.lit("yyyy-M-d")))
    problem = F.concat(F.lit("malformed configured date: "), configured)
    return F.coalesce(day, F.raise_error(problem).cast("date"))


def _compute_day(run_id: Column, utc: Column, configured: Column, run_interval: int) -> Column:
    day = _local_day(utc)
    return (
        F.when(F.contains(run_id, F.lit(MANUAL_MARK)), F.date_sub(day, 1))
        .when(configured != "", _configured_day(configured))
        .otherwise(F.date_add(day, run_interval))
    )


def compute_date(run_id: Column, utc: Column, configured: Column, run_interval: int = 0) -> Column:
    """Manual run: the day before. Else the configured date, unless null or empty.
    Else the local date plus ``run_interval`` days."""
    return _compute_day(run_id, utc, configured, run_interval).cast("string")


def input_date(run_id: Column, utc: Column, configured: Column, run_interval: int = 0) -> Column:
    """The day before the compute date."""
    day = _compute_day(run_id, utc, configured, run_interval)
    return F.date_sub(day, 1).cast("string")
