"""Column expressions on times and durations."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

SECONDS_PER_DAY = 86_400


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds from start to end as a double, to the microsecond."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return micros / F.lit(1_000_000.0)


def interval_seconds(interval: Column) -> Column:
    """Seconds of a day-time interval as a double. Summed as a decimal, so nothing is lost."""
    interval = interval.cast("interval day to second")
    whole = (
        F.extract(F.lit("DAY"), interval).cast("bigint") * SECONDS_PER_DAY
        + F.extract(F.lit("HOUR"), interval) * 3600
        + F.extract(F.lit("MINUTE"), interval) * 60
    )
    return (whole.cast("decimal(20,6)") + F.extract(F.lit("SECOND"), interval)).cast("double")


def iso_date(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def day_angle(ts: Column) -> Column:
    """Angle of the time of day on a 24 hour circle, in radians."""
    second = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return second * F.lit(2 * math.pi / SECONDS_PER_DAY)
