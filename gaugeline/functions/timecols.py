"""Epoch-millisecond arithmetic.

Dates and hours are UTC by construction: they are computed from the number itself, so the
result does not depend on the session time zone.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

MS_PER_HOUR = 3_600_000
MS_PER_DAY = 86_400_000


def epoch_millis(value: Column) -> Column:
    """Text or number to whole milliseconds; NULL where it is no number."""
    return F.coalesce(value.try_cast("bigint"),
                      value.try_cast("decimal(30,6)").try_cast("bigint"))


def time_bucket(millis: Column, width_ms: int) -> Column:
    return F.floor(millis / F.lit(float(width_ms)))


def date_of(millis: Column) -> Column:
    """UTC calendar date; NULL when the number lies outside the range of dates."""
    return F.date_from_unix_date(time_bucket(millis, MS_PER_DAY).try_cast("int"))


def hour_of(millis: Column) -> Column:
    return F.pmod(time_bucket(millis, MS_PER_HOUR), F.lit(24)).cast("int")
