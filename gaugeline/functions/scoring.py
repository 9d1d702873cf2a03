"""Health status and score."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three accepted states.
HEALTHY, WARNING, CRITICAL = "Healthy", "Warning", "Critical"


def is_faulty(status: Column) -> Column:
    """TRUE for Critical and Warning; an unknown status counts as not faulty."""
    return F.coalesce(status.isin(CRITICAL, WARNING), F.lit(False))


def health_score(total: Column, critical: Column, warning: Column) -> Column:
    """100 less the share of critical readings and half the share of warnings, never below 0."""
    raw = 100.0 - critical / total * 100.0 - warning / total * 50.0
    return F.when(total > 0, F.when(raw < 0, 0.0).otherwise(raw)).otherwise(100.0)
