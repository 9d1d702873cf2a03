"""Column expressions shared by the operators; every one stays inside the JVM."""

from gaugeline.functions.naming import snake_case
from gaugeline.functions.scoring import CRITICAL, HEALTHY, WARNING, health_score, is_faulty
from gaugeline.functions.timecols import (MS_PER_DAY, MS_PER_HOUR, date_of, epoch_millis,
                                          hour_of, time_bucket)
from gaugeline.functions.units import LITRES_PER_GALLON, litres_per_minute

__all__ = ["snake_case", "CRITICAL", "HEALTHY", "WARNING", "health_score", "is_faulty",
           "MS_PER_DAY", "MS_PER_HOUR", "date_of", "epoch_millis", "hour_of", "time_bucket",
           "LITRES_PER_GALLON", "litres_per_minute"]
