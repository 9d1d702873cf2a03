"""Unit conversion."""

from pyspark.sql import Column
from pyspark.sql import functions as F

LITRES_PER_GALLON = 3.785411784  # fixed value: US liquid gallon


def litres_per_minute(gallons_per_minute: Column) -> Column:
    return F.round(gallons_per_minute.try_cast("double") * F.lit(LITRES_PER_GALLON), 3)
