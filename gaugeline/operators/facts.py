"""Fact tables at daily and hourly grain.

Every fact has two forms: one that takes readings, and a ``*_from_*`` form that takes the hourly
partial aggregates the gold job computes once for all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions import CRITICAL, WARNING, health_score
from gaugeline.operators.partials import Part, build_parts, mean_of, merge_parts, part_name
from gaugeline.operators.transitions import health_hours_in_one_scan, reading_counts

GRAIN_KEYS = {"daily": ("date",), "hourly": ("date", "hour")}
_MACHINE = ("location_id", "hvac_machine_id")
_COMPONENT = (*_MACHINE, "component_id")
_TYPED = (*_COMPONENT, "component_type")
PART_KEYS = ("date", "hour", *_TYPED)

# Metrics per component family and the interval that stands in for a duration.
METRIC_FAMILIES = {
    "compressor": ("vibration_mm_s", "suction_temperature_c", "discharge_temperature_c",
                   "suction_pressure_kpa", "discharge_pressure_kpa"),
    "condenser": ("water_inlet_temperature_c", "water_outlet_temperature_c", "fan_speed_rpm",
                  "heat_rejection_efficiency_pct", "approach_temperature_c"),
    "evaporator": ("cooling_capacity_tr", "entering_chilled_water_temperature_c",
                   "leaving_chilled_water_temperature_c", "heat_transfer_efficiency_pct"),
    "expansion_valve": ("valve_opening_pct", "superheat_c", "subcooling_c",
                        "refrigerant_flow_rate_kg_min"),
}
FALLBACK_HOURS = 5.0 / 60.0
# End of fixed values.


def _keys(grain: str, entity: Sequence[str]) -> list[str]:
    return [*GRAIN_KEYS[grain], *entity]


# Component health -------------------------------------------------------------------------

def health_from_hours(hours: DataFrame, grain: str = "daily") -> DataFrame:
    """Fold the output of :func:`health_hours`; the event count exists at daily grain only."""
    keys = _keys(grain, _TYPED)
    summed = ["total_readings", "critical_readings", "warning_readings",
              *(["critical_event_count"] if grain == "daily" else [])]
    return _scored(hours.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in summed],
                                            F.max("max_code").alias("max_code")), keys)


def _scored(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fault code and score beside the counts."""
    measures = [c for c in counts.columns if c not in keys and c != "max_code"]
    columns = [*keys, *measures,
               F.coalesce(F.col("max_code").try_cast("int"), F.lit(0))
               .alias("critical_reading_code"),
               health_score(F.col("total_readings"), F.col("critical_readings"),
                            F.col("warning_readings")).alias("health_score_pct")]
    return counts.select(*columns)


def component_states(df: DataFrame, grain: str = "daily") -> DataFrame:
    """Component health without the event count: one aggregation, no ordering of readings."""
    keys = _keys(grain, _TYPED)
    return _scored(df.groupBy(*keys).agg(*reading_counts()), keys)


def component_health(df: DataFrame, grain: str = "daily") -> DataFrame:
    if grain == "hourly":
        return component_states(df, grain)
    return health_from_hours(health_hours_in_one_scan(df), grain)


# Energy -----------------------------------------------------------------------------------

_POWER, _POWER_TS = "power_consumption_kw", "power_ts"
ENERGY_PARTS: tuple[Part, ...] = (("n", _POWER), ("sum", _POWER), ("min", _POWER), ("max", _POWER),
                                  ("min", _POWER_TS), ("max", _POWER_TS))


def with_power_time(df: DataFrame) -> DataFrame:
    """Instant of every reading that reports power; energy durations span only these."""
    return df.withColumn(_POWER_TS, F.when(F.col(_POWER).isNotNull(), F.col("timestamp")))


def energy_from_parts(parts: DataFrame, grain: str = "daily") -> DataFrame:
    """Mean, peak and lowest power, covered hours and energy = mean power x covered hours."""
    keys = _keys(grain, _TYPED)
    merged = merge_parts(parts, keys).filter(F.col(part_name("n", _POWER)) > 0)
    span = (F.col(part_name("max", _POWER_TS)) - F.col(part_name("min", _POWER_TS))) / 1000 / 3600
    energy = "daily_energy_kwh" if grain == "daily" else "hourly_energy_kwh"
    return merged.select(
        *keys, mean_of(_POWER).alias("avg_power_kw"),
        F.col(part_name("max", _POWER)).alias("max_power_kw"),
        F.col(part_name("min", _POWER)).alias("min_power_kw"),
        F.col(part_name("n", _POWER)).alias("total_readings"),
        F.when(span > 0, span).otherwise(F.lit(FALLBACK_HOURS)).alias("duration_hours"),
    ).withColumn(energy, F.col("avg_power_kw") * F.col("duration_hours"))


def energy_consumption(df: DataFrame, grain: str = "daily") -> DataFrame:
    """From readings with normalised power; readings without power take no part."""
    powered = with_power_time(df.filter(F.col(_POWER).isNotNull()))
    return energy_from_parts(build_parts(powered, _keys(grain, _TYPED), ENERGY_PARTS), grain)


# Machine alerts ---------------------------------------------------------------------------

def alert_parts(df: DataFrame, grain: str = "hourly") -> DataFrame:
    """Critical and warning readings per machine, hour (or day) and fault code.

    Keeping the code as a key makes distinct counts mergeable: a coarser grain groups by code
    again and counts rows. Codes that are missing, not positive or NaN share the NULL code.
    """
    coded = df.withColumn("fault_code", _usable_code())
    return coded.groupBy(*_keys(grain, _MACHINE), "fault_code").agg(
        F.count_if(F.col("health_status") == CRITICAL).alias("sum__critical"),
        F.count_if(F.col("health_status") == WARNING).alias("sum__warning"))


def _usable_code() -> Column:
    code = F.col("health_active_fault_code").cast("double")
    return F.when((code > 0) & ~F.isnan(code), code)


def alerts_from_parts(parts: DataFrame, grain: str = "daily") -> DataFrame:
    keys = _keys(grain, _MACHINE)
    per_code = merge_parts(parts, [*keys, "fault_code"])
    return per_code.groupBy(*keys).agg(
        F.sum("sum__critical").alias("total_critical_alerts"),
        F.sum("sum__warning").alias("total_warning_alerts"),
        F.count("fault_code").alias("unique_fault_codes"))


def machine_alerts(df: DataFrame, grain: str = "daily") -> DataFrame:
    return alerts_from_parts(alert_parts(df, grain), grain)


# Machine performance ----------------------------------------------------------------------

PERFORMANCE_PARTS: tuple[Part, ...] = (
    ("min", "run_hours"), ("max", "run_hours"), ("min", "start_stop_count"),
    ("max", "start_stop_count"), ("n", "cop"), ("sum", "cop"), ("n", "eer"), ("sum", "eer"))


def performance_from_parts(parts: DataFrame) -> DataFrame:
    """Compressor-day growth and means first, then the largest growth and the mean of means."""
    day = merge_parts(parts, _keys("daily", _COMPONENT))

    def growth(column: str) -> Column:
        return F.col(part_name("max", column)) - F.col(part_name("min", column))

    return (day.select("date", *_MACHINE, growth("run_hours").alias("_hours"),
                       growth("start_stop_count").alias("_starts"),
                       mean_of("cop").alias("_cop"), mean_of("eer").alias("_eer"))
            .groupBy("date", *_MACHINE).agg(
                F.max("_hours").alias("max_run_hours"), F.max("_starts").alias("max_start_stops"),
                F.avg("_cop").alias("avg_cop"), F.avg("_eer").alias("avg_eer")))


def machine_performance_daily(compressor: DataFrame) -> DataFrame:
    return performance_from_parts(
        build_parts(compressor, _keys("daily", _COMPONENT), PERFORMANCE_PARTS))


# Metric rollups ---------------------------------------------------------------------------

def metric_parts(metrics: Sequence[str]) -> list[Part]:
    return [(kind, m) for m in metrics for kind in ("n", "sum", "max")]


def metrics_from_parts(parts: DataFrame, metrics: Sequence[str],
                       grain: str = "daily") -> DataFrame | None:
    """Mean and maximum of each metric the parts hold; None when they hold none of them."""
    held = [m for m in metrics if part_name("n", m) in parts.columns]
    if not held:
        return None
    keys = _keys(grain, _COMPONENT)
    columns = [c for m in held
               for c in (mean_of(m).alias(f"avg_{m}"),
                         F.col(part_name("max", m)).alias(f"max_{m}"))]
    return merge_parts(parts, keys).select(*keys, *columns)


def metric_rollup(df: DataFrame, metrics: Sequence[str], grain: str = "daily") -> DataFrame | None:
    present = [m for m in metrics if m in df.columns]
    if not present:
        return None
    parts = build_parts(df, _keys(grain, _COMPONENT), metric_parts(present))
    return metrics_from_parts(parts, present, grain)


# All measures of a component in one pass ----------------------------------------------------

def component_parts(df: DataFrame, component: str) -> DataFrame:
    """Hourly partial aggregates that energy, performance, metric and KPI tables derive from."""
    parts: list[Part] = [*ENERGY_PARTS, *metric_parts(METRIC_FAMILIES[component])]
    if component == "compressor":
        parts += [*PERFORMANCE_PARTS, ("max", "run_status")]
    return build_parts(with_power_time(df), PART_KEYS, parts)


def kpi_parts(df: DataFrame) -> DataFrame:
    """Hourly partial aggregates of all components for the KPIs, from one pass over the readings.

    The fault code is a key beside those of the hour, so that distinct codes, reading counts, energy, cop
    and running state all merge from the same rows: :func:`alerts_from_parts`,
    :func:`energy_from_parts`, :func:`performance_from_parts` and the KPIs take them as they are.
    """
    status = F.col("health_status")
    rows = with_power_time(df).withColumns({
        "fault_code": _usable_code(), "reading": F.when(F.col("timestamp").isNotNull(), 1),
        "critical": (status == CRITICAL).cast("int"), "warning": (status == WARNING).cast("int")})
    counted = [("sum", c) for c in ("reading", "critical", "warning")]
    parts = build_parts(rows, [*PART_KEYS, "fault_code"],
                        [*counted, *ENERGY_PARTS, *PERFORMANCE_PARTS, ("max", "run_status")])
    return parts.fillna(0, [part_name(*c) for c in counted])
