"""Fleet and location KPIs.

Inputs are fact tables or hourly partial aggregates, thus already small next to the readings, so
the joins below are between tables with one row per day or per location and day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline import COMPONENTS
from gaugeline.functions import health_score
from gaugeline.operators.partials import build_parts, mean_of, merge_parts, part_name

# Score cut-offs, named score bands, and the column each component's energy is reported in.
HEALTHY_FROM, WARNING_FROM = 90, 70
SCORE_BANDS = (("healthy", 90), ("needs_check", 70), ("warning", 40), ("critical", 0))
ENERGY_COLUMNS = {
    "compressor": "compressor_power_kwh",
    "condenser": "condenser_fan_power_kwh",
    "evaporator": "pump_power_kwh",
    "expansion_valve": "valve_power_kwh",
}
# End of fixed values.


def online_from_parts(compressor_parts: DataFrame) -> DataFrame:
    running = merge_parts(compressor_parts, ["date", "hvac_machine_id"])
    return (running.filter(F.col(part_name("max", "run_status")) > 0)
            .groupBy("date").agg(F.count("hvac_machine_id").alias("machines_online")))


def machines_online(compressor: DataFrame | None, telemetry: DataFrame) -> DataFrame:
    """Machines with a running compressor per date.

    Without compressor data every reporting machine counts.
    """
    if compressor is None:
        return (telemetry.select("date", "hvac_machine_id").distinct()
                .groupBy("date").agg(F.count("hvac_machine_id").alias("machines_online")))
    return online_from_parts(build_parts(compressor, ["date", "hvac_machine_id"],
                                         [("max", "run_status")]))


def machine_health(health_daily: DataFrame) -> DataFrame:
    """Score of a machine-day from the summed reading counts of its components."""
    return health_daily.groupBy("date", "location_id", "hvac_machine_id").agg(
        F.sum("total_readings").alias("total_readings"),
        F.sum("critical_readings").alias("critical_readings"),
        F.sum("warning_readings").alias("warning_readings"),
    ).withColumn("machine_health_score", health_score(
        F.col("total_readings"), F.col("critical_readings"), F.col("warning_readings")))


def machine_health_from_parts(parts: DataFrame) -> DataFrame:
    """From the output of :func:`facts.kpi_parts`."""
    return machine_health(parts.withColumnsRenamed({
        part_name("sum", "reading"): "total_readings",
        part_name("sum", "critical"): "critical_readings",
        part_name("sum", "warning"): "warning_readings"}))


def fleet_bands(machines: DataFrame) -> DataFrame:
    score = F.col("machine_health_score")
    return machines.groupBy("date").agg(
        F.count_if(score >= HEALTHY_FROM).alias("healthy_count"),
        F.count_if((score >= WARNING_FROM) & (score < HEALTHY_FROM)).alias("warning_count"),
        F.count_if(score < WARNING_FROM).alias("critical_count"),
        F.avg(score).alias("avg_health_score"))


def fleet_presence(telemetry: DataFrame) -> DataFrame:
    """Locations and machines that reported per date; any frame with one row or more per
    (date, location, machine) will do, so pass an aggregated one where there is one."""
    return telemetry.groupBy("date").agg(
        F.count_distinct("location_id").alias("total_locations"),
        F.count_distinct("hvac_machine_id").alias("total_machines"))


def fleet_cop(compressor: DataFrame) -> DataFrame:
    """Mean cop over readings; takes readings or hourly parts."""
    parts = (compressor if part_name("n", "cop") in compressor.columns
             else build_parts(compressor, ["date"], [("n", "cop"), ("sum", "cop")]))
    return merge_parts(parts, ["date"]).select("date", mean_of("cop").alias("avg_cop"))


def fleet_summary(telemetry: DataFrame, online: DataFrame, bands: DataFrame, energy: DataFrame,
                  compressor: DataFrame | None, alerts: DataFrame) -> DataFrame:
    """One row per date. Numbers nothing is known about are 0; without compressor data there is
    no avg_cop column."""
    summary = fleet_presence(telemetry).join(online, "date", "left").join(bands, "date", "left")
    summary = summary.join(
        energy.groupBy("date").agg(F.sum("daily_energy_kwh").alias("total_energy_kwh")),
        "date", "left")
    if compressor is not None:
        summary = summary.join(fleet_cop(compressor), "date", "left")
    faults = alerts.groupBy("date").agg(
        (F.sum("total_critical_alerts") + F.sum("total_warning_alerts"))
        .alias("active_fault_count"))
    return summary.join(faults, "date", "left").fillna(0)


def location_energy(energy_daily: DataFrame) -> DataFrame:
    """Energy per location and date, one column per component type and their total."""
    wide = (energy_daily.groupBy("date", "location_id").pivot("component_type", list(COMPONENTS))
            .agg(F.sum("daily_energy_kwh")).fillna(0.0, list(COMPONENTS))
            .withColumnsRenamed(ENERGY_COLUMNS))
    a, b, c, d = (F.col(x) for x in ENERGY_COLUMNS.values())
    return wide.withColumn("total_power_consumption_kwh", a + b + c + d)


def location_performance(machines: DataFrame, alerts: DataFrame,
                         performance: DataFrame | None) -> DataFrame:
    """Mean machine score, machines, distinct fault codes per machine summed, and mean cop."""
    place = ["date", "location_id"]
    summary = machines.groupBy(*place).agg(
        F.avg("machine_health_score").alias("avg_health_score"),
        F.count_distinct("hvac_machine_id").alias("machines_count"))
    faults = alerts.groupBy(*place).agg(F.sum("unique_fault_codes").alias("total_fault_events"))
    summary = summary.join(faults, place, "left")
    if performance is None:
        summary = summary.withColumn("avg_location_cop", F.lit(0.0))
    else:
        cop = performance.groupBy(*place).agg(F.avg("avg_cop").alias("avg_location_cop"))
        summary = summary.join(cop, place, "left")
    return summary.fillna(0)


def score_bands(scored: DataFrame, bands: Sequence[tuple[str, float]] = SCORE_BANDS,
                score: str = "machine_health_score") -> DataFrame:
    """Label scores with the band whose floor is the highest one reached; NULL below all floors."""
    label = F.lit(None).cast("string")
    for band, floor in sorted(bands, key=lambda b: b[1]):
        label = F.when(F.col(score) >= float(floor), band).otherwise(label)
    return scored.withColumn("score_band", label)


def score_bands_of(scored: DataFrame, bands: DataFrame, score: str = "machine_health_score"
                   ) -> DataFrame:
    """:func:`score_bands` with the bands of a dictionary (band, floor); entries without floor are none.

    The bands, a few rows of configuration, come as one value that every task looks its scores up in.
    """
    floors = (bands.where(F.col("floor").isNotNull())
              .agg(F.sort_array(F.collect_list(F.struct("floor", "band"))).alias("all")).scalar())
    reached = F.filter("_bands", lambda b: b["floor"] <= F.col(score))
    return (scored.withColumn("_bands", floors)
            .withColumn("score_band", F.try_element_at(reached, F.lit(-1))["band"]).drop("_bands"))
