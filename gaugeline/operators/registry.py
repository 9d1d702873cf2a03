"""Which components a machine carries on a given date, and fleet totals."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeline import COMPONENTS
from gaugeline.operators.reshape import snake_case_columns

# Component type, id prefix and circuit of the six components of a machine.
MACHINE_COMPONENTS = (
    ("compressor", "COMP", "A"), ("compressor", "COMP", "B"),
    ("condenser", "COND", None), ("evaporator", "EVAP", None),
    ("expansion_valve", "EXV", "A"), ("expansion_valve", "EXV", "B"),
)
# End of fixed values.


def _swapped(replacements: DataFrame, on_date: dt.date | str) -> DataFrame:
    """One row per machine with swaps in force: a map from the slot, its place in ``MACHINE_COMPONENTS``,
    to the component of the latest one. A map has no more entries than a machine has slots."""
    slot = F.coalesce(*[F.when((F.col("component_type") == kind) & F.col("circuit_id").eqNullSafe(
        F.lit(circuit).cast("string")), k) for k, (kind, _, circuit) in enumerate(MACHINE_COMPONENTS)])
    latest = Window.partitionBy("hvac_machine_id", "_slot").orderBy(
        F.col("effective_date").desc(), F.col("component_id"))
    known = (replacements.filter(F.col("effective_date") <= F.lit(str(on_date)).cast("date"))
             .withColumn("_slot", slot).filter("_slot IS NOT NULL AND hvac_machine_id IS NOT NULL"))
    # Dealt by machine, rows are ranked and gathered where they are.
    return (known.select("hvac_machine_id", "_slot", "effective_date", "component_id")
            .repartition("hvac_machine_id")
            .withColumn("_rank", F.row_number().over(latest)).filter("_rank = 1")
            .groupBy(F.col("hvac_machine_id").alias("_machine")).agg(F.map_from_entries(
                F.collect_list(F.struct("_slot", "component_id"))).alias("_swaps")))


def component_registry(machines: DataFrame, locations: DataFrame, companies: DataFrame,
                       replacements: DataFrame | None, on_date: dt.date | str) -> DataFrame:
    """One row per component. Ids are built from the location and machine numbers.

    ``replacements`` (hvac_machine_id, component_type, circuit_id, component_id, effective_date)
    lists swapped components; the latest swap in force on ``on_date`` applies. Swaps meet machines, not
    components, so what is shuffled is a row per machine; a use that names no component id needs no swaps.
    """
    site = snake_case_columns(locations).join(
        snake_case_columns(companies).select("company_id", "company_name"), "company_id")
    fleet = snake_case_columns(machines).join(site, "location_id").select(
        "company_id", "company_name", "location_id", "location_name", "city", "state", "country",
        "hvac_machine_id", "manufacturer", "model")
    columns = [*fleet.columns, "component_type", "circuit_id", "component_id"]
    location_no = F.element_at(F.split("location_id", "-"), 2).cast("int")
    machine_no = F.element_at(F.split("hvac_machine_id", "-"), -1).cast("int")
    component_id = F.concat(F.col("_slot.prefix"), F.lit("-"), F.col("_number"),
                            F.coalesce("_slot.circuit_id", F.lit("")))
    if replacements is not None:
        swaps = _swapped(replacements, on_date)
        fleet = fleet.join(swaps, F.col("hvac_machine_id") == F.col("_machine"), "left")
        component_id = F.coalesce(F.col("_swaps")[F.col("_slot.place")], component_id)
    slots = F.array(*[F.struct(
        F.lit(k).alias("place"), F.lit(kind).alias("component_type"),
        F.lit(circuit).cast("string").alias("circuit_id"), F.lit(prefix).alias("prefix"))
        for k, (kind, prefix, circuit) in enumerate(MACHINE_COMPONENTS)])
    return (fleet.withColumn("_number", F.format_string("%02d%02d", location_no, machine_no))
            .withColumn("_slot", F.explode(slots))
            .withColumns({"component_type": F.col("_slot.component_type"),
                          "circuit_id": F.col("_slot.circuit_id"), "component_id": component_id})
            .select(*columns))


def fleet_manifest(registry: DataFrame) -> DataFrame:
    """Per location: machines, components and components by type, with the owning company."""
    by_type = [F.count_if(F.col("component_type") == c).alias(f"{c}_count") for c in COMPONENTS]
    return registry.groupBy("location_id", "location_name", "company_id", "company_name").agg(
        F.count_distinct("hvac_machine_id").alias("machine_count"),
        F.count(F.lit(1)).alias("component_count"), *by_type)


def fleet_totals(manifest: DataFrame) -> DataFrame:
    """One row of fleet-wide totals."""
    columns = ["machine_count", "component_count", *[f"{c}_count" for c in COMPONENTS]]
    return manifest.agg(F.count(F.lit(1)).alias("location_count"),
                        *[F.sum(c).alias(c) for c in columns])
