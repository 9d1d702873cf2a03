"""Silver to gold: dimensions, facts and KPIs.

The number of passes over silver does not depend on the number of gold tables: one over the sensor
columns for the hourly partial aggregates of each component, and narrow ones for health states,
fault codes and component attributes. The aggregates are stored; all facts and KPIs derive from
them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from gaugeline import COMPONENTS
from gaugeline.operators import dimensions, facts, kpis
from gaugeline.operators.reshape import between_dates, prepare_telemetry, union_components
from gaugeline.operators.transitions import health_hours, health_spans, mixed_buckets
from gaugeline.plans.concurrent import run_all
from gaugeline.sources.reference_data import read_fault_codes, read_topology
from gaugeline.sources.scratch import Scratch
from gaugeline.sources.storage import join_path
from gaugeline.sources.tables import read_table, upsert

KPI_FOLDER = "KPI_Rollups"
FAULT_FILE = "critical_reading_codes.json"

_STATE_COLUMNS = ("date", "hour", "timestamp", "location_id", "hvac_machine_id", "component_id",
                  "component_type", "health_status", "health_active_fault_code")


class _Gold:
    """Writer bound to one run: ``add`` names tables, ``flush`` writes them side by side."""

    def __init__(self, output_dir: str, scratch: Scratch, fmt: str):
        self._output_dir, self._scratch, self._fmt = output_dir, scratch, fmt
        self._waiting: dict[str, Callable[[], DataFrame]] = {}
        self.written: dict[str, DataFrame] = {}

    def add(self, name: str, df: DataFrame | None, keys: list[str], partitioned: bool = True
            ) -> None:
        if df is not None:
            self._waiting[name] = partial(
                upsert, df, join_path(self._output_dir, name), keys, self._scratch,
                ["date"] if partitioned else [], self._fmt)

    def flush(self) -> None:
        self.written.update(run_all(self._waiting))
        self._waiting = {}


def read_silver(spark: SparkSession, input_dir: str, start=None, end=None, fmt: str = "parquet"
                ) -> dict[str, DataFrame]:
    """Prepared telemetry of every component that has rows in the range."""
    frames = {}
    for component in COMPONENTS:
        table = read_table(spark, join_path(input_dir, component), fmt)
        if table is None:
            continue
        rows = between_dates(table, start, end)
        if not rows.isEmpty():
            frames[component] = prepare_telemetry(rows, component)
    return frames


def add_reference_dimensions(spark: SparkSession, config_dir: str, gold: _Gold) -> None:
    topology = read_topology(spark, config_dir)
    gold.add("dim_company", dimensions.dim_company(topology["customers"]), ["company_id"], False)
    gold.add("dim_location", dimensions.dim_location(topology["locations"]), ["location_id"], False)
    gold.add("dim_hvac_machine", dimensions.dim_hvac_machine(topology["hvac_machines"]),
             ["hvac_machine_id"], False)
    gold.add("dim_fault_code", dimensions.dim_fault_code(
        read_fault_codes(spark, join_path(config_dir, FAULT_FILE))), ["fault_code_key"], False)


def silver_to_gold(spark: SparkSession, input_dir: str, output_dir: str, config_dir: str,
                   start=None, end=None, fmt: str = "parquet") -> list[str]:
    """Write all gold tables for the date range; returns their names."""
    with Scratch(spark, "gold") as scratch:
        gold = _Gold(output_dir, scratch, fmt)
        add_reference_dimensions(spark, config_dir, gold)
        gold.flush()
        silver = read_silver(spark, input_dir, start, end, fmt)
        if not silver:
            return list(gold.written)

        states = union_components({c: df.select(*_STATE_COLUMNS) for c, df in silver.items()})

        def store_hours() -> DataFrame:
            spans = scratch.store(health_spans(states))
            mixed = scratch.store(mixed_buckets(spans))
            return scratch.store(health_hours(states, spans=spans, mixed=mixed))

        stored = run_all({
            **{c: partial(scratch.store, facts.component_parts(df, c)) for c, df in silver.items()},
            "hours": store_hours,
            "alerts": partial(scratch.store, facts.alert_parts(states))})
        hours, alert_parts = stored.pop("hours"), stored.pop("alerts")
        parts, compressor = stored, stored.get("compressor")

        described = union_components({
            c: df.select("timestamp", *[x for x in dimensions.COMPONENT_COLUMNS if x in df.columns])
            for c, df in silver.items()})
        gold.add("dim_component", dimensions.dim_component(described), ["component_id"], False)
        gold.add("dim_date", dimensions.dim_date(hours), ["date"], False)
        for grain, keys in facts.GRAIN_KEYS.items():
            of_component, of_machine = [*keys, "component_id"], [*keys, "hvac_machine_id"]
            gold.add(f"fact_component_health_{grain}", facts.health_from_hours(hours, grain),
                     of_component)
            gold.add(f"fact_energy_consumption_{grain}", union_components(
                {c: facts.energy_from_parts(p, grain) for c, p in parts.items()}), of_component)
            gold.add(f"fact_machine_alerts_{grain}", facts.alerts_from_parts(alert_parts, grain),
                     of_machine)
            for component, p in parts.items():
                gold.add(f"fact_{component}_metrics_{grain}", facts.metrics_from_parts(
                    p, facts.METRIC_FAMILIES[component], grain), of_component)
        if compressor is not None:
            gold.add("fact_machine_performance_daily", facts.performance_from_parts(compressor),
                     ["date", "hvac_machine_id"])
        gold.flush()
        _add_kpis(gold, scratch, compressor)
        gold.flush()
        return list(gold.written)


def _add_kpis(gold: _Gold, scratch: Scratch, compressor: DataFrame | None) -> None:
    """KPIs from the facts of this run."""
    def fact(name: str) -> DataFrame | None:
        return gold.written.get(f"fact_{name}_daily")

    machines = scratch.store(kpis.machine_health(fact("component_health")))
    energy, alerts = fact("energy_consumption"), fact("machine_alerts")
    online = (kpis.machines_online(None, machines) if compressor is None
              else kpis.online_from_parts(compressor))
    gold.add(f"{KPI_FOLDER}/kpi_fleet_summary_daily", kpis.fleet_summary(
        machines, online, kpis.fleet_bands(machines), energy, compressor, alerts), ["date"])
    gold.add(f"{KPI_FOLDER}/kpi_location_energy_daily", kpis.location_energy(energy),
             ["date", "location_id"])
    gold.add(f"{KPI_FOLDER}/kpi_location_performance_summary", kpis.location_performance(
        machines, alerts, fact("machine_performance")), ["date", "location_id"])
