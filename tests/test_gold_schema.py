"""Columns of the gold tables against the documented data model.

Deviations the model's own code makes are kept: dates are DATE, the energy facts also carry
duration_hours, every metric family has max_ columns, and dim_component describes the component.
"""

from fleet import table

HEAD = {"daily": ["date", "location_id", "hvac_machine_id"],
        "hourly": ["date", "hour", "location_id", "hvac_machine_id"]}
METRICS = {
    "compressor": ["vibration_mm_s", "suction_temperature_c", "discharge_temperature_c",
                   "suction_pressure_kpa", "discharge_pressure_kpa"],
    "condenser": ["water_inlet_temperature_c", "water_outlet_temperature_c", "fan_speed_rpm",
                  "heat_rejection_efficiency_pct", "approach_temperature_c"],
    "evaporator": ["cooling_capacity_tr", "entering_chilled_water_temperature_c",
                   "leaving_chilled_water_temperature_c", "heat_transfer_efficiency_pct"],
    "expansion_valve": ["valve_opening_pct", "superheat_c", "subcooling_c",
                        "refrigerant_flow_rate_kg_min"],
}
TABLES = {
    "dim_company": ["company_id", "company_name", "industry", "account_type"],
    "dim_location": ["location_id", "company_id", "location_name", "city", "state", "country"],
    "dim_hvac_machine": ["hvac_machine_id", "location_id", "manufacturer", "model"],
    "dim_fault_code": ["fault_code_key", "fault_code", "component_type", "fault_description",
                       "threshold_description", "severity", "recommended_action", "is_active"],
    "dim_component": ["component_id", "hvac_machine_id", "component_type", "component_manufacturer",
                      "component_model", "component_serial_number", "component_installation_date"],
    "dim_date": ["date", "year", "quarter", "month", "day", "day_of_week", "is_weekend"],
    "fact_machine_performance_daily": [*HEAD["daily"], "max_run_hours", "max_start_stops",
                                       "avg_cop", "avg_eer"],
    "KPI_Rollups/kpi_fleet_summary_daily": [
        "date", "total_locations", "total_machines", "machines_online", "healthy_count",
        "warning_count", "critical_count", "avg_health_score", "total_energy_kwh", "avg_cop",
        "active_fault_count"],
    "KPI_Rollups/kpi_location_energy_daily": [
        "date", "location_id", "total_power_consumption_kwh", "compressor_power_kwh",
        "condenser_fan_power_kwh", "pump_power_kwh", "valve_power_kwh"],
    "KPI_Rollups/kpi_location_performance_summary": [
        "date", "location_id", "avg_health_score", "machines_count", "total_fault_events",
        "avg_location_cop"],
}
for _grain, _head in HEAD.items():
    _events = ["critical_event_count"] if _grain == "daily" else []
    TABLES[f"fact_component_health_{_grain}"] = [
        *_head, "component_id", "component_type", "total_readings", "critical_readings",
        "warning_readings", "critical_reading_code", *_events, "health_score_pct"]
    TABLES[f"fact_energy_consumption_{_grain}"] = [
        *_head, "component_id", "component_type", "avg_power_kw", "max_power_kw", "min_power_kw",
        "total_readings", "duration_hours",
        "daily_energy_kwh" if _grain == "daily" else "hourly_energy_kwh"]
    TABLES[f"fact_machine_alerts_{_grain}"] = [
        *_head, "total_critical_alerts", "total_warning_alerts", "unique_fault_codes"]
    for _component, _metrics in METRICS.items():
        TABLES[f"fact_{_component}_metrics_{_grain}"] = [
            *_head, "component_id", *[f"{f}_{m}" for m in _metrics for f in ("avg", "max")]]

COUNTS = ("total_readings", "critical_readings", "warning_readings", "critical_event_count",
          "total_critical_alerts", "unique_fault_codes", "total_machines", "healthy_count",
          "active_fault_count", "machines_count", "total_fault_events", "fault_code_key")


def test_columns_and_types(spark, lake):
    for name, columns in TABLES.items():
        types = dict(table(spark, lake[0], "gold", name).dtypes)
        assert sorted(types) == sorted(columns), name
        for column, dtype in types.items():
            if column in COUNTS:
                assert dtype == "bigint", (name, column, dtype)
            if column.startswith(("avg_", "max_", "min_")) or column.endswith(("_kwh", "_pct", "_hours")):
                assert dtype == "double", (name, column, dtype)


def test_relations_between_tables(spark, lake):
    health = table(spark, lake[0], "gold", "fact_component_health_daily").collect()
    assert all(0 <= r["health_score_pct"] <= 100 for r in health)
    alerts = table(spark, lake[0], "gold", "fact_machine_alerts_daily").collect()
    fleet = table(spark, lake[0], "gold", "KPI_Rollups/kpi_fleet_summary_daily").collect()
    assert sum(r["critical_readings"] for r in health) == sum(r["total_critical_alerts"] for r in alerts)
    assert sum(r["active_fault_count"] for r in fleet) == sum(
        r["critical_readings"] + r["warning_readings"] for r in health)
    hourly = table(spark, lake[0], "gold", "fact_component_health_hourly").collect()
    assert sum(r["total_readings"] for r in hourly) == sum(r["total_readings"] for r in health)
    for r in fleet:
        assert r["healthy_count"] + r["warning_count"] + r["critical_count"] == r["total_machines"]
