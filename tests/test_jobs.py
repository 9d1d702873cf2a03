import datetime as dt

import fleet
import pytest
from fleet import table

from gaugeline import COMPONENTS
from gaugeline.plans import gold, ingest, ledger, silver
from gaugeline.sources.tables import read_table
from gaugeline.streaming.ingest import stream_raw_to_bronze

NOW = fleet.NOW_MS
D1, D2 = fleet.DAYS


def snapshot(spark, paths, layer, names):
    return {n: sorted(map(str, (r.asDict() for r in table(spark, paths, layer, n).collect())))
            for n in names}


def test_layers_hold_every_reading(spark, lake):
    paths, counters = lake
    for layer in ("bronze", "staging"):
        assert {c: table(spark, paths, layer, c).count() for c in COMPONENTS} == {
            "compressor": 96, "condenser": 48, "evaporator": 48, "expansion_valve": 48}
    assert counters[0]["condenser"] == {"total_records": 24, "valid_records": 22,
                                        "invalid_records": 2}
    assert counters[1]["compressor"]["invalid_records"] == 0
    assert table(spark, paths, "silver", "condenser").count() == 44
    assert table(spark, paths, "silver", "dlq/compressor") is None


def test_bronze_prefers_envelope_and_carries_own_columns(spark, lake):
    bronze = table(spark, lake[0], "bronze", "compressor")
    assert {r[0] for r in bronze.select("circuitId").distinct().collect()} == {"A", "B"}
    assert "fanSpeedRpm" not in bronze.columns and "batchId" in bronze.columns
    staging = table(spark, lake[0], "staging", "compressor")
    assert dict(staging.dtypes)["date"] == "date" and "hvac_machine_id" in staging.columns


def test_dead_letters_tell_why(spark, lake):
    rows = table(spark, lake[0], "silver", "dlq/condenser").collect()
    assert sorted({r["failure_reason"] for r in rows}) == [
        "Bad data_quality", "Out of range: fan_speed_rpm | Invalid health_status"]
    assert all(r["quarantine_timestamp"] is not None and not r["is_valid"] for r in rows)


def test_gold_tables_are_complete(spark, lake):
    names = {"dim_company": 1, "dim_location": 1, "dim_hvac_machine": 2, "dim_fault_code": 2,
             "dim_component": 10, "dim_date": 2, "fact_component_health_daily": 20,
             "fact_component_health_hourly": 20, "fact_energy_consumption_daily": 20,
             "fact_energy_consumption_hourly": 20, "fact_machine_alerts_daily": 4,
             "fact_machine_alerts_hourly": 4, "fact_machine_performance_daily": 4,
             "KPI_Rollups/kpi_fleet_summary_daily": 2, "KPI_Rollups/kpi_location_energy_daily": 2,
             "KPI_Rollups/kpi_location_performance_summary": 2}
    for component, n in (("compressor", 8), ("condenser", 4), ("evaporator", 4),
                         ("expansion_valve", 4)):
        names[f"fact_{component}_metrics_daily"] = names[f"fact_{component}_metrics_hourly"] = n
    assert {n: table(spark, lake[0], "gold", n).count() for n in names} == names


def test_gold_values(spark, lake):
    paths = lake[0]
    health = table(spark, paths, "gold", "fact_component_health_daily").filter(
        "component_id = 'COMP-0101A'").orderBy("date").first()
    assert (health["critical_event_count"], health["critical_readings"],
            health["warning_readings"], health["critical_reading_code"]) == (2, 2, 1, 315)
    assert health["health_score_pct"] == pytest.approx(100 - 200 / 12 - 50 / 12)
    energy = table(spark, paths, "gold", "fact_energy_consumption_daily").filter(
        "component_id = 'EXPA-0101A'").first()
    assert energy["daily_energy_kwh"] == pytest.approx(0.012 * 55 / 60)
    performance = table(spark, paths, "gold", "fact_machine_performance_daily").first()
    assert (performance["max_run_hours"], performance["max_start_stops"]) == (11.0, 1.0)
    fleet_row = table(spark, paths, "gold", "KPI_Rollups/kpi_fleet_summary_daily").first()
    assert (fleet_row["total_machines"], fleet_row["machines_online"]) == (2, 2)
    assert (fleet_row["active_fault_count"], fleet_row["avg_cop"]) == (3, 4.0)
    place = table(spark, paths, "gold", "KPI_Rollups/kpi_location_energy_daily").first()
    assert place["total_power_consumption_kwh"] == pytest.approx(sum(
        place[c] for c in ("compressor_power_kwh", "condenser_fan_power_kwh", "pump_power_kwh",
                           "valve_power_kwh")))
    assert place["compressor_power_kwh"] == pytest.approx(4 * 60 * 55 / 60)
    codes = {r["fault_code_key"]: r for r in table(spark, paths, "gold", "dim_fault_code").collect()}
    assert codes[315]["severity"] == "" and codes[288]["fault_description"] == "Hot"


def test_reruns_change_nothing(spark, lake):
    paths = lake[0]
    silver_names = [*COMPONENTS, "dlq/condenser"]
    gold_names = ["fact_component_health_daily", "fact_energy_consumption_hourly", "dim_component",
                  "dim_date", "fact_machine_alerts_daily", "KPI_Rollups/kpi_fleet_summary_daily",
                  "KPI_Rollups/kpi_location_performance_summary"]
    before = snapshot(spark, paths, "silver", silver_names), snapshot(spark, paths, "gold", gold_names)
    ingest.raw_to_bronze(spark, paths["raw"], paths["bronze"])
    ingest.bronze_to_staging(spark, paths["bronze"], paths["staging"])
    silver.staging_to_silver(spark, paths["staging"], paths["silver"], now_ms=NOW)
    gold.silver_to_gold(spark, paths["silver"], paths["gold"], paths["config"])
    after = snapshot(spark, paths, "silver", silver_names), snapshot(spark, paths, "gold", gold_names)
    assert before == after


def test_missing_layers_are_skipped(spark, tmp_path, lake):
    empty, out = str(tmp_path / "none"), str(tmp_path / "out")
    assert ingest.raw_to_bronze(spark, empty, out) == []
    assert ingest.bronze_to_staging(spark, empty, out) == []
    assert silver.staging_to_silver(spark, empty, out) == {}
    # Reference dimensions are written even when there is no telemetry.
    assert gold.silver_to_gold(spark, empty, out, lake[0]["config"]) == [
        "dim_company", "dim_location", "dim_hvac_machine", "dim_fault_code"]
    # A range without data is skipped as well.
    assert silver.staging_to_silver(spark, lake[0]["staging"], out, "2030-01-01") == {}
    with pytest.raises(FileNotFoundError):
        gold.silver_to_gold(spark, empty, out, empty)


def test_fleet_without_compressors(spark, tmp_path, lake):
    fleet.write(tmp_path / "raw", {D1: [fleet.document("condenser", fleet.MACHINES[0], D1)]})
    paths = {k: str(tmp_path / k) for k in ("raw", "bronze", "staging", "silver", "gold")}
    assert ingest.raw_to_bronze(spark, paths["raw"], paths["bronze"]) == ["condenser"]
    ingest.bronze_to_staging(spark, paths["bronze"], paths["staging"])
    silver.staging_to_silver(spark, paths["staging"], paths["silver"], now_ms=NOW)
    tables = gold.silver_to_gold(spark, paths["silver"], paths["gold"], lake[0]["config"])
    assert "fact_machine_performance_daily" not in tables
    row = table(spark, paths, "gold", "KPI_Rollups/kpi_fleet_summary_daily").first().asDict()
    assert row["machines_online"] == 1 and "avg_cop" not in row
    assert table(spark, paths, "gold", "KPI_Rollups/kpi_location_performance_summary").first()[
        "avg_location_cop"] == 0.0


def test_stream_equals_batch(spark, tmp_path, lake):
    out = str(tmp_path / "bronze")
    for _ in range(2):  # the second start finds nothing new
        query = stream_raw_to_bronze(spark, lake[0]["raw"], out, str(tmp_path / "cp"), max_files=8)
        query.awaitTermination()
    for component in COMPONENTS:
        streamed = table(spark, {"bronze": out}, "bronze", component)
        batch = table(spark, lake[0], "bronze", component)
        assert sorted(r[0] for r in streamed.select("eventId").collect()) == sorted(
            r[0] for r in batch.select("eventId").collect())
        assert set(streamed.columns) == set(batch.columns)


def test_ledger_job(spark, tmp_path, lake):
    raw, where = lake[0]["raw"], str(tmp_path / "ledger")
    # No ledger: rebuilt from the raw folders, with a note.
    window = ledger.plan_window(spark, where, raw, days=3)
    assert (window.decision, window.start, window.end) == ("proceed", dt.date(2025, 3, 3),
                                                           dt.date(2025, 3, 5))
    runs = read_table(spark, f"{where}/runs").collect()
    assert [(r["start"], r["end"], r["days"]) for r in runs] == [(D1, D2, 2)] and runs[0]["note"]
    assert ledger.plan_window(spark, where, raw, 2, D1).decision == "skip"
    assert ledger.plan_window(spark, where, raw, 3, D1).decision == "partial"
    assert ledger.plan_window(spark, where, raw, 3, dt.date(2026, 1, 1)).decision == "proceed"
    ledger.record_run(spark, where, dt.date(2025, 3, 5), 2)
    ledger.record_run(spark, where, dt.date(2025, 3, 5), 2)
    assert read_table(spark, f"{where}/dates").count() == 4
    assert read_table(spark, f"{where}/runs").count() == 3
    assert ledger.plan_window(spark, where, raw).start == dt.date(2025, 3, 7)


def test_ledger_without_any_data(spark, tmp_path):
    window = ledger.plan_window(spark, str(tmp_path / "l"), str(tmp_path / "raw"), 2,
                                today=dt.date(2025, 5, 5))
    assert (window.start, window.end) == (dt.date(2025, 5, 5), dt.date(2025, 5, 6))


def test_raw_texts_are_dealt_out_before_they_are_parsed(spark, tmp_path, monkeypatch):
    """However few splits the table has, its JSON is parsed by all tasks; equal rows stay as many."""
    from harness import storage_queries as sq
    rows = [(k, f"2024-01-{1 + k % 28:02d} 00:00:00", k % 4, "view", k / 4) for k in (*range(20), 4, 4)]
    spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double") \
        .selectExpr("event_id", "CAST(ts AS TIMESTAMP) AS ts", "user_id", "event_type", "value") \
        .coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    seen = []
    parse = sq.documents.parse_documents
    monkeypatch.setattr(sq.documents, "parse_documents", lambda texts: seen.append(texts) or parse(texts))
    dead = sq.raw_texts_dead(spark, str(tmp_path)).collect()
    assert "RepartitionByExpression" in seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r["path"] for r in dead) == ["f-0", "f-10", "f-14", "f-4", "f-4", "f-4"]
