import datetime as dt

import pytest
from pyspark.sql import functions as F

from gaugeline.operators import kpis

D1, D2 = dt.date(2025, 1, 1), dt.date(2025, 1, 2)


def machines(spark, scores):
    return spark.createDataFrame([(D1, "l", f"m{i}", s) for i, s in enumerate(scores)],
                                 "date date, location_id string, hvac_machine_id string, "
                                 "machine_health_score double")


def test_band_limits(spark):
    row = kpis.fleet_bands(machines(spark, [100.0, 90.0, 89.999, 70.0, 69.999, 0.0])).first()
    assert (row["healthy_count"], row["warning_count"], row["critical_count"]) == (2, 2, 2)


def test_score_band_labels(spark):
    got = kpis.score_bands(machines(spark, [95.0, 90.0, 89.995, 70.0, 40.0, 39.9, 0.0])).collect()
    assert [r["score_band"] for r in got] == ["healthy", "healthy", "needs_check", "needs_check",
                                              "warning", "critical", "critical"]


def test_machine_score_uses_summed_counts(spark):
    health = spark.createDataFrame([(D1, "l", "m", "a", 90, 0, 0), (D1, "l", "m", "b", 10, 10, 0)],
                                   "date date, location_id string, hvac_machine_id string, "
                                   "component_id string, total_readings bigint, "
                                   "critical_readings bigint, warning_readings bigint")
    assert kpis.machine_health(health).first()["machine_health_score"] == 90.0


def test_machines_online(spark):
    schema = "date date, hvac_machine_id string, run_status double"
    compressor = spark.createDataFrame(
        [(D1, "m1", 0.0), (D1, "m1", 1.0), (D1, "m2", 0.0), (D2, "m2", None)], schema)
    got = {r["date"]: r["machines_online"] for r in kpis.machines_online(compressor, compressor).collect()}
    assert got == {D1: 1}
    without = {r["date"]: r["machines_online"] for r in kpis.machines_online(None, compressor).collect()}
    assert without == {D1: 2, D2: 1}


def energy(spark, rows):
    return spark.createDataFrame(rows, "date date, location_id string, component_type string, "
                                       "daily_energy_kwh double")


def test_energy_pivot_fills_missing_types(spark):
    rows = [(D1, "l1", "compressor", 5.0), (D1, "l1", "compressor", 2.0), (D1, "l2", "evaporator", 1.0)]
    got = {r["location_id"]: r.asDict() for r in kpis.location_energy(energy(spark, rows)).collect()}
    assert got["l1"]["compressor_power_kwh"] == 7.0 and got["l1"]["valve_power_kwh"] == 0.0
    assert got["l2"]["total_power_consumption_kwh"] == got["l2"]["pump_power_kwh"] == 1.0


def summary_inputs(spark):
    presence = spark.createDataFrame([(D1, "l", "m1"), (D1, "l", "m2"), (D2, "l", "m1")],
                                     "date date, location_id string, hvac_machine_id string")
    online = spark.createDataFrame([(D1, 1)], "date date, machines_online bigint")
    bands = kpis.fleet_bands(machines(spark, [100.0, 50.0]))
    alerts = spark.createDataFrame([(D1, "l", 3, 4, 2), (D2, "l", 0, 0, 0)],
                                   "date date, location_id string, total_critical_alerts bigint, "
                                   "total_warning_alerts bigint, unique_fault_codes bigint")
    return presence, online, bands, alerts


def test_day_without_compressors_reads_zero(spark):
    presence, online, bands, alerts = summary_inputs(spark)
    compressor = spark.createDataFrame([(D1, 4.0), (D1, 2.0)], "date date, cop double")
    got = {r["date"]: r for r in kpis.fleet_summary(
        presence, online, bands, energy(spark, [(D1, "l", "compressor", 9.0)]), compressor,
        alerts).collect()}
    assert (got[D1]["total_machines"], got[D1]["machines_online"]) == (2, 1)
    assert (got[D1]["avg_cop"], got[D1]["active_fault_count"]) == (3.0, 7)
    assert (got[D2]["machines_online"], got[D2]["avg_cop"], got[D2]["total_energy_kwh"]) == (0, 0, 0)


def test_no_compressor_data_at_all(spark):
    presence, online, bands, alerts = summary_inputs(spark)
    fleet = kpis.fleet_summary(presence, online, bands, energy(spark, [(D1, "l", "condenser", 1.0)]),
                               None, alerts)
    assert "avg_cop" not in fleet.columns
    place = kpis.location_performance(machines(spark, [80.0]), alerts, None).first()
    assert place["avg_location_cop"] == 0.0


def test_location_performance(spark):
    *_, alerts = summary_inputs(spark)
    performance = spark.createDataFrame([(D1, "l", 2.0), (D1, "l", 4.0)],
                                        "date date, location_id string, avg_cop double")
    row = kpis.location_performance(machines(spark, [80.0, 100.0]), alerts, performance).first()
    assert (row["avg_health_score"], row["machines_count"]) == (90.0, 2)
    assert (row["total_fault_events"], row["avg_location_cop"]) == (2, pytest.approx(3.0))


def test_bands_come_from_the_dictionary(spark, tmp_path):
    import json

    from gaugeline.sources.reference_data import read_score_bands
    path = tmp_path / "codes.json"

    def labels(**floors):
        path.write_text(json.dumps({"codes": {}, "health_score_thresholds": {
            band: {"min": floor, "label": band.title()} for band, floor in floors.items()}}))
        scored = kpis.score_bands_of(machines(spark, [100.0, 90.0, 89.995, 40.0, 3.0]),
                                     read_score_bands(spark, str(path)))
        return [r["score_band"] for r in scored.orderBy(F.desc("machine_health_score")).collect()]

    assert labels(healthy=90, needs_check=70, warning=40, critical=0) == [
        "healthy", "healthy", "needs_check", "warning", "critical"]
    assert labels(good=95, bad=50) == ["good", "bad", "bad", None, None]
    assert labels(odd=None) == [None] * 5 and labels() == [None] * 5
