import datetime as dt

import pytest

from gaugeline.operators import facts
from gaugeline.operators.reshape import prepare_telemetry, with_component_hour, with_event_date

DAY = 1735689600000  # 2025-01-01T00:00Z


def frame(spark, rows, columns):
    df = spark.createDataFrame(
        [(r[0], DAY + r[1] * 60_000, "m1", "l1", "compressor", *r[2:]) for r in rows],
        "component_id string, timestamp bigint, hvac_machine_id string, location_id string, "
        "component_type string, " + columns)
    return with_component_hour(with_event_date(df))


def test_single_reading_stands_for_five_minutes(spark):
    row = facts.energy_consumption(frame(spark, [("c", 0, 12.0)], "power_consumption_kw double")).first()
    assert row["duration_hours"] == 5 / 60 and row["daily_energy_kwh"] == 1.0


def test_energy_spans_first_to_last_powered_reading(spark):
    rows = [("c", 0, None), ("c", 5, 10.0), ("c", 60, 20.0), ("c", 90, None), ("d", 0, None)]
    got = facts.energy_consumption(frame(spark, rows, "power_consumption_kw double")).collect()
    assert len(got) == 1  # no power, no row
    row = got[0]
    assert (row["total_readings"], row["avg_power_kw"]) == (2, 15.0)
    assert row["duration_hours"] == pytest.approx(55 / 60)
    assert row["daily_energy_kwh"] == pytest.approx(15 * 55 / 60)


def test_daily_energy_is_not_the_sum_of_hours(spark):
    rows = [("c", m, 60.0) for m in range(0, 120, 5)]
    df = frame(spark, rows, "power_consumption_kw double")
    daily = facts.energy_consumption(df).first()["daily_energy_kwh"]
    hourly = sum(r["hourly_energy_kwh"] for r in facts.energy_consumption(df, "hourly").collect())
    assert daily == pytest.approx(115.0) and hourly == pytest.approx(110.0)


def test_distinct_codes(spark):
    codes = [None, 0.0, -1.0, float("nan"), 288.0, 288.0, 301.0]
    rows = [("c", i * 20, c, "Critical") for i, c in enumerate(codes)]
    df = frame(spark, rows, "health_active_fault_code double, health_status string")
    row = facts.machine_alerts(df).first()
    assert (row["unique_fault_codes"], row["total_critical_alerts"]) == (2, 7)
    hourly = facts.machine_alerts(df, "hourly").orderBy("hour").collect()
    assert [r["unique_fault_codes"] for r in hourly] == [0, 1, 1]


def test_performance_is_max_growth_and_mean_of_means(spark):
    rows = [("c1", 0, 10.0, 1.0, 2.0, 5.0), ("c1", 5, 14.0, 2.0, 4.0, None),
            ("c2", 0, 100.0, 7.0, 9.0, None), ("c2", 5, 101.0, 9.0, None, None)]
    df = frame(spark, rows, "run_hours double, start_stop_count double, cop double, eer double")
    row = facts.machine_performance_daily(df).first()
    assert (row["max_run_hours"], row["max_start_stops"]) == (4.0, 2.0)
    assert (row["avg_cop"], row["avg_eer"]) == ((3.0 + 9.0) / 2, 5.0)


def test_metric_rollup_uses_present_metrics_only(spark):
    df = frame(spark, [("c", 0, 1.0), ("c", 5, 3.0), ("c", 65, None)], "vibration_mm_s double")
    metrics = facts.METRIC_FAMILIES["compressor"]
    daily = facts.metric_rollup(df, metrics)
    assert [c for c in daily.columns if c.startswith(("avg_", "max_"))] == [
        "avg_vibration_mm_s", "max_vibration_mm_s"]
    assert (daily.first()["avg_vibration_mm_s"], daily.first()["max_vibration_mm_s"]) == (2.0, 3.0)
    hourly = facts.metric_rollup(df, metrics, "hourly").orderBy("hour").collect()
    assert [r["avg_vibration_mm_s"] for r in hourly] == [2.0, None]
    assert facts.metric_rollup(df.drop("vibration_mm_s"), metrics) is None


def test_facts_from_stored_parts_equal_facts_from_readings(spark):
    rows = [(f"c{i % 3}", i * 7, str(i % 5), str(i), str(i // 4), str(1 + i % 4), str(2 + i % 3),
             i % 2, str(i % 9)) for i in range(200)]
    df = frame(spark, rows, "power_consumption_kw string, run_hours string, start_stop_count string,"
                            " cop string, eer string, run_status bigint, vibration_mm_s string")
    df = prepare_telemetry(df, "compressor")
    parts = facts.component_parts(df, "compressor")

    def rowset(frame_):
        return sorted(map(str, (r.asDict() for r in frame_.select(*sorted(frame_.columns)).collect())))

    metrics = facts.METRIC_FAMILIES["compressor"]
    for grain in ("daily", "hourly"):
        assert rowset(facts.energy_from_parts(parts, grain)) == rowset(facts.energy_consumption(df, grain))
        assert rowset(facts.metrics_from_parts(parts, metrics, grain)) == rowset(
            facts.metric_rollup(df, metrics, grain))
    assert rowset(facts.performance_from_parts(parts)) == rowset(facts.machine_performance_daily(df))


def test_scan_reads_only_needed_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [("c", i, 1.0, "x" * 50) for i in range(10)]
    frame(spark, rows, "power_consumption_kw double, note string").write.parquet(path)
    plan = facts.energy_consumption(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    schema = plan[plan.index("ReadSchema"):]
    assert "note" not in schema
    assert "PushedFilters: [IsNotNull(power_consumption_kw)]" in plan
    # Merging the parts at the same keys needs no second exchange.
    assert plan.count("Exchange hashpartitioning") == 1


def test_dates_follow_utc(spark):
    df = frame(spark, [("c", -1, 1.0), ("c", 1, 1.0)], "power_consumption_kw double")
    got = sorted(r["date"] for r in facts.energy_consumption(df).collect())
    assert got == [dt.date(2024, 12, 31), dt.date(2025, 1, 1)]
