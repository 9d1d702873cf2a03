import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gaugeline.operators import facts, transitions
from gaugeline.operators.reshape import with_component_hour, with_event_date

HOUR = 3_600_000
SCHEMA = ("event_id string, timestamp bigint, component_id string, hvac_machine_id string, "
          "location_id string, component_type string, health_status string, "
          "health_active_fault_code double")


def telemetry(spark, rows):
    """rows: (component, timestamp, status[, code])."""
    full = [(f"e{i:06d}", r[1], r[0], "m", "l", "compressor", r[2], r[3] if len(r) > 3 else None)
            for i, r in enumerate(rows)]
    return with_component_hour(with_event_date(spark.createDataFrame(full, SCHEMA)))


def expected_onsets(rows):
    """Plain re-statement: walk each component in time, healthy before faulty within an instant."""
    onsets = Counter()
    by_component = defaultdict(list)
    for r in rows:
        by_component[r[0]].append((r[1], r[2] in ("Critical", "Warning")))
    for component, states in by_component.items():
        before = False
        for ts, faulty in sorted(states):
            if faulty and not before:
                onsets[component, ts] += 1
            before = faulty
    return onsets


def check(spark, rows):
    df = telemetry(spark, rows)
    want = expected_onsets(rows)
    flagged = transitions.with_new_event(df).filter("is_new_event = 1").collect()
    assert Counter((r["component_id"], r["timestamp"]) for r in flagged) == want
    hours = transitions.health_hours(df).collect()
    assert sorted(map(str, transitions.health_hours_in_one_scan(df).collect())) == sorted(map(str, hours))
    got = Counter()
    for r in hours:
        got[r["component_id"], str(r["date"]), r["hour"]] += r["critical_event_count"]
    per_hour = Counter()
    for (component, ts), n in want.items():
        day = str(dt.datetime.fromtimestamp(ts / 1000, dt.timezone.utc).date())
        per_hour[component, day, ts // HOUR % 24] += n
    assert +got == per_hour
    assert sum(r["total_readings"] for r in hours) == len(rows)


def test_warning_to_critical_is_one_event(spark):
    states = ["Healthy", "Warning", "Critical", "Healthy", "Critical"]
    rows = [("c", i * 300_000, s) for i, s in enumerate(states)]
    check(spark, rows)
    row = facts.component_health(telemetry(spark, rows)).first()
    assert (row["critical_event_count"], row["critical_readings"], row["warning_readings"]) == (2, 2, 1)


def test_fault_across_hours_and_midnight_counts_once(spark):
    rows = [("c", h * HOUR, "Critical" if h >= 20 else "Healthy") for h in range(30)]
    check(spark, rows)
    daily = facts.component_health(telemetry(spark, rows)).orderBy("date").collect()
    assert [r["critical_event_count"] for r in daily] == [1, 0]


def test_fault_running_at_range_start_counts(spark):
    check(spark, [("c", 5 * HOUR + i, "Warning") for i in range(3)])


def test_gap_of_days_carries_the_last_state(spark):
    check(spark, [("c", 0, "Critical"), ("c", 100 * HOUR, "Critical"), ("c", 101 * HOUR, "Healthy"),
                  ("c", 300 * HOUR, "Warning")])


def test_unknown_status_is_not_faulty(spark):
    check(spark, [("c", 1, None), ("c", 2, "Critical"), ("c", 3, None), ("c", 4, "Warning")])


@pytest.mark.parametrize("seed", range(4))
def test_random_with_ties_and_one_dominant_component(spark, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(1500):
        component = "hot" if rng.random() < 0.4 else f"c{rng.randrange(20)}"
        # Few distinct instants: many ties; a third of the hot rows share a single hour.
        ts = (7 * HOUR + rng.randrange(40) if component == "hot" and rng.random() < 0.3
              else rng.randrange(60) * (HOUR // 2))
        rows.append((component, ts, rng.choice(["Healthy", "Healthy", "Warning", "Critical"])))
    check(spark, rows)


def test_only_mixed_hours_are_put_in_order(spark):
    """Steady hours and single changes of state are settled by aggregates."""
    steady = [("a", i, "Critical") for i in range(5)] + [("b", i, "Healthy") for i in range(5)]
    change = [("c", i, "Healthy" if i < 3 else "Warning") for i in range(6)]
    recover = [("d", i, "Critical" if i < 3 else "Healthy") for i in range(6)]
    mixed = [("e", 1, "Healthy"), ("e", 2, "Critical"), ("e", 3, "Healthy")]
    same_instant = [("f", 1, "Healthy"), ("f", 2, "Healthy"), ("f", 2, "Critical")]
    rows = steady + change + recover + mixed + same_instant
    spans = transitions.health_spans(telemetry(spark, rows))
    assert sorted(r["_of"] for r in transitions.mixed_buckets(spans).collect()) == ["e", "f"]
    check(spark, rows)
    # The state carried into the next hour comes from either kind of hour.
    check(spark, rows + [(c, HOUR + i, "Critical") for c in "abcdef" for i in range(2)])


def test_component_that_changes_machine_within_an_hour(spark):
    rows = [("c", i, "Healthy" if i % 4 == 0 else "Critical") for i in range(20)]
    df = telemetry(spark, rows).withColumn(
        "hvac_machine_id", F.when(F.col("timestamp") < 9, "m1").otherwise("m2"))
    got = {r["hvac_machine_id"]: r["critical_event_count"]
           for r in facts.component_health(df).collect()}
    assert got == {"m1": 2, "m2": 3}


def test_stored_mixed_hours_keep_readings_in_place(spark, scratch, tmp_path):
    path = str(tmp_path / "readings")
    rows = [("c", i * 300_000, "Healthy" if i % 5 else "Critical") for i in range(50)]
    telemetry(spark, rows).write.parquet(path)
    df = spark.read.parquet(path)
    spans = scratch.store(transitions.health_spans(df))
    stored = scratch.store(transitions.mixed_buckets(spans))
    hours = transitions.health_hours(df, spans=spans, mixed=stored)
    plan = hours._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert sorted(map(str, hours.collect())) == sorted(map(str, transitions.health_hours(df).collect()))


def test_no_window_spans_the_readings_of_a_component(spark):
    plan = transitions.health_hours(telemetry(spark, [("c", 1, "Healthy")]))
    lines = plan._jdf.queryExecution().optimizedPlan().toString().splitlines()
    windows = [line.split("Window ", 1)[1] for line in lines if "Window [" in line]
    over_component = [w for w in windows if "last(_closing" in w]
    assert len(over_component) == 1 and len(windows) > 1
    assert all("_bucket" in w for w in windows)
    below = next(i for i, line in enumerate(lines) if "last(_closing" in line)
    assert "Union" in lines[below + 1]  # of two frames with one row per component and hour


def test_fault_codes(spark):
    rows = [("c", 1, "Critical", 288.0), ("c", 2, "Critical", 301.0), ("c", 3, "Healthy", None),
            ("c", 4, "Healthy", float("nan"))]
    row = facts.component_health(telemetry(spark, rows), "hourly").first()
    assert row["critical_reading_code"] == 301
    assert "critical_event_count" not in row.asDict()
    quiet = facts.component_health(telemetry(spark, [("c", 1, "Healthy")])).first()
    assert (quiet["critical_reading_code"], quiet["health_score_pct"]) == (0, 100.0)


def test_health_in_one_scan(spark, tmp_path):
    path = str(tmp_path / "readings")
    telemetry(spark, [("c", i * 300_000, "Healthy" if i % 5 else "Critical") for i in range(50)]
              ).write.parquet(path)
    plan = facts.component_health(spark.read.parquet(path))._jdf.queryExecution().executedPlan()
    assert plan.toString().count("FileScan") == 1
