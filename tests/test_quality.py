import random

import pytest
from pyspark.sql import functions as F

from gaugeline.operators import dedup, quality
from gaugeline.operators.rules import RULES, RuleSet

NOW = 1_700_000_000_000
YEAR = 365 * 86_400_000
SCHEMA = ("event_id string, timestamp bigint, component_id string, hvac_machine_id string, "
          "location_id string, health_status string, data_quality string, "
          "suction_pressure_kpa string, discharge_pressure_kpa string, power_factor string")


def reading(**changes):
    row = {"event_id": "e1", "timestamp": NOW, "component_id": "c", "hvac_machine_id": "m",
           "location_id": "l", "health_status": "Healthy", "data_quality": "GOOD",
           "suction_pressure_kpa": "200", "discharge_pressure_kpa": "1000", "power_factor": "0.9"}
    row.update(changes)
    return tuple(row.values())


def reasons(spark, rows, rules=RULES["compressor"]):
    df = quality.apply_quality_rules(spark.createDataFrame(rows, SCHEMA), rules, NOW)
    return sorted((r["event_id"] or "", r["failure_reason"], r["is_valid"]) for r in df.collect())


@pytest.mark.parametrize("changes, reason", [
    ({}, ""),
    ({"data_quality": "STALE"}, "Bad data_quality"),
    ({"data_quality": "PARTIAL"}, ""),
    ({"data_quality": None}, ""),
    ({"location_id": None}, "Null mandatory field: location_id"),
    ({"component_id": ""}, "Null mandatory field: component_id"),
    ({"timestamp": None}, "Null mandatory field: timestamp | Invalid timestamp"),
    ({"timestamp": 0}, "Invalid timestamp"),
    ({"timestamp": -1}, "Invalid timestamp"),
    ({"timestamp": NOW + YEAR}, ""),
    ({"timestamp": NOW + YEAR + 1}, "Future timestamp"),
    ({"suction_pressure_kpa": "100"}, ""),
    ({"suction_pressure_kpa": "800"}, ""),
    ({"suction_pressure_kpa": "99.999"}, "Out of range: suction_pressure_kpa"),
    ({"suction_pressure_kpa": "800.001"}, "Out of range: suction_pressure_kpa"),
    ({"suction_pressure_kpa": None}, ""),
    ({"suction_pressure_kpa": ""}, ""),
    ({"suction_pressure_kpa": "abc"}, ""),
    ({"power_factor": "NaN"}, "Out of range: power_factor"),
    # The buffer is leniency: equal fails, a little more passes.
    ({"discharge_pressure_kpa": "600", "suction_pressure_kpa": "650"},
     "Cross field error: discharge_pressure_kpa > suction_pressure_kpa"),
    ({"discharge_pressure_kpa": "600.001", "suction_pressure_kpa": "650"}, ""),
    ({"discharge_pressure_kpa": None, "suction_pressure_kpa": "650"}, ""),
    ({"health_status": "ok"}, "Invalid health_status"),
    ({"health_status": None}, "Null mandatory field: health_status"),
    ({"data_quality": "STALE", "location_id": "", "suction_pressure_kpa": "1", "health_status": "x"},
     "Bad data_quality | Null mandatory field: location_id | Out of range: suction_pressure_kpa"
     " | Invalid health_status"),
])
def test_rules(spark, changes, reason):
    assert reasons(spark, [reading(**changes)]) == [("e1", reason, reason == "")]


def test_duplicates_keep_the_latest(spark):
    rows = [reading(), reading(timestamp=NOW + 1), reading(event_id="e2"),
            reading(event_id="e2"), reading(event_id="e3")]
    assert reasons(spark, rows) == [
        ("e1", "", True), ("e1", "Duplicate event_id", False), ("e2", "", True),
        ("e2", "Duplicate event_id", False), ("e3", "", True)]


def test_null_ids_count_as_one_key(spark):
    rows = [reading(event_id=None), reading(event_id=None, timestamp=NOW - 1)]
    assert [r[1] for r in reasons(spark, rows)] == [
        "Duplicate event_id | Null mandatory field: event_id", "Null mandatory field: event_id"]


def test_rules_on_absent_columns_are_skipped(spark):
    df = spark.createDataFrame([("e1", 1)], "event_id string, timestamp bigint")
    row = quality.apply_quality_rules(df, RULES["condenser"], NOW).first()
    assert row["is_valid"] and row["failure_reason"] == ""
    assert quality.apply_quality_rules(df, RuleSet(), NOW).first()["is_valid"]


def test_split_and_counts(spark):
    rows = [reading(event_id=f"e{i}", data_quality="BAD" if i % 3 == 0 else "GOOD")
            for i in range(10)]
    checked = quality.apply_quality_rules(spark.createDataFrame(rows, SCHEMA),
                                          RULES["compressor"], NOW)
    valid, invalid = quality.split_valid(checked)
    assert "is_valid" not in valid.columns and "failure_reason" in invalid.columns
    assert tuple(quality.gate_counts(checked).first()) == (10, 6, 4)
    assert (valid.count(), invalid.count()) == (6, 4)
    assert "quarantine_timestamp" in quality.quarantine(invalid).columns


def test_hot_key_spread_over_partitions(spark):
    """A third of all rows under one id, many of them identical, against plain counting."""
    rng = random.Random(7)
    rows = [(f"e{i}", rng.randrange(5), "a") for i in range(2000)]
    rows += [("hot", rng.randrange(50), rng.choice("ab")) for _ in range(1000)]
    rows += [(None, 3, "a")] * 50
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "event_id string, timestamp bigint, note string").repartition(16)
    got = dedup.flag_duplicates(df)
    kept = got.filter(~F.col("is_duplicate"))
    assert got.count() == len(rows)
    assert kept.count() == 2000 + 2
    assert kept.filter("event_id = 'hot'").first()["timestamp"] == max(
        r[1] for r in rows if r[0] == "hot")
    # The same answer whatever the input partitioning.
    again = dedup.flag_duplicates(df.repartition(3)).filter(~F.col("is_duplicate"))
    assert sorted(map(str, again.collect())) == sorted(map(str, kept.collect()))


@pytest.mark.parametrize("hot", ["hot", None])
def test_hot_key_never_meets_in_one_task(spark, hot):
    """With broadcasts off, no task holds more of an id than a few input partitions do."""
    rows = [(f"e{i}", i) for i in range(2000)] + [(hot, i) for i in range(1600)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame(rows, "event_id string, timestamp bigint").repartition(16)
        flagged = dedup.flag_duplicates(df).filter(F.col("event_id").eqNullSafe(F.lit(hot)))
        plan = flagged._jdf.queryExecution().sparkPlan().toString()
        assert "Join" not in plan
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        held = [r["count"] for r in flagged.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(held) == 1600 and max(held) <= 800


def test_latest_attributes_per_key(spark):
    rows = [("c1", "m1", 1), ("c1", "m2", 5), ("c1", "m1", 3), ("c2", None, 1)]
    df = spark.createDataFrame(rows, "component_id string, hvac_machine_id string, timestamp int")
    got = dedup.latest_per_key(df, ["component_id"], ["component_id", "hvac_machine_id"])
    assert sorted(map(tuple, got.collect())) == [("c1", "m2"), ("c2", None)]
