import datetime as dt

import pytest
from pyspark.sql import functions as F

from gaugeline.functions import date_of, epoch_millis, health_score, hour_of, snake_case
from gaugeline.operators import reshape


@pytest.mark.parametrize("name, expected", [
    ("suctionPressureKpa", "suction_pressure_kpa"), ("pumpRelay1Status", "pump_relay1_status"),
    ("vibrationMmS", "vibration_mm_s"), ("hvacMachineId", "hvac_machine_id"), ("cop", "cop"),
    ("already_snake", "already_snake"), ("eventId", "event_id"), ("HTTPServer", "http_server"),
])
def test_snake_case(name, expected):
    assert snake_case(name) == expected


def test_dates_and_hours_are_utc_in_any_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    rows = [(1735689599999,), (1735689600000,), (-1,), (None,), (2 ** 62,)]
    got = (spark.createDataFrame(rows, "t bigint")
           .select(date_of(F.col("t")), hour_of(F.col("t"))).collect())
    assert tuple(got[0]) == (dt.date(2024, 12, 31), 23)
    assert tuple(got[1]) == (dt.date(2025, 1, 1), 0)
    assert tuple(got[2]) == (dt.date(1969, 12, 31), 23)
    assert tuple(got[3]) == (None, None)
    assert got[4][0] is None


def test_epoch_millis_takes_text_and_numbers(spark):
    rows = [("1735689600000",), ("1735689600000.7",), ("1.7356896E12",), ("soon",), (None,)]
    got = spark.createDataFrame(rows, "t string").select(epoch_millis(F.col("t"))).collect()
    assert [r[0] for r in got] == [1735689600000] * 3 + [None, None]


def test_health_score(spark):
    rows = [(4, 0, 0), (4, 1, 1), (2, 2, 2), (0, 0, 0), (10, 0, 2)]
    got = spark.createDataFrame(rows, "t int, c int, w int").select(
        health_score(F.col("t"), F.col("c"), F.col("w"))).collect()
    assert [r[0] for r in got] == [100.0, 62.5, 0.0, 100.0, 90.0]


def test_numbers_that_are_none_become_null(spark):
    df = spark.createDataFrame([("1.5", "x"), ("", "y"), ("abc", "z")], "cop string, name string")
    got = reshape.cast_numeric(df)
    assert dict(got.dtypes) == {"cop": "double", "name": "string"}
    assert [r["cop"] for r in got.collect()] == [1.5, None, None]
    # With no numeric column present the frame passes through.
    assert reshape.cast_numeric(df.select("name")).columns == ["name"]


def test_gallons_to_litres(spark):
    df = spark.createDataFrame([("100",), (None,)], "water_flow_rate_gpm string")
    got = [r["water_flow_rate_lpm"] for r in reshape.gpm_to_lpm(df).collect()]
    assert got == [378.541, None]
