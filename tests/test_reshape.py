import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline import schemas
from gaugeline.operators import reshape
from gaugeline.plans.ingest import flatten_documents


def documents(spark, docs, schema=None):
    rows = [(json.dumps(d),) for d in docs]
    return (spark.createDataFrame(rows, "doc string")
            .select(F.from_json("doc", schema or schemas.raw_schema()).alias("d")).select("d.*"))


def test_empty_and_missing_records_yield_nothing(spark):
    docs = [{"componentId": "a", "records": []}, {"componentId": "b", "records": None},
            {"componentId": "c"}, {"componentId": "d", "records": [{"eventId": "1"}, {"eventId": "2"}]}]
    got = flatten_documents(documents(spark, docs)).select("componentId", "eventId").collect()
    assert sorted(tuple(r) for r in got) == [("d", "1"), ("d", "2")]


@pytest.mark.parametrize("envelope_wins, expected", [(True, "A"), (False, "B")])
def test_name_clash(spark, envelope_wins, expected):
    docs = [{"circuitId": "A", "records": [{"circuitId": "B", "eventId": "1"}]}]
    exploded = reshape.explode_records(documents(spark, docs))
    flat = reshape.flatten_record(exploded, envelope_wins=envelope_wins)
    assert flat.columns.count("circuitId") == 1
    assert flat.first()["circuitId"] == expected


def test_types_hold_when_a_batch_has_only_nulls(spark):
    docs = [{"records": [{"eventId": "1", "healthActiveFaultCode": None, "cop": None}]}]
    types = dict(flatten_documents(documents(spark, docs)).dtypes)
    assert (types["healthActiveFaultCode"], types["cop"]) == ("double", "string")
    assert (types["timestamp"], types["date"]) == ("bigint", "date")


def test_numeric_timestamp_and_number_sensors_are_read(spark):
    docs = [{"records": [{"eventId": "1", "timestamp": 1735689600000, "cop": 3.5,
                          "healthActiveFaultCode": 288}]}]
    row = flatten_documents(documents(spark, docs)).first()
    assert (row["timestamp"], row["date"]) == (1735689600000, dt.date(2025, 1, 1))
    assert (row["cop"], row["healthActiveFaultCode"]) == ("3.5", 288.0)


def test_extra_fields_are_kept_when_named(spark):
    schema = schemas.raw_schema({"noiseDb": T.StringType()}, {"siteTag": T.StringType()})
    docs = [{"siteTag": "s", "componentType": "compressor",
             "records": [{"eventId": "1", "noiseDb": "44"}]}]
    flat = flatten_documents(documents(spark, docs, schema))
    row = reshape.route(flat)["compressor"].first()
    assert (row["siteTag"], row["noiseDb"]) == ("s", "44")


def test_route_keeps_own_columns_and_drops_unknown_types(spark):
    docs = [{"componentType": t, "records": [{"eventId": t}]}
            for t in ("compressor", "condenser", "boiler", None)]
    frames = reshape.route(flatten_documents(documents(spark, docs)))
    assert set(frames) == {"compressor", "condenser", "evaporator", "expansion_valve"}
    assert [f.count() for f in frames.values()] == [1, 1, 0, 0]
    assert "suctionPressureKpa" in frames["compressor"].columns
    assert "suctionPressureKpa" not in frames["condenser"].columns
    assert "voltageV" in frames["condenser"].columns


def test_snake_case_columns(spark):
    df = spark.createDataFrame([(1, 2)], "eventId int, date int")
    assert reshape.snake_case_columns(df).columns == ["event_id", "date"]


def test_date_range_is_inclusive_and_open_ended(spark):
    days = [dt.date(2025, 1, d) for d in (1, 2, 3, 4)]
    df = spark.createDataFrame([(d,) for d in days], "date date")
    def picked(**bounds):
        return sorted(r[0] for r in reshape.between_dates(df, **bounds).collect())
    assert picked(start="2025-01-02", end="2025-01-03") == days[1:3]
    assert picked(start=days[2]) == days[2:]
    assert picked(end=days[1]) == days[:2]
    assert picked() == days


def test_date_range_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, dt.date(2025, 1, 1)), (2, dt.date(2025, 1, 2))], "v int, date date"
                          ).write.partitionBy("date").parquet(path)
    plan = reshape.between_dates(spark.read.parquet(path), "2025-01-02")._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in text and "2025-01-02" in text


def test_power_normalisation(spark):
    rows = [("compressor", 5.0, None, None), ("evaporator", None, 7.0, None),
            ("expansion_valve", None, None, 12.0)]
    df = spark.createDataFrame(rows, "component_type string, power_consumption_kw double, "
                                     "pump_power_consumption_kw double, power_consumption_w double")
    got = {r["component_type"]: r["power_consumption_kw"]
           for r in reshape.normalise_power(df).collect()}
    assert got == {"compressor": 5.0, "evaporator": 7.0, "expansion_valve": 0.012}
    bare = df.select("component_type")
    assert reshape.normalise_power(bare).first()["power_consumption_kw"] is None


def test_payload_and_device_documents(spark):
    payload = documents(spark, [{"ingestionMode": "REALTIME", "rawPayload": {
        "eventId": "1", "timestamp": 5, "componentType": "condenser", "fanStatus": "ON"}}],
        schemas.payload_schema())
    row = reshape.unwrap_payload(payload).first()
    assert (row["ingestionMode"], row["eventId"], row["fanStatus"]) == ("REALTIME", "1", "ON")

    nested = spark.createDataFrame(
        [("1", "t", "GOOD", ("LOC-01", "east"), ("C-1", "expansionValve", "Acme"),
          ("Healthy", "288"), (500.0, 42.0))],
        "eventId string, timestamp string, dataQuality string, "
        "location struct<locationId:string,zone:string>, "
        "component struct<componentId:string,componentType:string,manufacturer:string>, "
        "health struct<healthStatus:string,activeFaultCode:string>, "
        "telemetry struct<inletPressure_kPa:double,refrigerantFlowRate_kg_min:double>")
    got = reshape.flatten_device_document(nested).first().asDict()
    assert got == {"event_id": "1", "timestamp": "t", "data_quality": "GOOD",
                   "location_id": "LOC-01", "location_zone": "east", "component_id": "C-1",
                   "component_type": "expansion_valve", "component_manufacturer": "Acme",
                   "health_status": "Healthy", "health_active_fault_code": "288",
                   "inlet_pressure_kpa": 500.0, "refrigerant_flow_rate_kg_min": 42.0}


def test_codes_and_flags_as_text(spark):
    docs = [{"records": [{"eventId": "1", "healthActiveFaultCode": "288", "runStatus": "1",
                          "healthMaintenanceFlag": "true"},
                         {"eventId": "2", "healthActiveFaultCode": "NaN", "runStatus": "x",
                          "healthMaintenanceFlag": False},
                         {"eventId": "3", "healthActiveFaultCode": 315, "runStatus": 1}]}]
    rows = flatten_documents(documents(spark, docs)).orderBy("eventId").collect()
    assert [(r["healthActiveFaultCode"], r["healthMaintenanceFlag"], r["runStatus"]) for r in rows] \
        == [(288.0, True, 1), (None, False, None), (315.0, None, 1)]


def test_route_in_place_is_route_in_one_frame(spark):
    docs = [{"componentId": f"C{k}", "componentType": kind, "records": [
        {"eventId": f"e{k}", "timestamp": "0", "rpm": "1", "fanSpeedRpm": "2", "voltageV": "3",
         "valveOpeningPct": "4", "waterFlowRateGpm": "5"}]}
        for k, kind in enumerate(("compressor", "condenser", "evaporator", "expansion_valve", "boiler"))]
    flat = flatten_documents(documents(spark, docs))
    together = reshape.route_in_place(flat)
    assert together.columns == flat.columns and together.count() == 4
    for kind, frame in reshape.route(flat).items():
        own = together.filter(F.col("componentType") == kind)
        assert own.select(*frame.columns).collect() == frame.collect()
        gone = [c for c in flat.columns if c not in frame.columns]
        assert all(v is None for v in own.select(*gone).first())
