"""A two-machine fleet written as raw files, and what the gold tables must say about it."""

import datetime as dt
import json

from gaugeline.operators.ledger import MONTHS

MACHINES = ("HVAC-01-01", "HVAC-01-02")
DAYS = (dt.date(2025, 3, 1), dt.date(2025, 3, 2))
NOW_MS = 1_743_465_600_000  # 2025-04-01T00:00:00Z
SENSORS = {
    "compressor": {"suctionPressureKpa": "300", "dischargePressureKpa": "1200", "cop": "4.0",
                   "eer": "12.0", "powerConsumptionKw": "60.0", "vibrationMmS": "2.5",
                   "suctionTemperatureC": "5", "dischargeTemperatureC": "70"},
    "condenser": {"waterInletTemperatureC": "25", "waterOutletTemperatureC": "31",
                  "fanSpeedRpm": "900", "powerConsumptionKw": "6.0",
                  "approachTemperatureC": "3", "heatRejectionEfficiencyPct": "90"},
    "evaporator": {"enteringChilledWaterTemperatureC": "12",
                   "leavingChilledWaterTemperatureC": "7", "coolingCapacityTr": "200",
                   "pumpPowerConsumptionKw": "12.0", "heatTransferEfficiencyPct": "85"},
    "expansion_valve": {"valveOpeningPct": "50", "superheatC": "6", "subcoolingC": "5",
                        "refrigerantFlowRateKgMin": "20", "inletPressureKpa": "1200",
                        "outletPressureKpa": "400", "powerConsumptionW": "12.0"},
}


def document(component, machine, day, circuit=None, readings=12, changes=None):
    number = machine[5:].replace("-", "")
    component_id = f"{component[:4].upper()}-{number}{circuit or ''}"
    start = dt.datetime(day.year, day.month, day.day, tzinfo=dt.timezone.utc)
    records = []
    for i in range(readings):
        ts = int((start + dt.timedelta(minutes=5 * i)).timestamp() * 1000)
        record = {"eventId": f"{component_id}_{ts}", "timestamp": str(ts), "circuitId": "in-record",
                  "runHours": str(100 + i), "healthActiveFaultCode": None, "healthStatus": "Healthy",
                  "healthMaintenanceFlag": False, "dataQuality": "GOOD", **SENSORS[component]}
        if component == "compressor":
            record.update(runStatus=1, startStopCount=str(5 + i // 6))
        record.update((changes or {}).get(i, {}))
        records.append(record)
    return {"ingestionMode": "BATCH", "componentId": component_id, "componentType": component,
            "circuitId": circuit, "hvacMachineId": machine, "companyId": "CUST-01",
            "companyName": "Acme", "locationId": "LOC-01", "locationName": "Site",
            "batchId": f"batch-{component_id}-{day}", "componentManufacturer": "Maker",
            "componentModel": "M1", "readingIntervalSeconds": 300, "recordCount": len(records),
            "records": records}


def write(root, documents_by_day):
    for day, documents in documents_by_day.items():
        folder = root / "location_01" / str(day.year) / MONTHS[day.month - 1] / f"day{day.day}"
        folder.mkdir(parents=True, exist_ok=True)
        for n, doc in enumerate(documents):
            (folder / f"{doc['componentId']}_{n}.json").write_text(json.dumps(doc, indent=1))


def standard_day(day):
    """All components of both machines; one compressor runs into a fault, some rows are bad."""
    fault = {i: {"healthStatus": "Critical", "healthActiveFaultCode": 288} for i in (3, 4)}
    fault[8] = {"healthStatus": "Warning", "healthActiveFaultCode": 315}
    bad = {0: {"dataQuality": "STALE"}, 1: {"fanSpeedRpm": "5000", "healthStatus": "odd"}}
    documents = []
    for machine in MACHINES:
        first = machine == MACHINES[0]
        documents += [document("compressor", machine, day, "A", changes=fault if first else None),
                      document("compressor", machine, day, "B"),
                      document("condenser", machine, day, changes=bad if first else None),
                      document("evaporator", machine, day),
                      document("expansion_valve", machine, day, "A")]
    return documents


def write_config(root):
    (root / "topology").mkdir(parents=True)
    (root / "topology" / "customers.json").write_text(json.dumps(
        [{"companyId": "CUST-01", "companyName": "Acme", "industry": "Works",
          "accountType": "Enterprise"}]))
    (root / "topology" / "locations.json").write_text(json.dumps(
        [{"locationId": "LOC-01", "companyId": "CUST-01", "locationName": "Site", "city": "Town",
          "state": "", "country": "USA"}]))
    (root / "topology" / "hvac_machines.json").write_text(json.dumps(
        [{"hvacMachineId": m, "locationId": "LOC-01", "manufacturer": "Maker", "model": "X"}
         for m in MACHINES]))
    (root / "critical_reading_codes.json").write_text(json.dumps(
        {"version": "1", "codes": {"288": {"label": "Hot", "component_type": "compressor",
                                           "severity": "CRITICAL"},
                                   "315": {"label": "Shaky", "description": "d"}}}))


def table(spark, paths, layer, name):
    from gaugeline.sources.tables import read_table
    return read_table(spark, f"{paths[layer]}/{name}")
