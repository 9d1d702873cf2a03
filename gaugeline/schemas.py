"""Explicit schemas of the raw documents and the columns each component owns.

Reading with a fixed schema avoids the inference pass over every file and keeps types stable
when a whole batch lacks a value (an all-null fault code would otherwise turn into text).
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: field names and types of the raw document -------------------------------
ENVELOPE_TEXT = (
    "ingestionMode", "uploadedBy", "uploadTimestamp", "sourceFileName", "sourceSystem",
    "ingestionChannel", "batchId", "componentId", "componentType", "circuitId", "hvacMachineId",
    "companyId", "companyName", "locationId", "locationName", "locationCity", "locationState",
    "locationCountry", "componentManufacturer", "componentModel", "componentSerialNumber",
    "componentInstallationDate", "batchStartTime", "batchEndTime",
)
#: What a single-reading document repeats inside its payload.
PAYLOAD_TEXT = (
    "batchId", "componentId", "componentType", "circuitId", "hvacMachineId", "companyId",
    "companyName", "locationId", "locationName", "locationCity", "locationState",
    "locationCountry", "componentManufacturer", "componentModel", "componentSerialNumber",
    "componentInstallationDate", "eventTimestamp", "healthMaintenanceRequired",
    "healthLastMaintenanceDate", "building", "floor", "zone", "latitude", "longitude",
    "controllerId", "controllerName", "hvacMachineName", "componentName",
)
ENVELOPE_NUMBER = ("readingIntervalSeconds", "recordCount")

RECORD_COMMON = (
    ("eventId", "string"), ("timestamp", "string"), ("circuitId", "string"), ("runHours", "string"),
    ("healthActiveFaultCode", "string"), ("healthMaintenanceFlag", "string"),
    ("healthStatus", "string"), ("dataQuality", "string"),
)
RECORD_STATUS = {
    "compressor": ("compressorStatus", "startStopCount", "runStatus"),
    "condenser": ("condenserStatus", "fanStatus"),
    "evaporator": ("evaporatorStatus", "flowSwitchStatus", "pumpControlMode", "pumpRelay1Status",
                   "pumpRelay2Status", "waterFlowRateLpm"),
    "expansion_valve": ("valveStatus", "controlMode", "valveStepPosition", "responseTimeMs",
                        "targetSuperheatC"),
}
RECORD_SENSORS = {
    "compressor": (
        "suctionPressureKpa", "dischargePressureKpa", "oilPressureKpa", "suctionTemperatureC",
        "dischargeTemperatureC", "oilTemperatureC", "motorWindingTemperatureC", "voltageV",
        "currentA", "powerConsumptionKw", "frequencyHz", "powerFactor", "rpm", "vibrationMmS",
        "bearingTemperatureC", "eer", "cop",
    ),
    "condenser": (
        "condenserPressureKpa", "pressureDropKpa", "waterInletTemperatureC",
        "waterOutletTemperatureC", "coolingTowerWaterTemperatureC", "ambientAirTemperatureC",
        "waterFlowRateGpm", "waterValvePositionPct", "fanSpeedRpm", "fanCurrentA", "fanPowerKw",
        "voltageV", "frequencyHz", "powerFactor", "powerConsumptionKw", "approachTemperatureC",
        "heatRejectionEfficiencyPct",
    ),
    "evaporator": (
        "enteringChilledWaterTemperatureC", "leavingChilledWaterTemperatureC",
        "temperatureDifferenceC", "evaporatorPressureKpa", "waterFlowRateGpm", "lwtSetpointC",
        "pumpPowerConsumptionKw", "pumpCurrentA", "pumpFrequencyHz", "coolingCapacityTr",
        "heatTransferEfficiencyPct",
    ),
    "expansion_valve": (
        "valveOpeningPct", "liquidLineTemperatureC", "evaporatorOutletTemperatureC", "superheatC",
        "subcoolingC", "inletPressureKpa", "outletPressureKpa", "pressureDropKpa",
        "refrigerantFlowRateKgMin", "actuatorVoltageV", "actuatorCurrentA", "powerConsumptionW",
    ),
}
#: Come as text or as numbers; read as text and cast after the documents are taken apart.
RECORD_TYPED = {"healthActiveFaultCode": "double", "healthMaintenanceFlag": "boolean",
                "runStatus": "bigint"}
# --- End of fixed values -------------------------------------------------------------------

_TYPES = {"string": T.StringType(), "double": T.DoubleType(), "boolean": T.BooleanType(),
          "bigint": T.LongType()}


def component_fields(component: str) -> tuple[str, ...]:
    """Raw field names that only make sense for this component (its status and sensor fields)."""
    return RECORD_STATUS[component] + RECORD_SENSORS[component]


def record_schema(extra: dict[str, T.DataType] | None = None) -> T.StructType:
    """One reading. ``extra`` adds site-specific fields so that they are kept, not dropped."""
    fields = dict(RECORD_COMMON)
    for component in RECORD_STATUS:
        for name in component_fields(component):
            fields[name] = "string"
    struct = T.StructType([T.StructField(n, _TYPES[t]) for n, t in fields.items()])
    for name, dtype in (extra or {}).items():
        struct = struct.add(name, dtype)
    return struct


def raw_schema(extra_record: dict[str, T.DataType] | None = None,
               extra_envelope: dict[str, T.DataType] | None = None) -> T.StructType:
    """A whole day-batch document: envelope fields plus the array of readings."""
    struct = T.StructType([T.StructField(n, T.StringType()) for n in ENVELOPE_TEXT]
                          + [T.StructField(n, T.LongType()) for n in ENVELOPE_NUMBER])
    for name, dtype in (extra_envelope or {}).items():
        struct = struct.add(name, dtype)
    return struct.add("records", T.ArrayType(record_schema(extra_record)))


def payload_schema(extra: dict[str, T.DataType] | None = None) -> T.StructType:
    """Single-reading variant of the document: the reading sits in ``rawPayload``.

    Here the payload repeats the identifiers, so it carries envelope names as well.
    """
    payload = record_schema(extra)
    present = set(payload.fieldNames())
    for name in PAYLOAD_TEXT:
        if name not in present:
            payload = payload.add(name, T.StringType())
    outside = [n for n in ENVELOPE_TEXT if n not in PAYLOAD_TEXT
               and n not in ("batchStartTime", "batchEndTime")]
    struct = T.StructType([T.StructField(n, T.StringType()) for n in outside])
    return struct.add("rawPayload", payload)


# Nested device document. The groups and their members.
DEVICE_GROUPS = {
    "company": ("companyId", "companyName"),
    "location": ("locationId", "locationName", "building", "floor", "zone", "city", "state",
                 "country", "latitude", "longitude"),
    "controller": ("controllerId", "controllerName"),
    "hvacMachine": ("hvacMachineId", "hvacMachineName"),
    "component": ("componentId", "componentType", "componentName", "manufacturer", "model",
                  "serialNumber", "installationDate"),
    "health": ("healthStatus", "maintenanceRequired", "lastMaintenanceDate", "activeFaultCode",
               "maintenanceFlag"),
}
# End of fixed values.

# Members of the topology, fault dictionary and ledger documents.
TOPOLOGY = {
    "customers": T.StructType([T.StructField(n, T.StringType()) for n in
                               ("companyId", "companyName", "industry", "accountType")]),
    "locations": T.StructType([T.StructField(n, T.StringType()) for n in
                               ("locationId", "companyId", "locationName", "city", "state",
                                "country")]),
    "hvac_machines": T.StructType([T.StructField(n, T.StringType()) for n in
                                   ("hvacMachineId", "locationId", "manufacturer", "model")]),
}

_FAULT_ENTRY = T.StructType([T.StructField(n, T.StringType()) for n in
                             ("fault_id", "label", "component_type", "severity", "description",
                              "recommended_action")])
_BAND_ENTRY = T.StructType([T.StructField("min", T.DoubleType()), T.StructField("max", T.DoubleType()),
                            T.StructField("label", T.StringType()),
                            T.StructField("color", T.StringType()),
                            T.StructField("description", T.StringType())])
FAULT_DICTIONARY = T.StructType([
    T.StructField("codes", T.MapType(T.StringType(), _FAULT_ENTRY)),
    T.StructField("health_score_thresholds", T.MapType(T.StringType(), _BAND_ENTRY)),
])

LEDGER = T.StructType([
    T.StructField("latest_date", T.StringType()),
    T.StructField("generated_dates", T.ArrayType(T.StringType())),
    T.StructField("run_history", T.ArrayType(T.StructType([
        T.StructField("start", T.StringType()), T.StructField("end", T.StringType()),
        T.StructField("days", T.LongType()), T.StructField("timestamp", T.StringType()),
        T.StructField("dates_added", T.ArrayType(T.StringType())),
        T.StructField("note", T.StringType())]))),
])
# End of fixed values.
