"""Every limit of the quality gate, probed below, at and above its bounds, against SQL that states the
limits itself instead of taking them from the library."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeline.operators import quality
from gaugeline.operators.reshape import union_components
from gaugeline.operators.rules import RULES
from harness import telemetry as tm
from harness.queries import query

# Column, least and greatest value per component; pairs whose first must exceed the second,
# and by how much it may fall short.
LIMITS = {
    "compressor": """
        suction_pressure_kpa 100 800
        discharge_pressure_kpa 500 2500
        oil_pressure_kpa 50 600
        suction_temperature_c -20 30
        discharge_temperature_c 30 120
        oil_temperature_c 10 100
        motor_winding_temperature_c 20 150
        voltage_v 350 480
        current_a 0 100
        power_consumption_kw 0 150
        frequency_hz 45 65
        power_factor 0.5 1.0
        rpm 0 5000
        vibration_mm_s 0 20
        bearing_temperature_c 10 130
        eer 2 25
        cop 1 10""",
    "condenser": """
        condenser_pressure_kpa 500 2500
        pressure_drop_kpa 0 100
        water_inlet_temperature_c 5 60
        water_outlet_temperature_c 5 70
        cooling_tower_water_temperature_c 5 55
        ambient_air_temperature_c -10 60
        water_flow_rate_gpm 0 1500
        water_valve_position_pct 0 100
        fan_speed_rpm 0 2000
        fan_current_a 0 50
        fan_power_kw 0 30
        voltage_v 350 480
        frequency_hz 45 65
        power_factor 0.5 1.0
        power_consumption_kw 0 50
        approach_temperature_c -5 20
        heat_rejection_efficiency_pct 0 100""",
    "evaporator": """
        entering_chilled_water_temperature_c 0 30
        leaving_chilled_water_temperature_c -5 25
        temperature_difference_c 0 20
        evaporator_pressure_kpa 100 700
        water_flow_rate_gpm 0 1500
        lwt_setpoint_c 2 15
        pump_power_consumption_kw 0 60
        pump_current_a 0 80
        pump_frequency_hz 45 65
        cooling_capacity_tr 0 500
        heat_transfer_efficiency_pct 0 100""",
    "expansion_valve": """
        valve_opening_pct 0 100
        liquid_line_temperature_c 5 60
        evaporator_outlet_temperature_c -10 30
        superheat_c 0 30
        subcooling_c 0 25
        inlet_pressure_kpa 400 2500
        outlet_pressure_kpa 100 800
        pressure_drop_kpa 0 1500
        refrigerant_flow_rate_kg_min 0 60
        actuator_voltage_v 10 35
        actuator_current_a 0 2
        power_consumption_w 0 30""",
}
PAIRS = {
    "compressor": (("discharge_pressure_kpa", "suction_pressure_kpa", 50),
                   ("discharge_temperature_c", "suction_temperature_c", 5)),
    "condenser": (("water_outlet_temperature_c", "water_inlet_temperature_c", 2),),
    "evaporator": (("entering_chilled_water_temperature_c", "leaving_chilled_water_temperature_c", 1),),
    "expansion_valve": (("inlet_pressure_kpa", "outlet_pressure_kpa", 50),),
}
MANDATORY = ("event_id", "timestamp", "component_id", "hvac_machine_id", "location_id", "health_status")
YEAR_MS = 31_536_000_000
# End of fixed values.


def _limits(kind: str) -> list[tuple[str, float, float]]:
    rows = [line.split() for line in LIMITS[kind].strip().splitlines()]
    return [(name, float(low), float(high)) for name, low, high in rows]


def _probed(kind: str) -> dict[str, str]:
    """Column to expression, valid in both dialects. Each event probes one column at one spot."""
    limits = _limits(kind)
    columns = {}
    for k, (name, low, high) in enumerate(limits):
        at = [low - 0.25, low, high, high + 0.25]
        spots = " ".join(f"WHEN {n} THEN {x}" for n, x in enumerate(at))
        columns[name] = (f"CAST(CASE WHEN e % {len(limits)} <> {k} THEN {(low + high) / 2} ELSE "
                         f"CASE CAST(floor(e / {len(limits)}) AS INT) % 6 {spots} WHEN 4 THEN NULL ELSE "
                         f"{(low + high) / 2} END END AS DOUBLE)")
    return columns


_TEXT = {
    "event_id": "CASE e % 29 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE concat('E-', e) END",
    "component_id": "CASE e % 29 WHEN 2 THEN NULL WHEN 3 THEN '' ELSE concat('C-', u) END",
    "hvac_machine_id": "CASE e % 29 WHEN 4 THEN NULL WHEN 5 THEN '' ELSE concat('M-', m) END",
    "location_id": "CASE e % 29 WHEN 6 THEN NULL WHEN 7 THEN '' ELSE 'L' END",
    "health_status": "CASE e % 29 WHEN 8 THEN NULL WHEN 9 THEN '' WHEN 10 THEN 'healthy' WHEN 11 THEN "
                     "'Warning' WHEN 12 THEN 'Critical' ELSE 'Healthy' END",
    "data_quality": "CASE e % 29 WHEN 13 THEN NULL WHEN 14 THEN 'PARTIAL' WHEN 15 THEN 'BAD' ELSE "
                    "'GOOD' END",
}
#: No two are equal, so that the latest row of a repeated id is certain.
_TIME = (f"CASE e % 29 WHEN 16 THEN NULL WHEN 17 THEN -e WHEN 18 THEN {tm.NOW_MS + YEAR_MS} + 1 + e "
         f"WHEN 19 THEN {tm.NOW_MS + YEAR_MS} - e ELSE 1704067200000 + e END")


def _gate(kind: str) -> str:
    columns = [*_TEXT.items(), ("timestamp", _TIME), *_probed(kind).items()]
    rows = ", ".join(f"{expression} AS {name}" for name, expression in columns)
    cases = ["WHEN rn > 1 THEN 'Duplicate event_id'",
             "WHEN data_quality NOT IN ('GOOD', 'PARTIAL') THEN 'Bad data_quality'"]
    cases += [f"WHEN coalesce(CAST({name} AS VARCHAR), '') = '' THEN 'Null mandatory field: {name}'"
              for name in MANDATORY]
    cases += ["WHEN timestamp IS NULL OR timestamp <= 0 THEN 'Invalid timestamp'",
              f"WHEN timestamp > {tm.NOW_MS + YEAR_MS} THEN 'Future timestamp'"]
    cases += [f"WHEN {name} < {low} OR {name} > {high} THEN 'Out of range: {name}'"
              for name, low, high in _limits(kind)]
    cases += [f"WHEN {a} + {short} <= {b} THEN 'Cross field error: {a} > {b}'"
              for a, b, short in PAIRS[kind]]
    cases += ["WHEN health_status NOT IN ('Healthy', 'Warning', 'Critical') THEN 'Invalid health_status'"]
    reasons = ", ".join(f"CASE {case} END" for case in cases)
    return (f"SELECT '{kind}' AS component_type, event_id, timestamp, concat_ws(' | ', {reasons}) AS "
            f"failure_reason FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY timestamp "
            f"DESC NULLS LAST) AS rn FROM (SELECT {rows} FROM base WHERE c = {tm.TYPES.index(kind)}))")


@query(f"WITH {tm.base_sql()} SELECT *, failure_reason = '' AS is_valid FROM ("
       + " UNION ALL ".join(_gate(kind) for kind in tm.TYPES) + ")")
def quality_limits(spark, sf_dir):
    base = tm._spark_base(spark, sf_dir)
    frames = {}
    for k, kind in enumerate(tm.TYPES):
        sensors = [F.expr(x).cast("string").alias(n) for n, x in _probed(kind).items()]
        rows = base.filter(F.col("c") == k).select(
            *[F.expr(x).alias(n) for n, x in _TEXT.items()], F.expr(_TIME).alias("timestamp"), *sensors,
            F.lit(kind).alias("component_type"))
        frames[kind] = quality.apply_quality_rules(rows, RULES[kind], tm.NOW_MS).select(
            "component_type", "event_id", "timestamp", "failure_reason", "is_valid")
    return union_components(frames)
