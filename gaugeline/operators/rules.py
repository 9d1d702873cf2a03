"""Quality rules as data."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class RuleSet:
    """What a valid row of one component looks like.

    ``ranges`` holds inclusive bounds. ``greater`` holds (a, b, buffer): a must exceed b, and the
    check only fails once a plus the buffer is no longer above b.
    """

    mandatory: tuple[str, ...] = ()
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)
    greater: tuple[tuple[str, str, float], ...] = ()


# --- Fixed values: accepted states and limits per component --------------------------------
ACCEPTED_QUALITY = ("GOOD", "PARTIAL")
ACCEPTED_HEALTH = ("Healthy", "Warning", "Critical")
FUTURE_ALLOWANCE_DAYS = 365

_MANDATORY = ("event_id", "timestamp", "component_id", "hvac_machine_id", "location_id",
              "health_status")

RULES = {
    "compressor": RuleSet(
        mandatory=_MANDATORY,
        ranges={
            "suction_pressure_kpa": (100, 800),
            "discharge_pressure_kpa": (500, 2500),
            "oil_pressure_kpa": (50, 600),
            "suction_temperature_c": (-20, 30),
            "discharge_temperature_c": (30, 120),
            "oil_temperature_c": (10, 100),
            "motor_winding_temperature_c": (20, 150),
            "voltage_v": (350, 480),
            "current_a": (0, 100),
            "power_consumption_kw": (0, 150),
            "frequency_hz": (45, 65),
            "power_factor": (0.5, 1.0),
            "rpm": (0, 5000),
            "vibration_mm_s": (0, 20),
            "bearing_temperature_c": (10, 130),
            "eer": (2, 25),
            "cop": (1, 10),
        },
        greater=(
            ("discharge_pressure_kpa", "suction_pressure_kpa", 50),
            ("discharge_temperature_c", "suction_temperature_c", 5),
        ),
    ),
    "condenser": RuleSet(
        mandatory=_MANDATORY,
        ranges={
            "condenser_pressure_kpa": (500, 2500),
            "pressure_drop_kpa": (0, 100),
            "water_inlet_temperature_c": (5, 60),
            "water_outlet_temperature_c": (5, 70),
            "cooling_tower_water_temperature_c": (5, 55),
            "ambient_air_temperature_c": (-10, 60),
            "water_flow_rate_gpm": (0, 1500),
            "water_valve_position_pct": (0, 100),
            "fan_speed_rpm": (0, 2000),
            "fan_current_a": (0, 50),
            "fan_power_kw": (0, 30),
            "voltage_v": (350, 480),
            "frequency_hz": (45, 65),
            "power_factor": (0.5, 1.0),
            "power_consumption_kw": (0, 50),
            "approach_temperature_c": (-5, 20),
            "heat_rejection_efficiency_pct": (0, 100),
        },
        greater=(("water_outlet_temperature_c", "water_inlet_temperature_c", 2),),
    ),
    "evaporator": RuleSet(
        mandatory=_MANDATORY,
        ranges={
            "entering_chilled_water_temperature_c": (0, 30),
            "leaving_chilled_water_temperature_c": (-5, 25),
            "temperature_difference_c": (0, 20),
            "evaporator_pressure_kpa": (100, 700),
            "water_flow_rate_gpm": (0, 1500),
            "lwt_setpoint_c": (2, 15),
            "pump_power_consumption_kw": (0, 60),
            "pump_current_a": (0, 80),
            "pump_frequency_hz": (45, 65),
            "cooling_capacity_tr": (0, 500),
            "heat_transfer_efficiency_pct": (0, 100),
        },
        greater=(
            ("entering_chilled_water_temperature_c", "leaving_chilled_water_temperature_c", 1),
        ),
    ),
    "expansion_valve": RuleSet(
        mandatory=_MANDATORY,
        ranges={
            "valve_opening_pct": (0, 100),
            "liquid_line_temperature_c": (5, 60),
            "evaporator_outlet_temperature_c": (-10, 30),
            "superheat_c": (0, 30),
            "subcooling_c": (0, 25),
            "inlet_pressure_kpa": (400, 2500),
            "outlet_pressure_kpa": (100, 800),
            "pressure_drop_kpa": (0, 1500),
            "refrigerant_flow_rate_kg_min": (0, 60),
            "actuator_voltage_v": (10, 35),
            "actuator_current_a": (0, 2),
            "power_consumption_w": (0, 30),
        },
        greater=(("inlet_pressure_kpa", "outlet_pressure_kpa", 50),),
    ),
}
# --- End of fixed values -------------------------------------------------------------------
