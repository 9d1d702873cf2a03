"""Derived columns per component that the data model declares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _number(name: str) -> Column:
    return F.col(name).try_cast("double")


def _is_faulted() -> Column:
    return F.col("fault_code_key").isNotNull()


def compressor_derived(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "is_running": F.col("compressor_status") == "ON",
        "pressure_ratio": F.try_divide(_number("discharge_pressure_kpa"),
                                       _number("suction_pressure_kpa")),
        "temperature_rise_c": _number("discharge_temperature_c") - _number("suction_temperature_c"),
        "is_faulted": _is_faulted(),
    })


def condenser_derived(df: DataFrame, heat_constant: float) -> DataFrame:
    """``heat_constant`` turns gpm x degrees Celsius into kW; no value is laid down for it."""
    warming = _number("water_outlet_temperature_c") - _number("water_inlet_temperature_c")
    return df.withColumns({
        "is_running": F.col("condenser_status") == "ON",
        "is_fan_running": F.col("fan_status") == "ON",
        "heat_rejection_kw": _number("water_flow_rate_gpm") * warming * F.lit(float(heat_constant)),
        "is_faulted": _is_faulted(),
    })


def evaporator_derived(df: DataFrame, heat_constant: float) -> DataFrame:
    """``heat_constant`` as for the condenser."""
    return df.withColumns({
        "is_pump_running": (F.col("pump_relay1_status") == "ON")
        | (F.col("pump_relay2_status") == "ON"),
        "cooling_load_kw": _number("water_flow_rate_gpm") * _number("temperature_difference_c")
        * F.lit(float(heat_constant)),
        "setpoint_deviation_c": _number("leaving_chilled_water_temperature_c")
        - _number("lwt_setpoint_c"),
        "is_faulted": _is_faulted(),
    })


def expansion_valve_derived(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "is_active": F.col("valve_status") == "ACTIVE",
        "superheat_deviation_c": _number("superheat_c") - _number("target_superheat_c"),
        "is_faulted": _is_faulted(),
    })
