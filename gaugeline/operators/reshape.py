"""Projections and filters that turn raw documents into typed telemetry rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline import COMPONENTS, schemas
from gaugeline.functions import (date_of, epoch_millis, hour_of, litres_per_minute, snake_case)


def explode_records(df: DataFrame, array: str = "records", into: str = "record") -> DataFrame:
    """One row per reading. Documents whose array is NULL or empty yield no row."""
    others = [c for c in df.columns if c != array]
    return df.select(*others, F.explode(array).alias(into))


def flatten_record(df: DataFrame, record: str = "record", envelope_wins: bool = True) -> DataFrame:
    """Lift the fields of ``record`` to the top level.

    A name found on both levels keeps the envelope value (or the record's, if so asked).
    """
    envelope = [c for c in df.columns if c != record]
    inner = df.schema[record].dataType.fieldNames()
    if envelope_wins:
        inner = [f for f in inner if f not in envelope]
    else:
        envelope = [c for c in envelope if c not in inner]
    return df.select(*envelope, *[typed(f, F.col(record)[f]).alias(f) for f in inner])


def typed(name: str, value: Column) -> Column:
    """Codes and flags that documents give as text or as numbers, in their type; NaN is no code."""
    kind = schemas.RECORD_TYPED.get(name)
    if kind is None:
        return value
    number = value.try_cast("double") if kind != "boolean" else value
    if kind == "double":
        return F.when(~F.isnan(number), number)
    return number.try_cast(kind)


def unwrap_payload(df: DataFrame, payload: str = "rawPayload") -> DataFrame:
    """Flatten the single-reading document variant; ``timestamp`` falls back to eventTimestamp."""
    flat = flatten_record(df, payload, envelope_wins=True)
    if "eventTimestamp" in flat.columns:
        flat = flat.withColumn("timestamp", F.coalesce("timestamp", "eventTimestamp"))
    return flat


def flatten_device_document(df: DataFrame) -> DataFrame:
    """Nested device document -> flat snake_case columns.

    Column names follow the telemetry tables: identifiers keep their name, attributes of the
    location, component and health groups get the group as prefix.
    """
    prefixed = {"location": "location", "component": "component", "health": "health"}
    out: list[Column] = [F.col("eventId").alias("event_id"), F.col("timestamp"),
                         F.col("dataQuality").alias("data_quality")]
    if "schemaVersion" in df.columns:
        out.append(F.col("schemaVersion").alias("schema_version"))
    for group in schemas.DEVICE_GROUPS:
        if group not in df.columns:
            continue
        for field in df.schema[group].dataType.fieldNames():
            name = snake_case(field)
            prefix = prefixed.get(group)
            if prefix and not name.startswith(prefix + "_"):
                name = f"{prefix}_{name}"
            value = F.col(group)[field]
            if name == "component_type":
                value = F.when(value == "expansionValve", "expansion_valve").otherwise(value)
            out.append(value.alias(name))
    for field in df.schema["telemetry"].dataType.fieldNames():
        stem, _, unit = field.partition("_")
        name = snake_case(stem) + (f"_{unit.lower()}" if unit else "")
        out.append(F.col("telemetry")[field].alias(name))
    return df.select(*out)


def with_event_date(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Milliseconds as BIGINT plus the UTC calendar date."""
    millis = epoch_millis(F.col(ts))
    return df.withColumns({ts: millis, "date": date_of(millis)})


def _foreign_fields(component: str) -> set[str]:
    """Fields, in either spelling, that belong only to other components."""
    own = set(schemas.component_fields(component))
    foreign = {f for other in COMPONENTS if other != component
               for f in schemas.component_fields(other)} - own
    return (foreign | {snake_case(f) for f in foreign}) - {snake_case(f) for f in own}


def route(df: DataFrame, components: Iterable[str] = COMPONENTS,
          type_column: str = "componentType") -> dict[str, DataFrame]:
    """One frame per component type; rows of any other type are left out.

    Each frame drops the fields that belong only to other components.
    """
    routed = {}
    for component in components:
        foreign = _foreign_fields(component)
        routed[component] = df.filter(F.col(type_column) == component).select(
            *[c for c in df.columns if c not in foreign])
    return routed


def route_in_place(df: DataFrame, components: Iterable[str] = COMPONENTS,
                   type_column: str = "componentType") -> DataFrame:
    """All components in one frame, each row without the fields that belong only to other components;
    rows of any other type are left out. One pass, where :func:`route` reads its input once for each
    frame that is used."""
    foreign = {component: _foreign_fields(component) for component in components}

    def kept(name: str) -> Column:
        without = [c for c in components if name in foreign[c]]
        value = F.when(~F.col(type_column).isin(without), F.col(name)) if without else F.col(name)
        return value.alias(name)

    return df.filter(F.col(type_column).isin(list(components))).select(*map(kept, df.columns))


def snake_case_columns(df: DataFrame) -> DataFrame:
    renamed = {c: snake_case(c) for c in df.columns}
    return df.withColumnsRenamed({old: new for old, new in renamed.items() if old != new})


def between_dates(df: DataFrame, start=None, end=None, column: str = "date") -> DataFrame:
    """Inclusive range on the partition column; either bound may be absent."""
    if start is not None:
        df = df.filter(F.col(column) >= F.lit(str(start)).cast("date"))
    if end is not None:
        df = df.filter(F.col(column) <= F.lit(str(end)).cast("date"))
    return df


# Sensor columns that the gold tables aggregate as numbers.
NUMERIC_COLUMNS = (
    "run_hours", "start_stop_count", "cop", "eer", "power_consumption_kw", "vibration_mm_s",
    "suction_temperature_c", "discharge_temperature_c", "suction_pressure_kpa",
    "discharge_pressure_kpa", "water_inlet_temperature_c", "water_outlet_temperature_c",
    "fan_speed_rpm", "heat_rejection_efficiency_pct", "approach_temperature_c",
    "pump_power_consumption_kw", "cooling_capacity_tr", "entering_chilled_water_temperature_c",
    "leaving_chilled_water_temperature_c", "heat_transfer_efficiency_pct", "power_consumption_w",
    "valve_opening_pct", "superheat_c", "subcooling_c", "refrigerant_flow_rate_kg_min",
    "run_status",
)
# End of fixed values.


def cast_numeric(df: DataFrame, columns: Iterable[str] = NUMERIC_COLUMNS) -> DataFrame:
    """Listed columns, where present, to DOUBLE; text that is no number becomes NULL."""
    present = set(df.columns)
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns if c in present})


def with_component_hour(df: DataFrame, component: str | None = None,
                        ts: str = "timestamp") -> DataFrame:
    """Tag the component type (when given) and derive the hour of day, 0 to 23."""
    columns = {"hour": hour_of(F.col(ts))}
    if component is not None:
        columns["component_type"] = F.lit(component)
    return df.withColumns(columns)


def normalise_power(df: DataFrame) -> DataFrame:
    """Power in kW in ``power_consumption_kw`` whatever the component reports."""
    present = set(df.columns)
    power = (F.col("power_consumption_kw") if "power_consumption_kw" in present
             else F.lit(None).cast("double"))
    kind = F.col("component_type")
    if "pump_power_consumption_kw" in present:
        power = F.when(kind == "evaporator", F.col("pump_power_consumption_kw")).otherwise(power)
    if "power_consumption_w" in present:
        power = F.when(kind == "expansion_valve",
                       F.col("power_consumption_w") / 1000.0).otherwise(power)
    return df.withColumn("power_consumption_kw", power)


def gpm_to_lpm(df: DataFrame, column: str = "water_flow_rate_gpm",
               into: str = "water_flow_rate_lpm") -> DataFrame:
    return df.withColumn(into, litres_per_minute(F.col(column)))


def prepare_telemetry(df: DataFrame, component: str) -> DataFrame:
    """Silver rows of one component, ready for aggregation."""
    return normalise_power(cast_numeric(with_component_hour(df, component)))


def union_components(frames: Mapping[str, DataFrame]) -> DataFrame:
    """All components in one frame over the union of their columns, absent ones NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames.values())


def add_missing_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    absent = [f for f in schema if f.name not in df.columns]
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent}) if absent else df
