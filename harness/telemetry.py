"""The given ``events`` table read as equipment telemetry, once for Spark and once as SQL.

Sensor values are multiples of a power of two, so their sums are exact in any order and both
engines must agree to the last bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NOW_MS = 1_706_745_600_000  # 2024-02-01T00:00:00Z, the clock of the gate queries
FAR_FUTURE_MS = 800 * 86_400_000

# Sensor columns: component index -> {column: expression valid in both dialects}.
# v is the value in quarter steps, e the event id, k the event type.
SENSORS = {
    0: {
        "suction_pressure_kpa": "90 + v",
        "discharge_pressure_kpa": "900 - v * 4",
        "suction_temperature_c": "v / 4 - 5",
        "discharge_temperature_c": "40 + v / 2",
        "vibration_mm_s": "v / 8",
        "power_consumption_kw": "CASE WHEN k <> 'signup' THEN v END",
        "cop": "CASE WHEN k <> 'click' THEN 1 + v / 16 END",
        "eer": "2 + v / 8",
        "run_hours": "1000 + e * CAST(0.25 AS DOUBLE)",
        "start_stop_count": "CAST(e AS DOUBLE)",
        "run_status": "CASE WHEN k IN ('click', 'view') THEN 1 ELSE 0 END",
    },
    1: {
        "water_inlet_temperature_c": "10 + v / 8",
        "water_outlet_temperature_c": "12 + v / 16",
        "fan_speed_rpm": "v * 8",
        "heat_rejection_efficiency_pct": "v / 2",
        "approach_temperature_c": "v / 16 - 5.25",
        "power_consumption_kw": "CASE WHEN k <> 'signup' THEN v / 4 END",
    },
    2: {
        "cooling_capacity_tr": "v * 4",
        "entering_chilled_water_temperature_c": "5 + v / 8",
        "leaving_chilled_water_temperature_c": "v / 4",
        "temperature_difference_c": "5 - v / 8",
        "heat_transfer_efficiency_pct": "v / 2",
        "lwt_setpoint_c": "2 + v / 64",
        "pump_power_consumption_kw": "CASE WHEN k <> 'signup' THEN v / 2 END",
        "water_flow_rate_gpm": "v * 8",
    },
    3: {
        "valve_opening_pct": "v / 2",
        "superheat_c": "v / 8",
        "subcooling_c": "v / 8",
        "target_superheat_c": "6 + v / 64",
        "inlet_pressure_kpa": "400 + v",
        "outlet_pressure_kpa": "100 + v * 4",
        "refrigerant_flow_rate_kg_min": "v / 4",
        "power_consumption_w": "CASE WHEN k <> 'signup' THEN FLOOR(v / 32) * 15.625 END",
    },
}
TYPES = ("compressor", "condenser", "evaporator", "expansion_valve")
ALL_SENSORS = tuple(dict.fromkeys(c for s in SENSORS.values() for c in s))

_STATE = {
    "component_id": "concat('C-', CAST(u AS STRING))",
    "hvac_machine_id": "concat('HVAC-', CAST(m AS STRING))",
    "location_id": "concat('LOC-', CAST(m % 3 AS STRING))",
    "health_status": "CASE k WHEN 'error' THEN 'Critical' WHEN 'purchase' THEN 'Warning' "
                     "ELSE 'Healthy' END",
    "health_active_fault_code": "CAST(CASE k WHEN 'error' THEN 288 + e % 3 WHEN 'purchase' "
                                "THEN 420 END AS DOUBLE)",
    "data_quality": "CASE WHEN v < 5 THEN 'STALE' WHEN v < 20 THEN 'PARTIAL' ELSE 'GOOD' END",
}

# The gate sees text sensors and rows with something wrong in every field a rule looks at.
_DIRTY = {
    "event_id": "concat('E-', CAST(e AS STRING))",
    "timestamp": "CASE WHEN v >= 150 AND v < 155 THEN NULL WHEN v >= 155 AND v < 160 THEN 0 "
                 f"WHEN v >= 160 AND v < 165 THEN t + {FAR_FUTURE_MS} ELSE t END",
    "location_id": "CASE WHEN v >= 60 AND v < 62 THEN NULL WHEN v >= 62 AND v < 64 THEN '' "
                   "ELSE concat('LOC-', CAST(m % 3 AS STRING)) END",
    "health_status": "CASE WHEN v >= 70 AND v < 72 THEN 'Degraded' WHEN v >= 72 AND v < 74 "
                     "THEN NULL WHEN k = 'error' THEN 'Critical' ELSE 'Healthy' END",
    "data_quality": "CASE WHEN v >= 40 AND v < 45 THEN NULL WHEN v < 5 THEN 'STALE' "
                    "ELSE 'GOOD' END",
}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _spark_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").selectExpr(
        "event_id AS e", "user_id AS u", "user_id div 8 AS m", "event_type AS k",
        "CAST(user_id % 4 AS INT) AS c", "floor(value * 4) / CAST(4 AS DOUBLE) AS v",
        "unix_millis(CAST(ts AS TIMESTAMP)) AS t")


def _sql_base() -> str:
    return ("SELECT event_id AS e, user_id AS u, user_id // 8 AS m, event_type AS k, "
            "CAST(user_id % 4 AS INT) AS c, floor(value * 4) / CAST(4 AS DOUBLE) AS v, "
            "epoch_us(ts) // 1000 AS t FROM events")


def _spark_expr(expression: str) -> Column:
    return F.expr(expression.replace("15.625", "CAST(15.625 AS DOUBLE)")
                  .replace("5.25", "CAST(5.25 AS DOUBLE)"))


def _sql_expr(expression: str) -> str:
    return expression.replace("AS STRING", "AS VARCHAR")


def _sensor_case(column: str) -> str:
    branches = " ".join(f"WHEN {i} THEN CAST({s[column]} AS DOUBLE)"
                        for i, s in SENSORS.items() if column in s)
    return f"CASE c {branches} END"


def _type_case() -> str:
    return "CASE c " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(TYPES)) + " END"


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean readings of all components with numeric sensors and normalised columns."""
    base = _spark_base(spark, sf_dir)
    columns = {"event_id": "concat('E-', CAST(e AS STRING))", "timestamp": "t",
               "component_type": _type_case(), **_STATE,
               **{c: _sensor_case(c) for c in ALL_SENSORS}}
    from gaugeline.operators.reshape import with_component_hour, with_event_date
    rows = base.select(*[_spark_expr(x).alias(n) for n, x in columns.items()])
    return with_component_hour(with_event_date(rows))


def component(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Readings of one component with its own sensor columns only."""
    index = TYPES.index(kind)
    foreign = [c for c in ALL_SENSORS if c not in SENSORS[index]]
    return telemetry(spark, sf_dir).filter(F.col("component_type") == kind).drop(*foreign)


def telemetry_sql() -> str:
    """CTE ``telemetry``, the SQL twin of :func:`telemetry` with power in kW."""
    columns = {"event_id": "concat('E-', CAST(e AS STRING))", "timestamp": "t",
               "date": "CAST(make_timestamp(t * 1000) AS DATE)",
               "hour": "CAST(extract(hour FROM make_timestamp(t * 1000)) AS INT)",
               "component_type": _type_case(), **_STATE,
               **{c: _sensor_case(c) for c in ALL_SENSORS}}
    body = ", ".join(f"{_sql_expr(x)} AS {n}" for n, x in columns.items())
    return (f"base AS ({_sql_base()}), raw AS (SELECT {body} FROM base), "
            "telemetry AS (SELECT *, CASE component_type WHEN 'evaporator' THEN "
            "pump_power_consumption_kw WHEN 'expansion_valve' THEN power_consumption_w / 1000.0 "
            "ELSE power_consumption_kw END AS power_kw, health_status IN ('Critical', 'Warning') "
            "AS faulty FROM raw)")


def redelivered(base: DataFrame) -> DataFrame:
    """Every reading, and those of type ``signup`` once more a minute later."""
    times = F.expr("explode(CASE WHEN k = 'signup' THEN array(t, t + 60000) ELSE array(t) END)")
    return base.select(*[c for c in base.columns if c != "t"], times.alias("t"))


def dirty(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Staging rows of one component: text sensors, faults in every field, repeated ids.

    Readings of type ``signup`` arrive a second time, a minute later, under the same event id.
    """
    index = TYPES.index(kind)
    base = _spark_base(spark, sf_dir).filter(F.col("c") == index)
    base = redelivered(base)
    columns = {**{n: x for n, x in _STATE.items() if n not in _DIRTY}, **_DIRTY}
    rows = [_spark_expr(x).alias(n) for n, x in columns.items()]
    sensors = [F.when((F.col("v") >= 30) & (F.col("v") < 31), "n/a")
               .otherwise(_spark_expr(f"CAST({x} AS DOUBLE)").cast("string")).alias(n)
               for n, x in SENSORS[index].items()]
    return base.select(*rows, *sensors, F.lit(kind).alias("component_type"))


def dirty_sql(kind: str) -> str:
    """CTE body for :func:`dirty`; unreadable sensor text is NULL here."""
    index = TYPES.index(kind)
    columns = {**{n: x for n, x in _STATE.items() if n not in _DIRTY}, **_DIRTY}
    body = ", ".join(f"{_sql_expr(x)} AS {n}" for n, x in columns.items())
    sensors = ", ".join(f"CASE WHEN v >= 30 AND v < 31 THEN NULL ELSE CAST({x} AS DOUBLE) END "
                        f"AS {n}" for n, x in SENSORS[index].items())
    return (f"SELECT {body}, {sensors}, '{kind}' AS component_type FROM (SELECT * FROM base "
            f"WHERE c = {index} UNION ALL SELECT e, u, m, k, c, v, t + 60000 FROM base "
            f"WHERE c = {index} AND k = 'signup')")


def base_sql() -> str:
    return f"base AS ({_sql_base()})"
