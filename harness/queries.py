"""Registered queries and, for each, the same result in SQL."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline import schemas
from gaugeline.functions import date_of
from gaugeline.operators import (dedup, derived, dimensions, facts, kpis, ledger, merge, quality,
                                 registry, reshape, transitions)
from gaugeline.operators.rules import RULES
from gaugeline.plans.ingest import flatten_documents
from gaugeline.sources.reference_data import fault_entries, score_bands
from harness import telemetry as tm
from harness.layers import stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def register(fn):
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return register


def dated(df: DataFrame) -> DataFrame:
    """Dates as ISO text, so that both engines hand over the same type."""
    return df.withColumns({f.name: F.col(f.name).cast("string") for f in df.schema
                           if isinstance(f.dataType, T.DateType)})


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """For sums and means whose last bits depend on the order of addition."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


TELEMETRY = "WITH " + tm.telemetry_sql() + " "
SCORE = ("CASE WHEN {t} > 0 THEN greatest(0.0::DOUBLE, 100.0::DOUBLE - {c}::DOUBLE / {t} * 100 "
         "- {w}::DOUBLE / {t} * 50) ELSE 100.0::DOUBLE END")
DAY = "CAST(date AS VARCHAR) AS date"
GRAINS = {"daily": ("date", DAY), "hourly": ("date, hour", f"{DAY}, hour")}


# Raw documents -------------------------------------------------------------------------------

def documents(spark: SparkSession, sf_dir: str, types: int = 4) -> DataFrame:
    """JSON text of one raw document per event, with two, no or NULL readings."""
    base = tm._spark_base(spark, sf_dir)
    branches = " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(tm.TYPES))
    kind = F.expr(f"CASE u % {types} {branches} ELSE 'boiler' END")
    reading = F.transform(F.array(F.lit(0), F.lit(60000)), lambda shift: F.struct(
        F.concat(F.lit("E-"), F.col("e").cast("string"), F.lit("-"), shift.cast("string"))
        .alias("eventId"),
        (F.col("t") + shift).cast("string").alias("timestamp"), F.lit("B").alias("circuitId"),
        F.col("v").cast("string").alias("dischargePressureKpa"),
        F.lit("ON").alias("pumpRelay1Status"),
        F.expr("CASE WHEN k = 'error' THEN '288' END").alias("healthActiveFaultCode"),
        F.lit("Healthy").alias("healthStatus")))
    records = (F.when(F.col("k") == "signup", F.lit(None))
               .when(F.col("k") == "view", F.filter(reading, lambda _: F.lit(False)))
               .otherwise(reading))
    return base.select(F.to_json(F.struct(
        F.concat(F.lit("C-"), F.col("u").cast("string")).alias("componentId"),
        kind.alias("componentType"), F.lit("A").alias("circuitId"),
        F.concat(F.lit("HVAC-"), F.col("m").cast("string")).alias("hvacMachineId"),
        F.lit(60).alias("readingIntervalSeconds"), records.alias("records"))).alias("doc"))


def parsed(spark: SparkSession, sf_dir: str, types: int = 4) -> DataFrame:
    docs = documents(spark, sf_dir, types)
    return docs.select(F.from_json("doc", schemas.raw_schema()).alias("d")).select("d.*")


_READINGS = (f"WITH {tm.base_sql()}, readings AS (SELECT *, t + s AS rt, s FROM base, "
             "(VALUES (0), (60000)) shifts(s) WHERE k NOT IN ('signup', 'view')) ")


@query(_READINGS + """
    SELECT concat('E-', e, '-', s) AS event_id, rt AS timestamp, 'C-' || u AS component_id,
           'HVAC-' || m AS hvac_machine_id, 'A' AS circuit_id, 'ON' AS pump_relay1_status,
           CASE WHEN k = 'error' THEN 288.0::DOUBLE END AS health_active_fault_code,
           v AS discharge_pressure_kpa, CAST(60 AS BIGINT) AS reading_interval_seconds,
           CAST(CAST(make_timestamp(rt * 1000) AS DATE) AS VARCHAR) AS date FROM readings""")
def raw_documents_flattened(spark, sf_dir):
    """Parse, explode, flatten (envelope wins), date and rename raw documents."""
    flat = reshape.snake_case_columns(flatten_documents(parsed(spark, sf_dir)))
    return dated(reshape.cast_numeric(flat).select(
        "event_id", "timestamp", "component_id", "hvac_machine_id", "circuit_id",
        "pump_relay1_status", "health_active_fault_code", "discharge_pressure_kpa",
        "reading_interval_seconds", "date"))


@query(_READINGS + f"""
    SELECT CASE u % 6 WHEN 0 THEN 'compressor' WHEN 1 THEN 'condenser' WHEN 2 THEN 'evaporator'
           ELSE 'expansion_valve' END AS component_type, count(*) AS readings,
           CASE WHEN u % 6 = 0 THEN count(v) END AS pressures
    FROM readings WHERE u % 6 < 4 GROUP BY u % 6""")
def components_routed(spark, sf_dir):
    """Rows per component, without the fields of others; unknown component types fall away."""
    rows = reshape.route_in_place(flatten_documents(parsed(spark, sf_dir, types=6)))
    return (rows.groupBy(F.col("componentType").alias("component_type"))
            .agg(F.count("*").alias("readings"),
                 F.when(F.col("component_type") == "compressor", F.count("dischargePressureKpa"))
                 .alias("pressures")))


@query(f"""WITH {tm.base_sql()}
    SELECT 'E-' || e AS event_id, t AS timestamp, 'compressor' AS component_type,
           'REALTIME' AS ingestion_mode, v AS oil_pressure_kpa,
           CASE WHEN k <> 'view' THEN CAST(t AS VARCHAR) END AS event_timestamp FROM base""")
def payload_documents_flattened(spark, sf_dir):
    """The single-reading variant of the raw document."""
    docs = tm._spark_base(spark, sf_dir).select(F.to_json(F.struct(
        F.lit("REALTIME").alias("ingestionMode"),
        F.struct(F.concat(F.lit("E-"), F.col("e").cast("string")).alias("eventId"),
                 F.when(F.col("k") == "view", F.col("t")).alias("timestamp"),
                 F.when(F.col("k") != "view", F.col("t")).alias("eventTimestamp"),
                 F.lit("compressor").alias("componentType"),
                 F.col("v").cast("string").alias("oilPressureKpa")).alias("rawPayload")))
        .alias("doc"))
    flat = reshape.unwrap_payload(docs.select(
        F.from_json("doc", schemas.payload_schema()).alias("d")).select("d.*"))
    return reshape.snake_case_columns(reshape.with_event_date(flat)).select(
        "event_id", "timestamp", "component_type", "ingestion_mode", "event_timestamp",
        F.col("oil_pressure_kpa").try_cast("double").alias("oil_pressure_kpa"))


@query(f"""WITH {tm.base_sql()}
    SELECT 'E-' || e AS event_id, '1.' || (e % 4) AS schema_version, 'expansion_valve' AS component_type, 'LOC-' || (m % 3)
           AS location_id, 'B' AS location_building, k AS health_active_fault_code,
           v AS inlet_pressure_kpa, v AS refrigerant_flow_rate_kg_min FROM base""")
def device_documents_flattened(spark, sf_dir):
    """The nested device document."""
    text = F.concat(F.lit("E-"), F.col("e").cast("string"))
    docs = tm._spark_base(spark, sf_dir).select(
        text.alias("eventId"), F.col("t").alias("timestamp"), F.lit("GOOD").alias("dataQuality"),
        F.concat(F.lit("1."), (F.col("e") % 4).cast("string")).alias("schemaVersion"),
        F.struct(F.concat(F.lit("LOC-"), (F.col("m") % 3).cast("string")).alias("locationId"),
                 F.lit("B").alias("building")).alias("location"),
        F.struct(F.lit("expansionValve").alias("componentType")).alias("component"),
        F.struct(F.lit("Healthy").alias("healthStatus"), F.col("k").alias("activeFaultCode"))
        .alias("health"),
        F.struct(F.col("v").alias("inletPressure_kPa"),
                 F.col("v").alias("refrigerantFlowRate_kg_min")).alias("telemetry"))
    return reshape.flatten_device_document(docs).select(
        "event_id", "schema_version", "component_type", "location_id", "location_building",
        "health_active_fault_code", "inlet_pressure_kpa", "refrigerant_flow_rate_kg_min")


# Projections ---------------------------------------------------------------------------------

@query(TELEMETRY + f"""SELECT {DAY}, count(*) AS readings FROM telemetry
    WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' GROUP BY date""")
def readings_in_date_range(spark, sf_dir):
    rows = reshape.between_dates(tm.telemetry(spark, sf_dir), "2024-01-05", "2024-01-25")
    return dated(rows.groupBy("date").agg(F.count("*").alias("readings")))


@query(f"""WITH {tm.base_sql()} SELECT e AS event_id,
    CASE WHEN k <> 'signup' THEN v END AS cop, v * 2 AS run_hours FROM base""")
def numeric_columns_cast(spark, sf_dir):
    text = tm._spark_base(spark, sf_dir).select(
        F.col("e").alias("event_id"),
        F.when(F.col("k") == "signup", "n/a").otherwise(F.col("v").cast("string")).alias("cop"),
        (F.col("v") * 2).cast("string").alias("run_hours"))
    return reshape.cast_numeric(text)


@query(TELEMETRY + """SELECT component_type, hour, count(*) AS readings FROM telemetry
    GROUP BY component_type, hour""")
def readings_per_hour_of_day(spark, sf_dir):
    return (tm.telemetry(spark, sf_dir).groupBy("component_type", "hour")
            .agg(F.count("*").alias("readings")))


@query(TELEMETRY + "SELECT event_id, component_type, power_kw AS power_consumption_kw FROM telemetry")
def power_normalised(spark, sf_dir):
    return reshape.normalise_power(tm.telemetry(spark, sf_dir)).select(
        "event_id", "component_type", "power_consumption_kw")


@query(TELEMETRY + """SELECT event_id, round(water_flow_rate_gpm * 3.785411784::DOUBLE, 3)
    AS water_flow_rate_lpm FROM telemetry WHERE component_type = 'evaporator'""")
def water_flow_converted(spark, sf_dir):
    return reshape.gpm_to_lpm(tm.component(spark, sf_dir, "evaporator")).select(
        "event_id", "water_flow_rate_lpm")


@query(TELEMETRY + """SELECT component_type, count(*) AS readings, count(cop) AS cops,
    count(cooling_capacity_tr) AS capacities, count(superheat_c) AS superheats
    FROM telemetry GROUP BY component_type""")
def components_united(spark, sf_dir):
    """Frames with different columns, aligned and put together."""
    frames = {c: tm.component(spark, sf_dir, c) for c in tm.TYPES}
    return reshape.union_components(frames).groupBy("component_type").agg(
        F.count("*").alias("readings"), F.count("cop").alias("cops"),
        F.count("cooling_capacity_tr").alias("capacities"),
        F.count("superheat_c").alias("superheats"))


# Quality gate --------------------------------------------------------------------------------

def checked(spark: SparkSession, sf_dir: str, kinds: Sequence[str] = tm.TYPES) -> DataFrame:
    """Components through their gate, on the columns they share."""
    shared = ["event_id", "timestamp", "component_type", "component_id", "location_id",
              "health_status", "data_quality", "is_valid", "failure_reason"]
    return reshape.union_components({
        c: quality.apply_quality_rules(tm.dirty(spark, sf_dir, c), RULES[c], tm.NOW_MS)
        .select(*shared) for c in kinds})


def _gate_sql(kind: str) -> str:
    """The rules of one component spelled out; a CASE without ELSE is skipped by concat_ws."""
    rules, columns = RULES[kind], [*tm.SENSORS[tm.TYPES.index(kind)]]
    cases = ["CASE WHEN rn > 1 THEN 'Duplicate event_id' END",
             "CASE WHEN data_quality NOT IN ('GOOD', 'PARTIAL') THEN 'Bad data_quality' END"]
    cases += [f"CASE WHEN {f} IS NULL OR CAST({f} AS VARCHAR) = '' THEN "
              f"'Null mandatory field: {f}' END" for f in rules.mandatory]
    cases += ["CASE WHEN timestamp IS NULL OR timestamp <= 0 THEN 'Invalid timestamp' END",
              f"CASE WHEN timestamp > {tm.NOW_MS + 365 * 86_400_000} THEN 'Future timestamp' END"]
    cases += [f"CASE WHEN {f} < {lo} OR {f} > {hi} THEN 'Out of range: {f}' END"
              for f, (lo, hi) in rules.ranges.items() if f in columns]
    cases += [f"CASE WHEN {a} + {n} <= {b} THEN 'Cross field error: {a} > {b}' END"
              for a, b, n in rules.greater if a in columns and b in columns]
    cases += ["CASE WHEN health_status NOT IN ('Healthy', 'Warning', 'Critical') THEN "
              "'Invalid health_status' END"]
    return (f"SELECT event_id, timestamp, component_type, component_id, location_id, "
            f"health_status, data_quality, concat_ws(' | ', {', '.join(cases)}) AS failure_reason "
            f"FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY timestamp DESC "
            f"NULLS LAST) AS rn FROM ({tm.dirty_sql(kind)}))")


CHECKED = (f"WITH {tm.base_sql()}, gate AS (" + " UNION ALL ".join(_gate_sql(c) for c in tm.TYPES)
           + "), checked AS (SELECT *, failure_reason = '' AS is_valid FROM gate) ")


@query(CHECKED + """SELECT event_id, timestamp, component_type, component_id, location_id,
    health_status, data_quality, is_valid, failure_reason FROM checked""")
def quality_gate_rows(spark, sf_dir):
    return checked(spark, sf_dir)


@query(CHECKED + """SELECT component_type, reason, count(*) AS rows_failed FROM (
    SELECT component_type, unnest(string_split(failure_reason, ' | ')) AS reason
    FROM checked WHERE NOT is_valid) GROUP BY component_type, reason""")
def quality_reason_counts(spark, sf_dir):
    """How often each rule fails, per component."""
    _, invalid = quality.split_valid(checked(spark, sf_dir))
    return (invalid.select("component_type", F.explode(F.split("failure_reason", r" \| "))
                           .alias("reason"))
            .groupBy("component_type", "reason").agg(F.count("*").alias("rows_failed")))


@query(CHECKED + """SELECT count(*) AS total_records, count(*) FILTER (is_valid) AS valid_records,
    count(*) FILTER (NOT is_valid) AS invalid_records FROM checked""")
def quality_gate_counts(spark, sf_dir):
    return quality.gate_counts(checked(spark, sf_dir))


@query(CHECKED + """SELECT event_id, timestamp, component_type, component_id, location_id,
    health_status, data_quality FROM checked WHERE is_valid""")
def valid_readings(spark, sf_dir):
    return quality.split_valid(checked(spark, sf_dir))[0]


@query(f"""WITH {tm.base_sql()}, rows_ AS (SELECT e, t FROM base UNION ALL
      SELECT e, t + 60000 FROM base WHERE k = 'signup')
    SELECT e AS event_id, t AS timestamp, row_number() OVER (PARTITION BY e ORDER BY t DESC) > 1
      AS is_duplicate FROM rows_""")
def duplicates_flagged(spark, sf_dir):
    rows = tm.redelivered(tm._spark_base(spark, sf_dir))
    return dedup.flag_duplicates(rows.select(F.col("e").alias("event_id"),
                                             F.col("t").alias("timestamp")))


# Fault onsets --------------------------------------------------------------------------------

_ONSETS = TELEMETRY + """, lagged AS (SELECT *, lag(faulty) OVER (PARTITION BY component_id
    ORDER BY timestamp) AS before FROM telemetry), onsets AS (SELECT *,
    CASE WHEN faulty AND NOT coalesce(before, false) THEN 1 ELSE 0 END AS is_new_event FROM lagged)
    """


@query(_ONSETS + """SELECT event_id, component_id, timestamp, faulty AS is_faulty,
    CAST(is_new_event AS INT) AS is_new_event FROM onsets""")
def fault_onsets(spark, sf_dir):
    """Every reading with its onset flag."""
    return transitions.with_new_event(tm.telemetry(spark, sf_dir)).select(
        "event_id", "component_id", "timestamp", "is_faulty", "is_new_event")


# Facts ---------------------------------------------------------------------------------------

def _health_sql(grain: str) -> str:
    keys, shown = GRAINS[grain]
    events = ("CAST(sum(is_new_event) AS BIGINT) AS critical_event_count,"
              if grain == "daily" else "")
    score = SCORE.format(t="count(timestamp)",
                         c="count(*) FILTER (health_status = 'Critical')",
                         w="count(*) FILTER (health_status = 'Warning')")
    return _ONSETS + f"""SELECT {shown}, location_id, hvac_machine_id, component_id,
      component_type, count(timestamp) AS total_readings,
      count(*) FILTER (health_status = 'Critical') AS critical_readings,
      count(*) FILTER (health_status = 'Warning') AS warning_readings, {events}
      CAST(coalesce(max(health_active_fault_code), 0) AS INT) AS critical_reading_code,
      {score} AS health_score_pct
      FROM onsets GROUP BY {keys}, location_id, hvac_machine_id, component_id, component_type"""


def _energy_sql(grain: str) -> str:
    keys, shown = GRAINS[grain]
    return f"""SELECT {keys}, location_id, hvac_machine_id, component_id, component_type,
      sum(power_kw) / count(power_kw) AS avg_power_kw, max(power_kw) AS max_power_kw,
      min(power_kw) AS min_power_kw, count(power_kw) AS total_readings,
      CASE WHEN max(timestamp) > min(timestamp)
        THEN (max(timestamp) - min(timestamp))::DOUBLE / 1000 / 3600
        ELSE 5.0::DOUBLE / 60 END AS duration_hours
      FROM telemetry WHERE power_kw IS NOT NULL
      GROUP BY {keys}, location_id, hvac_machine_id, component_id, component_type"""


def _alerts_sql(grain: str) -> str:
    keys, shown = GRAINS[grain]
    return f"""SELECT {keys}, location_id, hvac_machine_id,
      count(*) FILTER (health_status = 'Critical') AS total_critical_alerts,
      count(*) FILTER (health_status = 'Warning') AS total_warning_alerts,
      count(DISTINCT CASE WHEN health_active_fault_code > 0 THEN health_active_fault_code END)
        AS unique_fault_codes
      FROM telemetry GROUP BY {keys}, location_id, hvac_machine_id"""


_PERFORMANCE = """SELECT date, location_id, hvac_machine_id, max(h) AS max_run_hours,
      max(s) AS max_start_stops, avg(cop) AS avg_cop, avg(eer) AS avg_eer FROM (
        SELECT date, location_id, hvac_machine_id, component_id, max(run_hours) - min(run_hours)
          AS h, max(start_stop_count) - min(start_stop_count) AS s, avg(cop) AS cop,
          avg(eer) AS eer FROM telemetry WHERE component_type = 'compressor'
        GROUP BY date, location_id, hvac_machine_id, component_id)
      GROUP BY date, location_id, hvac_machine_id"""
_ONE_DATE = "* REPLACE (CAST(date AS VARCHAR) AS date)"


def _powered(spark, sf_dir) -> DataFrame:
    return reshape.normalise_power(tm.telemetry(spark, sf_dir))


for _grain in GRAINS:
    _energy = "daily_energy_kwh" if _grain == "daily" else "hourly_energy_kwh"
    query(_health_sql(_grain), f"component_health_{_grain}")(
        lambda spark, sf_dir, g=_grain: dated(facts.component_health(
            tm.telemetry(spark, sf_dir), g)))
    query(TELEMETRY + f"SELECT {_ONE_DATE}, avg_power_kw * duration_hours AS {_energy} FROM "
          f"({_energy_sql(_grain)})", f"energy_consumption_{_grain}")(
        lambda spark, sf_dir, g=_grain: dated(facts.energy_consumption(_powered(spark, sf_dir), g)))
    query(TELEMETRY + f"SELECT {_ONE_DATE} FROM ({_alerts_sql(_grain)})",
          f"machine_alerts_{_grain}")(
        lambda spark, sf_dir, g=_grain: dated(facts.machine_alerts(tm.telemetry(spark, sf_dir), g)))
    for _kind, _metrics in facts.METRIC_FAMILIES.items():
        _columns = ", ".join(f"avg({m}) AS avg_{m}, max({m}) AS max_{m}" for m in _metrics)
        query(TELEMETRY + f"""SELECT {GRAINS[_grain][1]}, location_id, hvac_machine_id,
            component_id, {_columns} FROM telemetry WHERE component_type = '{_kind}'
            GROUP BY {GRAINS[_grain][0]}, location_id, hvac_machine_id, component_id""",
              f"{_kind}_metrics_{_grain}")(
            lambda spark, sf_dir, g=_grain, k=_kind, m=_metrics: dated(
                facts.metric_rollup(tm.component(spark, sf_dir, k), m, g)))


@query(TELEMETRY + f"SELECT {_ONE_DATE} FROM ({_PERFORMANCE})")
def machine_performance_daily(spark, sf_dir):
    return dated(facts.machine_performance_daily(tm.component(spark, sf_dir, "compressor")))


@query(TELEMETRY + f"""SELECT {_ONE_DATE}, avg_power_kw * duration_hours AS daily_energy_kwh
    FROM ({_energy_sql('daily')})""")
def energy_daily_from_hourly_parts(spark, sf_dir):
    """The daily fact by way of the hourly partial aggregates the gold job stores."""
    parts = reshape.union_components({
        c: facts.component_parts(reshape.prepare_telemetry(tm.component(spark, sf_dir, c), c), c)
        for c in tm.TYPES})
    return dated(facts.energy_from_parts(parts, "daily"))


# KPIs ----------------------------------------------------------------------------------------

_MACHINES = f"""machines AS (SELECT date, location_id, hvac_machine_id,
      count(*) AS total_readings, count(*) FILTER (health_status = 'Critical')
      AS critical_readings, count(*) FILTER (health_status = 'Warning') AS warning_readings
      FROM telemetry GROUP BY date, location_id, hvac_machine_id), scored AS (SELECT *,
      {SCORE.format(t='total_readings', c='critical_readings', w='warning_readings')}
      AS machine_health_score FROM machines)"""
_BANDS = """SELECT date, count(*) FILTER (machine_health_score >= 90) AS healthy_count,
      count(*) FILTER (machine_health_score >= 70 AND machine_health_score < 90) AS warning_count,
      count(*) FILTER (machine_health_score < 70) AS critical_count,
      avg(machine_health_score) AS avg_health_score FROM scored GROUP BY date"""
_ONLINE = """SELECT date, count(*) AS machines_online FROM (SELECT date, hvac_machine_id
      FROM telemetry WHERE component_type = 'compressor' GROUP BY date, hvac_machine_id
      HAVING max(run_status) > 0) GROUP BY date"""
_KPI = TELEMETRY + f""", {_MACHINES}, bands AS ({_BANDS}), online AS ({_ONLINE}),
    power AS (SELECT *, avg_power_kw * duration_hours AS kwh FROM ({_energy_sql('daily')})),
    alerts AS ({_alerts_sql('daily')}), performance AS ({_PERFORMANCE}) """


def _machines(spark, sf_dir) -> DataFrame:
    return kpis.machine_health(facts.component_states(tm.telemetry(spark, sf_dir)))


@query(_KPI + f"SELECT {_ONE_DATE} FROM online")
def machines_online(spark, sf_dir):
    rows = tm.telemetry(spark, sf_dir)
    return dated(kpis.machines_online(tm.component(spark, sf_dir, "compressor"), rows))


@query(TELEMETRY + f"""SELECT {DAY}, count(DISTINCT hvac_machine_id) AS machines_online
    FROM telemetry GROUP BY date""")
def machines_online_without_compressors(spark, sf_dir):
    return dated(kpis.machines_online(None, tm.telemetry(spark, sf_dir)))


@query(_KPI + f"SELECT {_ONE_DATE} FROM scored")
def machine_health(spark, sf_dir):
    return dated(_machines(spark, sf_dir))


@query(_KPI + f"""SELECT * REPLACE (CAST(date AS VARCHAR) AS date,
    round(avg_health_score, 6) AS avg_health_score) FROM bands""")
def fleet_health_bands(spark, sf_dir):
    return rounded(dated(kpis.fleet_bands(_machines(spark, sf_dir))), "avg_health_score")


@query(_KPI + f"""SELECT {_ONE_DATE}, CASE WHEN machine_health_score >= 90 THEN 'healthy'
    WHEN machine_health_score >= 70 THEN 'needs_check' WHEN machine_health_score >= 40
    THEN 'warning' ELSE 'critical' END AS score_band FROM scored""")
def machine_score_bands(spark, sf_dir):
    return dated(kpis.score_bands(_machines(spark, sf_dir)))


@query(_KPI + """SELECT CAST(date AS VARCHAR) AS date, location_id, hvac_machine_id,
      machine_health_score, arg_max(lower(r_name), r_regionkey) AS score_band
    FROM scored JOIN region ON r_regionkey * 15 + 40 <= machine_health_score
    GROUP BY date, location_id, hvac_machine_id, machine_health_score
    UNION ALL SELECT CAST(date AS VARCHAR), location_id, hvac_machine_id, machine_health_score, NULL
    FROM scored WHERE machine_health_score < 40""")
def machine_score_bands_of_dictionary(spark, sf_dir):
    """Labels by the bands of a fault dictionary, here one named after the regions."""
    entry = F.expr("named_struct('min', r_regionkey * 15 + 40, 'label', r_name)")
    document = tm.load(spark, sf_dir, "region").select(F.to_json(F.struct(F.create_map(
        F.lower("r_name"), entry).alias("health_score_thresholds"))).alias("doc"))
    bands = score_bands(document.select(F.from_json("doc", schemas.FAULT_DICTIONARY).alias("d"))
                        .select("d.*"))
    return dated(kpis.score_bands_of(_machines(spark, sf_dir), bands)).select(
        "date", "location_id", "hvac_machine_id", "machine_health_score", "score_band")


@query(_KPI + """, presence AS (SELECT date, count(DISTINCT location_id) AS total_locations,
      count(DISTINCT hvac_machine_id) AS total_machines FROM telemetry GROUP BY date),
    energy AS (SELECT date, sum(kwh) AS e FROM power GROUP BY date),
    cops AS (SELECT date, avg(cop) AS c FROM telemetry WHERE component_type = 'compressor'
      GROUP BY date),
    faults AS (SELECT date, CAST(sum(total_critical_alerts) + sum(total_warning_alerts) AS BIGINT)
      AS f FROM alerts GROUP BY date)
    SELECT CAST(date AS VARCHAR) AS date, total_locations, total_machines,
      coalesce(machines_online, 0) AS machines_online, coalesce(healthy_count, 0) AS healthy_count,
      coalesce(warning_count, 0) AS warning_count, coalesce(critical_count, 0) AS critical_count,
      round(coalesce(avg_health_score, 0), 6) AS avg_health_score,
      round(coalesce(e, 0), 6) AS total_energy_kwh, round(coalesce(c, 0), 6) AS avg_cop,
      coalesce(f, 0) AS active_fault_count
    FROM presence LEFT JOIN online USING (date) LEFT JOIN bands USING (date)
      LEFT JOIN energy USING (date) LEFT JOIN cops USING (date) LEFT JOIN faults USING (date)""")
def fleet_summary_daily(spark, sf_dir):
    """From stored hourly parts: the readings are scanned once for all figures."""
    parts = _kpi_parts(spark, sf_dir)
    compressor = parts.filter(F.col("component_type") == "compressor")
    machines = kpis.machine_health_from_parts(parts)
    summary = kpis.fleet_summary(
        machines, kpis.online_from_parts(compressor), kpis.fleet_bands(machines),
        facts.energy_from_parts(parts), compressor, facts.alerts_from_parts(parts))
    return rounded(dated(summary), "avg_health_score", "total_energy_kwh", "avg_cop")


def _kpi_parts(spark, sf_dir) -> DataFrame:
    return stored(facts.kpi_parts(_powered(spark, sf_dir)), "kpi-parts")


@query(_KPI + """SELECT CAST(date AS VARCHAR) AS date, location_id,
      round(coalesce(sum(kwh) FILTER (component_type = 'compressor'), 0), 6)
        AS compressor_power_kwh,
      round(coalesce(sum(kwh) FILTER (component_type = 'condenser'), 0), 6)
        AS condenser_fan_power_kwh,
      round(coalesce(sum(kwh) FILTER (component_type = 'evaporator'), 0), 6) AS pump_power_kwh,
      round(coalesce(sum(kwh) FILTER (component_type = 'expansion_valve'), 0), 6)
        AS valve_power_kwh,
      round(sum(kwh), 6) AS total_power_consumption_kwh
    FROM power GROUP BY date, location_id""")
def location_energy_daily(spark, sf_dir):
    wide = kpis.location_energy(facts.energy_consumption(_powered(spark, sf_dir)))
    return rounded(dated(wide), *kpis.ENERGY_COLUMNS.values(), "total_power_consumption_kwh")


@query(_KPI + """, place AS (SELECT date, location_id, avg(machine_health_score) AS s,
      count(DISTINCT hvac_machine_id) AS machines_count FROM scored GROUP BY date, location_id),
    faults AS (SELECT date, location_id, CAST(sum(unique_fault_codes) AS BIGINT) AS f FROM alerts
      GROUP BY date, location_id),
    cops AS (SELECT date, location_id, avg(avg_cop) AS c FROM performance
      GROUP BY date, location_id)
    SELECT CAST(date AS VARCHAR) AS date, location_id, round(s, 6) AS avg_health_score,
      machines_count, coalesce(f, 0) AS total_fault_events,
      round(coalesce(c, 0), 6) AS avg_location_cop
    FROM place LEFT JOIN faults USING (date, location_id)
      LEFT JOIN cops USING (date, location_id)""")
def location_performance_summary(spark, sf_dir):
    """From the same parts."""
    parts = _kpi_parts(spark, sf_dir)
    summary = kpis.location_performance(
        kpis.machine_health_from_parts(parts), facts.alerts_from_parts(parts),
        facts.performance_from_parts(parts.filter(F.col("component_type") == "compressor")))
    return rounded(dated(summary), "avg_health_score", "avg_location_cop")


# Dimensions ----------------------------------------------------------------------------------

_SHIPPED_MACHINES = ("machines AS (SELECT s, p_partkey, p_brand, p_type, p_size FROM (SELECT DISTINCT "
             "l_suppkey AS s, l_partkey FROM lineitem) JOIN part ON p_partkey = l_partkey), "
             "owners AS (SELECT c_nationkey, min(c_custkey) AS owner FROM customer "
             "GROUP BY c_nationkey) ")


def _shipped_machines(spark, sf_dir) -> DataFrame:
    """A machine for every part that a supplier ships."""
    shipped = tm.load(spark, sf_dir, "lineitem").selectExpr("l_suppkey AS s", "l_partkey").distinct()
    return shipped.join(tm.load(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))


def _topology(spark, sf_dir) -> dict[str, DataFrame]:
    """Companies from customers, sites from suppliers, owned by a customer of their nation, and a
    machine for every part that a supplier ships."""
    company = tm.load(spark, sf_dir, "customer").selectExpr(
        "concat('CUST-', c_custkey) AS companyId", "c_name AS companyName",
        "c_mktsegment AS industry", "CASE WHEN c_acctbal > 0 THEN 'Enterprise' ELSE 'SMB' END "
        "AS accountType")
    nations = tm.load(spark, sf_dir, "customer").groupBy("c_nationkey").agg(
        F.min("c_custkey").alias("owner"))
    location = tm.load(spark, sf_dir, "supplier").join(
        nations, F.col("s_nationkey") == F.col("c_nationkey")).selectExpr(
        "concat('LOC-', s_suppkey) AS locationId", "concat('CUST-', owner) AS companyId",
        "s_name AS locationName", "concat('City ', s_nationkey) AS city", "'' AS state",
        "'USA' AS country")
    machine = _shipped_machines(spark, sf_dir).selectExpr(
        "concat('HVAC-', s, '-', p_partkey) AS hvacMachineId", "concat('LOC-', s) AS locationId",
        "p_brand AS manufacturer", "p_type AS model")
    return {"customers": company, "locations": location, "hvac_machines": machine}


@query("""SELECT concat('CUST-', c_custkey) AS company_id, c_name AS company_name, c_mktsegment
    AS industry, CASE WHEN c_acctbal > 0 THEN 'Enterprise' ELSE 'SMB' END AS account_type
    FROM customer""")
def dim_company(spark, sf_dir):
    return dimensions.dim_company(_topology(spark, sf_dir)["customers"])


@query("WITH " + _SHIPPED_MACHINES + """SELECT concat('LOC-', s_suppkey) AS location_id,
    concat('CUST-', owner) AS company_id, s_name AS location_name,
    concat('City ', s_nationkey) AS city, '' AS state, 'USA' AS country
    FROM supplier JOIN owners ON c_nationkey = s_nationkey""")
def dim_location(spark, sf_dir):
    return dimensions.dim_location(_topology(spark, sf_dir)["locations"])


@query("WITH " + _SHIPPED_MACHINES + """SELECT concat('HVAC-', s, '-', p_partkey) AS hvac_machine_id,
    concat('LOC-', s) AS location_id, p_brand AS manufacturer, p_type AS model FROM machines""")
def dim_hvac_machine(spark, sf_dir):
    return dimensions.dim_hvac_machine(_topology(spark, sf_dir)["hvac_machines"])


def _fault_codes(spark, sf_dir) -> DataFrame:
    """One dictionary document per part, its key the part number."""
    entry = F.expr("named_struct('fault_id', concat('F-', p_partkey), 'label', p_name, "
                   "'component_type', p_type, 'severity', CASE WHEN p_size > 25 THEN 'CRITICAL' "
                   "END, 'description', p_brand, 'recommended_action', CAST(NULL AS STRING))")
    documents_ = tm.load(spark, sf_dir, "part").select(F.to_json(F.struct(F.create_map(
        F.col("p_partkey").cast("string"), entry).alias("codes"))).alias("doc"))
    read = documents_.select(F.from_json("doc", schemas.FAULT_DICTIONARY).alias("d")).select("d.*")
    return dimensions.dim_fault_code(fault_entries(read))


@query("""SELECT p_partkey AS fault_code_key, CAST(p_partkey AS VARCHAR) AS fault_code,
    p_type AS component_type, p_name AS fault_description, p_brand AS threshold_description,
    CASE WHEN p_size > 25 THEN 'CRITICAL' ELSE '' END AS severity, '' AS recommended_action,
    true AS is_active FROM part""")
def dim_fault_code(spark, sf_dir):
    return _fault_codes(spark, sf_dir)


@query(TELEMETRY + """SELECT event_id, fault_code_key FROM telemetry LEFT JOIN
    (SELECT p_partkey AS fault_code_key FROM part) ON fault_code_key = health_active_fault_code""")
def fault_code_keys(spark, sf_dir):
    return dimensions.with_fault_code_key(
        tm.telemetry(spark, sf_dir), _fault_codes(spark, sf_dir)).select("event_id",
                                                                        "fault_code_key")


@query(TELEMETRY + """SELECT component_id, hvac_machine_id, component_type,
    arg_max(event_id, timestamp) AS component_serial_number FROM telemetry
    GROUP BY component_id, hvac_machine_id, component_type""")
def dim_component(spark, sf_dir):
    rows = tm.telemetry(spark, sf_dir).withColumn("component_serial_number", F.col("event_id"))
    return dimensions.dim_component(rows)


@query(TELEMETRY + f"""SELECT DISTINCT {DAY}, CAST(year(date) AS INT) AS year,
    CAST(quarter(date) AS INT) AS quarter, CAST(month(date) AS INT) AS month,
    CAST(day(date) AS INT) AS day, CAST(dayofweek(date) + 1 AS INT) AS day_of_week,
    dayofweek(date) IN (0, 6) AS is_weekend FROM telemetry""")
def dim_date(spark, sf_dir):
    return dated(dimensions.dim_date(tm.telemetry(spark, sf_dir)))


# Merges --------------------------------------------------------------------------------------

@query("""SELECT event_id, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN value ELSE value + 1 END
    AS value, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'first' ELSE 'second' END AS delivery
    FROM events""")
def insert_only_merge(spark, sf_dir):
    """Everything is delivered again; what the first half-month brought stays untouched."""
    rows = tm.load(spark, sf_dir, "events")
    target = rows.filter("ts < TIMESTAMP_NTZ '2024-01-16 00:00:00'").select(
        "event_id", "value", F.lit("first").alias("delivery"))
    source = rows.select("event_id", (F.col("value") + 1).alias("value"),
                         F.lit("second").alias("delivery"))
    return merge.insert_only(target, source, ["event_id"])


@query(TELEMETRY + """, days AS (SELECT date, component_id, count(*) AS n FROM telemetry
      GROUP BY date, component_id)
    SELECT CAST(date AS VARCHAR) AS date, component_id,
      CASE WHEN date >= DATE '2024-01-10' THEN n * 10 ELSE n END AS readings,
      CASE WHEN date <= DATE '2024-01-20' THEN n END AS first_readings,
      CASE WHEN date >= DATE '2024-01-10' THEN 'second' END AS run FROM days""")
def upsert_merge(spark, sf_dir):
    """Two overlapping runs; each side has a column the other lacks."""
    days = (tm.telemetry(spark, sf_dir).groupBy("date", "component_id")
            .agg(F.count("*").alias("n")))
    target = days.filter("date <= DATE '2024-01-20'").select(
        "date", "component_id", F.col("n").alias("readings"), F.col("n").alias("first_readings"))
    source = days.filter("date >= DATE '2024-01-10'").select(
        "date", "component_id", (F.col("n") * 10).alias("readings"), F.lit("second").alias("run"))
    return dated(merge.upsert(target, source, ["date", "component_id"]))


@query(CHECKED + """, invalid AS (SELECT * FROM checked WHERE NOT is_valid)
    SELECT event_id, timestamp, component_type, failure_reason FROM invalid
    WHERE component_type IN ('compressor', 'condenser') UNION ALL
    SELECT event_id, timestamp, component_type, failure_reason FROM invalid i
    WHERE component_type NOT IN ('compressor', 'condenser')""")
def dead_letter_merge(spark, sf_dir):
    """Rejected rows of two components are stored, then all are sent; none is stored twice."""
    def rejected(*kinds: str) -> DataFrame:
        _, invalid = quality.split_valid(checked(spark, sf_dir, kinds))
        return invalid.select("event_id", "timestamp", "component_type", "failure_reason")

    return merge.insert_only(rejected("compressor", "condenser"), rejected(*tm.TYPES), ["event_id"])


# Ledger --------------------------------------------------------------------------------------

def _raw_paths(spark, sf_dir) -> DataFrame:
    """A raw path per shipment, some of them in folders that are no dates."""
    folder = ("CASE WHEN l_returnflag = 'A' THEN concat('day', day(l_shipdate) + 31) "
              "WHEN l_linenumber = 1 THEN 'daily' ELSE concat('day', day(l_shipdate)) END")
    month = f"element_at(array({', '.join(repr(m) for m in ledger.MONTHS)}), month(l_shipdate))"
    return tm.load(spark, sf_dir, "lineitem").selectExpr(
        f"concat_ws('/', 'raw', concat('location_', l_suppkey), year(l_shipdate), {month}, "
        f"{folder}, 'x.json') AS path")


_SHIPPED = ("shipped AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem "
            "WHERE l_returnflag <> 'A' AND l_linenumber <> 1), "
            "ordered AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders), "
            "asked AS (SELECT DISTINCT CAST(o_orderdate AS DATE) + CAST(unnest(range(0, "
            "1 + o_custkey % 3)) AS INT) AS date FROM orders) ")


def _ledger(spark, sf_dir) -> DataFrame:
    return tm.load(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("date")).distinct()


def _requests(spark, sf_dir) -> DataFrame:
    return tm.load(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("start"), (1 + F.col("o_custkey") % 3).alias("days"),
        "o_orderstatus")


@query(f"WITH {_SHIPPED} SELECT {DAY} FROM shipped")
def ledger_dates_discovered(spark, sf_dir):
    return dated(ledger.discover_dates(_raw_paths(spark, sf_dir)))


@query(f"""WITH {_SHIPPED}, merged AS (SELECT date FROM shipped UNION SELECT date FROM ordered)
    SELECT CAST(max(date) AS VARCHAR) AS latest_date, count(*) AS total_dates FROM merged""")
def ledger_reconciled(spark, sf_dir):
    return dated(ledger.ledger_state(ledger.reconcile(
        _ledger(spark, sf_dir), ledger.discover_dates(_raw_paths(spark, sf_dir)))))


@query(f"WITH {_SHIPPED} SELECT {DAY} FROM asked")
def ledger_requests_expanded(spark, sf_dir):
    return dated(ledger.expand(_requests(spark, sf_dir)))


@query(f"""WITH {_SHIPPED}, counted AS (SELECT count(*) AS requested_dates, count(s.date)
      AS present_dates FROM asked a LEFT JOIN shipped s ON a.date = s.date)
    SELECT requested_dates, present_dates, CASE WHEN present_dates = requested_dates THEN 'skip'
      WHEN present_dates > 0 THEN 'partial' ELSE 'proceed' END AS decision FROM counted""")
def ledger_overlap(spark, sf_dir):
    return ledger.overlap(ledger.expand(_requests(spark, sf_dir)),
                          ledger.discover_dates(_raw_paths(spark, sf_dir)))


@query(f"""WITH {_SHIPPED} SELECT CAST(max(date) + 1 AS VARCHAR) AS "start",
    CAST(max(date) + 7 AS VARCHAR) AS "end" FROM ordered""")
def ledger_next_window(spark, sf_dir):
    return dated(ledger.next_window(_ledger(spark, sf_dir), dt.date(2024, 2, 1), 7))


@query(f"""WITH {_SHIPPED}, runs AS (SELECT CAST(o_orderdate AS DATE) AS "start",
      1 + o_custkey % 3 AS days, o_orderstatus AS note FROM orders),
    merged AS (SELECT date FROM shipped UNION SELECT date FROM asked)
    SELECT 'dates' AS part, count(*) AS n, CAST(max(date) AS VARCHAR) AS latest FROM merged
    UNION ALL SELECT 'runs', count(*), CAST(max("start") AS VARCHAR) FROM runs""")
def ledger_run_recorded(spark, sf_dir):
    """Runs taken from the orders table, recorded on a ledger of shipment dates."""
    runs = tm.load(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("start"), (1 + F.col("o_custkey") % 3).alias("days"),
        F.col("o_orderstatus").alias("note"))
    dates, history = ledger.record_run(
        ledger.discover_dates(_raw_paths(spark, sf_dir)), None, runs)
    return dated(dates.agg(F.lit("dates").alias("part"), F.count("*").alias("n"),
                           F.max("date").alias("latest"))
                 .unionByName(history.agg(F.lit("runs").alias("part"), F.count("*").alias("n"),
                                          F.max("start").alias("latest"))))


@query("""SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS "start", o_orderstatus AS note,
      array_to_string(list_transform(range(0, 1 + o_custkey % 3), lambda i:
        CAST(CAST(o_orderdate AS DATE) + CAST(i AS INT) AS VARCHAR)), ',') AS dates_added
    FROM orders""")
def ledger_history_recorded(spark, sf_dir):
    """The whole history rows of the same runs, each with the dates it added."""
    runs = _requests(spark, sf_dir).withColumn("note", F.col("o_orderstatus"))
    _, history = ledger.record_run(None, None, runs.drop("o_orderstatus"))
    return dated(history.select("start", "note", F.array_join(
        F.transform("dates_added", lambda d: d.cast("string")), ",").alias("dates_added")))


# Fleet registry ------------------------------------------------------------------------------

def _registry(spark, sf_dir) -> DataFrame:
    """Small machines had their first compressor replaced; some swaps are not yet in force."""
    topology = _topology(spark, sf_dir)
    swaps = _shipped_machines(spark, sf_dir).filter("p_size <= 10").select(
        F.expr("concat('HVAC-', s, '-', p_partkey)").alias("hvac_machine_id"),
        F.lit("compressor").alias("component_type"), F.lit("A").alias("circuit_id"),
        F.concat(F.lit("NEW-"), F.col("p_partkey").cast("string")).alias("component_id"),
        F.expr("DATE '2024-01-01' + p_size").alias("effective_date"))
    return registry.component_registry(topology["hvac_machines"], topology["locations"],
                                       topology["customers"], swaps, dt.date(2024, 1, 6))


_REGISTRY = "WITH " + _SHIPPED_MACHINES + """, slots(component_type, prefix, circuit_id, suffix) AS (VALUES
      ('compressor', 'COMP', 'A', 'A'), ('compressor', 'COMP', 'B', 'B'),
      ('condenser', 'COND', NULL, ''), ('evaporator', 'EVAP', NULL, ''),
      ('expansion_valve', 'EXV', 'A', 'A'), ('expansion_valve', 'EXV', 'B', 'B')),
    registry AS (SELECT concat('HVAC-', s, '-', p_partkey) AS hvac_machine_id,
      concat('LOC-', s_suppkey) AS location_id, s_name AS location_name,
      concat('CUST-', c_custkey) AS company_id, c_name AS company_name, component_type, circuit_id,
      CASE WHEN component_type = 'compressor' AND circuit_id = 'A' AND p_size <= 5
        THEN concat('NEW-', p_partkey)
        ELSE format('{}-{:02d}{:02d}{}', prefix, s_suppkey, p_partkey, suffix) END AS component_id
      FROM machines JOIN supplier ON s_suppkey = s JOIN owners ON c_nationkey = s_nationkey
      JOIN customer ON c_custkey = owner, slots) """
_COUNTS = ", ".join(f"count(*) FILTER (component_type = '{c}') AS {c}_count" for c in tm.TYPES)


@query(_REGISTRY + """SELECT hvac_machine_id, location_id, company_id, company_name,
    component_type, circuit_id, component_id FROM registry""")
def component_registry(spark, sf_dir):
    return _registry(spark, sf_dir).select(
        "hvac_machine_id", "location_id", "company_id", "company_name", "component_type",
        "circuit_id", "component_id")


@query(_REGISTRY + f"""SELECT location_id, location_name, company_id, company_name,
    count(DISTINCT hvac_machine_id) AS machine_count, count(*) AS component_count, {_COUNTS}
    FROM registry GROUP BY location_id, location_name, company_id, company_name""")
def fleet_manifest(spark, sf_dir):
    return registry.fleet_manifest(_registry(spark, sf_dir))


@query(_REGISTRY + f"""SELECT count(DISTINCT location_id) AS location_count,
    count(DISTINCT hvac_machine_id) AS machine_count, count(*) AS component_count, {_COUNTS}
    FROM registry""")
def fleet_totals(spark, sf_dir):
    return registry.fleet_totals(registry.fleet_manifest(_registry(spark, sf_dir)))


# Derived columns -----------------------------------------------------------------------------

def _faulted(spark, sf_dir, kind: str) -> DataFrame:
    rows = tm.component(spark, sf_dir, kind)
    return dimensions.with_fault_code_key(rows, _fault_codes(spark, sf_dir))


_KEYED = TELEMETRY + (", keyed AS (SELECT * FROM telemetry LEFT JOIN (SELECT p_partkey AS "
                      "fault_code_key FROM part) ON fault_code_key = health_active_fault_code) ")


@query(_KEYED + """SELECT event_id, health_status = 'Healthy' AS is_running,
    discharge_pressure_kpa / nullif(suction_pressure_kpa, 0) AS pressure_ratio,
    discharge_temperature_c - suction_temperature_c AS temperature_rise_c,
    fault_code_key IS NOT NULL AS is_faulted FROM keyed WHERE component_type = 'compressor'""")
def compressor_derived_columns(spark, sf_dir):
    rows = _faulted(spark, sf_dir, "compressor").withColumn(
        "compressor_status", F.when(F.col("health_status") == "Healthy", "ON").otherwise("OFF"))
    return derived.compressor_derived(rows).select(
        "event_id", "is_running", "pressure_ratio", "temperature_rise_c", "is_faulted")


@query(_KEYED + """SELECT event_id, health_status = 'Healthy' AS is_running,
    health_status <> 'Critical' AS is_fan_running, fan_speed_rpm
      * (water_outlet_temperature_c - water_inlet_temperature_c) * 0.25::DOUBLE
      AS heat_rejection_kw, fault_code_key IS NOT NULL AS is_faulted
    FROM keyed WHERE component_type = 'condenser'""")
def condenser_derived_columns(spark, sf_dir):
    rows = _faulted(spark, sf_dir, "condenser").withColumns({
        "condenser_status": F.when(F.col("health_status") == "Healthy", "ON").otherwise("OFF"),
        "fan_status": F.when(F.col("health_status") == "Critical", "OFF").otherwise("ON"),
        "water_flow_rate_gpm": F.col("fan_speed_rpm")})
    return derived.condenser_derived(rows, 0.25).select(
        "event_id", "is_running", "is_fan_running", "heat_rejection_kw", "is_faulted")


@query(_KEYED + """SELECT event_id, health_status IN ('Healthy', 'Warning') AS is_pump_running,
    water_flow_rate_gpm * temperature_difference_c * 0.25::DOUBLE AS cooling_load_kw,
    leaving_chilled_water_temperature_c - lwt_setpoint_c AS setpoint_deviation_c,
    fault_code_key IS NOT NULL AS is_faulted FROM keyed WHERE component_type = 'evaporator'""")
def evaporator_derived_columns(spark, sf_dir):
    status = F.col("health_status")
    rows = _faulted(spark, sf_dir, "evaporator").withColumns({
        "pump_relay1_status": F.when(status == "Healthy", "ON").otherwise("OFF"),
        "pump_relay2_status": F.when(status == "Warning", "ON").otherwise("OFF")})
    return derived.evaporator_derived(rows, 0.25).select(
        "event_id", "is_pump_running", "cooling_load_kw", "setpoint_deviation_c", "is_faulted")


@query(_KEYED + """SELECT event_id, health_status = 'Healthy' AS is_active,
    superheat_c - target_superheat_c AS superheat_deviation_c,
    fault_code_key IS NOT NULL AS is_faulted FROM keyed WHERE component_type = 'expansion_valve'""")
def expansion_valve_derived_columns(spark, sf_dir):
    rows = _faulted(spark, sf_dir, "expansion_valve").withColumn(
        "valve_status", F.when(F.col("health_status") == "Healthy", "ACTIVE").otherwise("INACTIVE"))
    return derived.expansion_valve_derived(rows).select(
        "event_id", "is_active", "superheat_deviation_c", "is_faulted")


import harness.gate_limits  # noqa: E402,F401  registers itself
import harness.storage_queries  # noqa: E402,F401  registers queries of stored layers
