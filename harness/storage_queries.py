"""Registered queries over layers: written below the shared folder by the writers of the jobs, and read
back by their readers. The folders go when the application ends."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.operators import dimensions, documents, reshape
from gaugeline.plans import ingest, silver
from gaugeline.plans.concurrent import run_all
from gaugeline.sources import tables
from gaugeline.sources.reference_data import read_topology
from gaugeline.sources.scratch import Scratch
from gaugeline.sources.storage import join_path
from harness import telemetry as tm
from harness.layers import layer
from harness.queries import CHECKED, DAY, TELEMETRY, _topology, dated, query

_MIDDLE = "1705363200000"  # 2024-01-16T00:00:00Z


# Layers --------------------------------------------------------------------------------------

@query(f"""WITH {tm.base_sql()} SELECT e AS event_id,
    CAST(CAST(make_timestamp(t * 1000) AS DATE) AS VARCHAR) AS date,
    CASE WHEN t < {_MIDDLE} THEN floor(v) ELSE v END AS value,
    CASE WHEN t >= {_MIDDLE} THEN k END AS kind FROM base""")
def layer_appended(spark, sf_dir):
    """Two appends by date; the second brings a column and makes whole numbers floating ones."""
    path = join_path(layer(spark, "append"), "t")
    rows = reshape.with_event_date(tm._spark_base(spark, sf_dir).withColumn("timestamp", F.col("t")))
    tables.append(rows.filter(f"t < {_MIDDLE}").select(
        F.col("e").alias("event_id"), "date", F.floor("v").cast("int").alias("value")), path, ["date"])
    tables.append(rows.filter(f"t >= {_MIDDLE}").select(
        F.col("e").alias("event_id"), "date", F.col("v").alias("value"), F.col("k").alias("kind")),
        path, ["date"], rebalance=True)
    return dated(tables.read_table(spark, path)).select("event_id", "date", "value", "kind")


@query(f"""WITH {tm.base_sql()}, first AS (SELECT * FROM base WHERE t < {_MIDDLE})
    SELECT e AS event_id, v AS value, 'first' AS delivery FROM first UNION ALL
    SELECT CASE WHEN k <> 'signup' THEN e END, v + 1, 'second' FROM base
    WHERE k = 'signup' OR t >= {_MIDDLE}""")
def layer_merged(spark, sf_dir):
    """Everything is delivered again, some of it without its id: the first write of an id stays, rows
    without id are added."""
    path = join_path(layer(spark, "merge"), "t")
    rows = reshape.with_event_date(tm._spark_base(spark, sf_dir).withColumn("timestamp", F.col("t")))
    for delivery, condition, key, more in (
            ("first", f"t < {_MIDDLE}", F.col("e"), 0),
            ("second", "true", F.when(F.col("k") != "signup", F.col("e")), 1)):
        tables.merge_insert(rows.filter(condition).select(
            key.alias("event_id"), "date", (F.col("v") + more).alias("value"),
            F.lit(delivery).alias("delivery")), path, ["event_id"], ["date"],
            key_fixes_partition=True)
    return tables.read_table(spark, path).select("event_id", "value", "delivery")


@query(TELEMETRY + """, days AS (SELECT date, component_id, count(*) AS n FROM telemetry
      GROUP BY date, component_id)
    SELECT CAST(date AS VARCHAR) AS date, component_id,
      CASE WHEN date >= DATE '2024-01-10' THEN n * 0.5::DOUBLE ELSE n END AS readings,
      CASE WHEN date <= DATE '2024-01-20' THEN n END AS first_readings,
      CASE WHEN date >= DATE '2024-01-10' THEN 'second' END AS run FROM days""")
def layer_upserted(spark, sf_dir):
    """Two overlapping runs of a daily fact; the second changes a type and brings a column."""
    path = join_path(layer(spark, "upsert"), "t")
    days = (tm.telemetry(spark, sf_dir).groupBy("date", "component_id").agg(F.count("*").alias("n")))
    with Scratch(spark, "query") as scratch:
        tables.upsert(days.filter("date <= DATE '2024-01-20'").select(
            "date", "component_id", F.col("n").alias("readings"), F.col("n").alias("first_readings")),
            path, ["date", "component_id"], scratch, ["date"])
        tables.upsert(days.filter("date >= DATE '2024-01-10'").select(
            "date", "component_id", (F.col("n") * F.lit(0.5)).alias("readings"),
            F.lit("second").alias("run")), path, ["date", "component_id"], scratch, ["date"])
    return dated(tables.read_table(spark, path)).select(
        "date", "component_id", "readings", "first_readings", "run")


@query(CHECKED + """SELECT component_type, count(*) AS staged,
    count(*) FILTER (is_valid) AS valid, count(*) FILTER (NOT is_valid) AS dead,
    count(DISTINCT failure_reason) FILTER (NOT is_valid) AS reasons FROM checked
    GROUP BY component_type""")
def silver_job(spark, sf_dir):
    """Staging to silver and dead letters, run twice and once for a range without data."""
    root = layer(spark, "silver")
    staging, out = join_path(root, "staging"), join_path(root, "silver")
    run_all({kind: partial(tables.append, reshape.with_event_date(tm.dirty(spark, sf_dir, kind)),
                           join_path(staging, kind), ["date"], rebalance=True) for kind in tm.TYPES})
    for start in (None, None, "2030-01-01"):
        silver.staging_to_silver(spark, staging, out, start, now_ms=tm.NOW_MS)
    none = spark.createDataFrame([], "component_type string, failure_reason string")

    def rows(*where: str) -> DataFrame:
        found = (tables.read_table(spark, join_path(*where, kind)) for kind in tm.TYPES)
        frames = {n: df for n, df in enumerate(found) if df is not None}
        return reshape.union_components({-1: none, **frames})

    staged = rows(staging).groupBy("component_type").agg(F.count("*").alias("staged"))
    valid = rows(out).groupBy("component_type").agg(F.count("*").alias("valid"))
    dead = rows(out, silver.DEAD_LETTERS).groupBy("component_type").agg(
        F.count("*").alias("dead"), F.count_distinct("failure_reason").alias("reasons"))
    return staged.join(valid, "component_type", "left").join(dead, "component_type", "left").fillna(0)


@query("""SELECT 'company' AS kind, concat('CUST-', c_custkey) AS id, c_name AS name FROM customer
    UNION ALL SELECT 'location', concat('LOC-', s_suppkey), s_name FROM supplier
    JOIN (SELECT DISTINCT c_nationkey FROM customer) ON c_nationkey = s_nationkey""")
def topology_read(spark, sf_dir):
    """Companies and locations written as topology files, lists of objects, and read into dimensions."""
    root = layer(spark, "topology")
    for name, rows in _topology(spark, sf_dir).items():
        files = F.pmod(F.xxhash64(*rows.columns), F.lit(1 + rows.count() // 5_000)).alias("file")
        (rows.select(F.struct(*rows.columns).alias("r"), files).groupBy("file")
         .agg(F.to_json(F.collect_list("r")).alias("value"))
         .write.partitionBy("file").text(join_path(root, "topology", f"{name}.json")))
    read = read_topology(spark, root)
    company, place = dimensions.dim_company(read["customers"]), dimensions.dim_location(read["locations"])
    return company.select(F.lit("company").alias("kind"), F.col("company_id").alias("id"),
                          F.col("company_name").alias("name")).unionByName(
        place.select(F.lit("location").alias("kind"), F.col("location_id").alias("id"),
                     F.col("location_name").alias("name")))


# Raw texts -----------------------------------------------------------------------------------
# By the last digit of the event: 0 is cut off, 1 a list of one document, 2 has unknown fields, 3 a code
# as a number, 4 is no JSON, 5 a single reading; the others are plain.

def _record(shift: int) -> str:
    return (f"concat('{{\"eventId\":\"E-', e, '-{shift}\",\"timestamp\":\"', t + {shift}, '\",\"cop\":\"', v, "
            "'\"', CASE e % 10 WHEN 2 THEN concat(',\"noiseDb\":', v) WHEN 3 THEN "
            "',\"healthActiveFaultCode\":288' ELSE '' END, '}')")


_KIND = "CASE c " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(tm.TYPES)) + " END"
_DOC = (f"concat('{{\"componentId\":\"C-', u, '\",\"componentType\":\"', {_KIND}, "
        "'\",\"readingIntervalSeconds\":60', CASE WHEN e % 10 = 2 THEN ',\"siteTag\":\"S\"' ELSE '' END, "
        f"',\"records\":[', {_record(0)}, ',', {_record(60000)}, ']}}')")
_SINGLE = (f"concat('{{\"ingestionMode\":\"REALTIME\",\"rawPayload\":{{\"componentId\":\"C-', u, "
           f"'\",\"componentType\":\"', {_KIND}, '\",\"eventId\":\"E-', e, '-0\",\"eventTimestamp\":\"', t, "
           "'\",\"cop\":\"', v, '\",\"building\":\"B\"}}')")
_TEXT = (f"CASE e % 10 WHEN 0 THEN left({_DOC}, 40) WHEN 1 THEN concat('[', {_DOC}, ']') "
         f"WHEN 4 THEN concat('no document ', e) WHEN 5 THEN {_SINGLE} ELSE {_DOC} END")


def _ingested(spark, sf_dir) -> str:
    path = layer(spark, "bronze")
    base = tm._spark_base(spark, sf_dir)
    # Few bytes of the table make much JSON to parse: rows are dealt evenly, not by the file's few splits.
    texts = base.repartition(*base.columns).selectExpr(f"{_TEXT} AS text", "concat('f-', e) AS path")
    ingest.write_bronze(documents.document_readings(documents.parse_documents(texts)), path)
    return path


@query(f"""WITH {tm.base_sql()}, shifts(s) AS (VALUES (0), (60000))
    SELECT concat('E-', e, '-', s) AS event_id, {_KIND} AS component_type, t + s AS timestamp,
      CASE WHEN c = 0 THEN v END AS cop, CASE WHEN e % 10 = 3 THEN 288::DOUBLE END AS code,
      CASE WHEN e % 10 = 2 THEN 'S' END AS site_tag, CASE WHEN e % 10 = 2 THEN v END AS noise_db,
      CASE WHEN e % 10 = 5 THEN 'B' END AS building,
      CASE WHEN e % 10 <> 5 THEN CAST(60 AS BIGINT) END AS reading_interval_seconds
    FROM base, shifts WHERE e % 10 NOT IN (0, 4) AND NOT (e % 10 = 5 AND s > 0)""")
def raw_texts_ingested(spark, sf_dir):
    """Texts of all forms to bronze and back: unknown fields are columns, single readings are rows."""
    path = _ingested(spark, sf_dir)
    wanted = {"siteTag": "string", "noiseDb": "double", "building": "string"}
    frames = {}
    for kind in tm.TYPES:
        if (rows := tables.read_table(spark, join_path(path, kind))) is not None:
            frames[kind] = rows.withColumns({
                n: F.lit(None).cast(t) for n, t in wanted.items() if n not in rows.columns})
    rows = reshape.snake_case_columns(reshape.union_components(frames))
    return rows.select("event_id", "component_type", "timestamp", F.col("cop").cast("double").alias("cop"),
                       F.col("health_active_fault_code").alias("code"), "site_tag", "noise_db", "building",
                       "reading_interval_seconds")


@query(f"""WITH {tm.base_sql()} SELECT concat('f-', e) AS path, {_TEXT} AS text,
    '{documents.MALFORMED}' AS reason FROM base WHERE e % 10 IN (0, 4)""")
def raw_texts_dead(spark, sf_dir):
    """The texts among them that are no documents, each with its reason."""
    dead = tables.read_table(spark, join_path(_ingested(spark, sf_dir), ingest.DEAD_DOCUMENTS))
    return dead.select("path", "text", "reason")
