"""Topology, fault dictionary and the JSON form of the ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline import schemas
from gaugeline.sources.storage import exists, join_path


def _read_document(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if not exists(spark, path):
        raise FileNotFoundError(path)
    return (spark.read.schema(schema).option("multiLine", "true").option("mode", "FAILFAST")
            .json(path))


def read_topology(spark: SparkSession, config_dir: str) -> dict[str, DataFrame]:
    """Frames ``customers``, ``locations`` and ``hvac_machines`` with their original names."""
    return {name: _read_document(spark, join_path(config_dir, "topology", f"{name}.json"), schema)
            for name, schema in schemas.TOPOLOGY.items()}


def fault_entries(dictionary: DataFrame) -> DataFrame:
    """One row (code, entry) per entry of the ``codes`` map."""
    return dictionary.select(F.explode("codes").alias("code", "entry"))


def read_fault_codes(spark: SparkSession, path: str) -> DataFrame:
    """Entries of the fault dictionary. An unreadable file raises."""
    return fault_entries(_read_document(spark, path, schemas.FAULT_DICTIONARY))


def read_score_bands(spark: SparkSession, path: str) -> DataFrame:
    """Score bands of the fault dictionary. An unreadable file raises."""
    return score_bands(_read_document(spark, path, schemas.FAULT_DICTIONARY))


def score_bands(dictionary: DataFrame) -> DataFrame:
    """One row (band, floor, label) per entry of the ``health_score_thresholds`` map."""
    return dictionary.select(F.explode("health_score_thresholds").alias("band", "entry")).select(
        "band", F.col("entry")["min"].alias("floor"), F.col("entry")["label"].alias("label"))


def read_ledger_document(spark: SparkSession, path: str, dates_added: bool = False
                         ) -> tuple[DataFrame, DataFrame]:
    """(dates, runs) from a ledger kept as one JSON document; with the dates of each run if asked."""
    document = _read_document(spark, path, schemas.LEDGER)
    dates = (document.select(F.explode("generated_dates").alias("date"))
             .select(F.try_to_timestamp("date", F.lit("yyyy-MM-dd")).cast("date").alias("date"))
             .filter("date IS NOT NULL").distinct())
    run = F.col("run")
    runs = document.select(F.explode("run_history").alias("run")).select(
        run["start"].try_cast("date").alias("start"), run["end"].try_cast("date").alias("end"),
        run["days"].cast("int").alias("days"),
        run["timestamp"].try_cast("timestamp").alias("recorded_at"), run["note"].alias("note"),
        *([F.filter(F.transform(F.coalesce(run["dates_added"], F.array().cast("array<string>")),
                                lambda d: d.try_cast("date")), lambda d: d.isNotNull())
           .alias("dates_added")] if dates_added else []))
    return dates, runs
