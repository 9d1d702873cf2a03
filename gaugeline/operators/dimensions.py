"""Dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.operators.dedup import distinct_keys, latest_per_key
from gaugeline.operators.reshape import snake_case_columns

# Descriptive columns of a component.
COMPONENT_COLUMNS = ("component_id", "hvac_machine_id", "component_type", "component_manufacturer",
                     "component_model", "component_serial_number", "component_installation_date")
# End of fixed values.


def dim_company(customers: DataFrame) -> DataFrame:
    return snake_case_columns(customers).select("company_id", "company_name", "industry",
                                                "account_type")


def dim_location(locations: DataFrame) -> DataFrame:
    return snake_case_columns(locations).select("location_id", "company_id", "location_name",
                                                "city", "state", "country")


def dim_hvac_machine(machines: DataFrame) -> DataFrame:
    return snake_case_columns(machines).select("hvac_machine_id", "location_id", "manufacturer",
                                               "model")


def dim_fault_code(entries: DataFrame) -> DataFrame:
    """From (code, entry) rows; attributes an entry lacks become empty text."""
    def attribute(name: str):
        return F.coalesce(F.col("entry")[name], F.lit(""))

    return entries.select(
        F.col("code").cast("bigint").alias("fault_code_key"), F.col("code").alias("fault_code"),
        attribute("component_type").alias("component_type"),
        attribute("label").alias("fault_description"),
        attribute("description").alias("threshold_description"),
        attribute("severity").alias("severity"),
        attribute("recommended_action").alias("recommended_action"),
        F.lit(True).alias("is_active"))


def dim_component(telemetry: DataFrame) -> DataFrame:
    """One row per component with its latest attributes (type 1)."""
    present = [c for c in COMPONENT_COLUMNS if c in telemetry.columns]
    return latest_per_key(telemetry, ["component_id"], present)


def dim_date(telemetry: DataFrame) -> DataFrame:
    """Calendar attributes of every date with data; day_of_week is 1 for Sunday to 7."""
    day = F.col("date")
    return distinct_keys(telemetry, ["date"]).select(
        "date", F.year(day).alias("year"), F.quarter(day).alias("quarter"),
        F.month(day).alias("month"), F.dayofmonth(day).alias("day"),
        F.dayofweek(day).alias("day_of_week"), F.dayofweek(day).isin(1, 7).alias("is_weekend"))


def with_fault_code_key(telemetry: DataFrame, fault_codes: DataFrame) -> DataFrame:
    """Nullable foreign key into dim_fault_code. Codes the dictionary lacks stay NULL.

    Rows without a code, most of them, match nothing; they are spread by content where the join is
    a shuffle, instead of meeting in one task.
    """
    keys = fault_codes.select(F.col("fault_code_key"), F.lit(-1).alias("_spread"),
                              F.col("fault_code_key").cast("double").alias("_code"))
    code = F.expr("try_cast(health_active_fault_code AS double)")
    spread = F.when(code.isNull(), F.pmod(F.xxhash64(*telemetry.columns), F.lit(65_536)).cast("int"))
    match = ((F.coalesce(code, F.lit(0.0)) == F.col("_code"))
             & (F.coalesce(spread, F.lit(-1)) == F.col("_spread")))
    return telemetry.join(keys, match, "left").select(*telemetry.columns, "fault_code_key")
