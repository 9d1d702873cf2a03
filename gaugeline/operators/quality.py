"""The quality gate: mark rows with the reasons they fail, then split them."""

from __future__ import annotations

import time
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions import MS_PER_DAY
from gaugeline.operators.dedup import flag_duplicates
from gaugeline.operators.rules import (ACCEPTED_HEALTH, ACCEPTED_QUALITY, FUTURE_ALLOWANCE_DAYS,
                                       RuleSet)

DUPLICATE_FLAG = "_duplicate"
SEPARATOR = " | "


def rule_conditions(columns: Iterable[str], rules: RuleSet, now_ms: int) -> list[tuple[str, str]]:
    """(reason, failing condition as SQL) in reporting order; rules on absent columns are skipped.

    A condition that evaluates to NULL does not fail the row.
    """
    present = set(columns)
    found: list[tuple[str, str]] = []

    def number(name: str) -> str:
        return f"try_cast(`{name}` AS DOUBLE)"

    def outside(name: str, accepted: tuple[str, ...]) -> str:
        return f"`{name}` NOT IN ({', '.join(repr(v) for v in accepted)})"

    if DUPLICATE_FLAG in present:
        found.append(("Duplicate event_id", DUPLICATE_FLAG))
    if "data_quality" in present:
        found.append(("Bad data_quality", outside("data_quality", ACCEPTED_QUALITY)))
    for name in rules.mandatory:
        if name in present:
            found.append((f"Null mandatory field: {name}",
                          f"`{name}` IS NULL OR CAST(`{name}` AS STRING) = ''"))
    if "timestamp" in present:
        limit = now_ms + FUTURE_ALLOWANCE_DAYS * MS_PER_DAY
        found.append(("Invalid timestamp", "`timestamp` IS NULL OR `timestamp` <= 0"))
        found.append(("Future timestamp", f"`timestamp` > {limit}"))
    for name, (low, high) in rules.ranges.items():
        if name in present:
            found.append((f"Out of range: {name}", f"{number(name)} < {float(low)}D "
                          f"OR {number(name)} > {float(high)}D"))
    for a, b, buffer in rules.greater:
        if a in present and b in present:
            found.append((f"Cross field error: {a} > {b}",
                          f"{number(a)} + {float(buffer)}D <= {number(b)}"))
    if "health_status" in present:
        found.append(("Invalid health_status", outside("health_status", ACCEPTED_HEALTH)))
    return found


def apply_quality_rules(df: DataFrame, rules: RuleSet, now_ms: int | None = None) -> DataFrame:
    """Add ``is_valid`` and ``failure_reason`` (all failed rules in order, `` | `` between them).

    ``now_ms`` fixes the clock for the future-timestamp rule. All rules are one projection.
    """
    if now_ms is None:
        now_ms = int(time.time() * 1000)
    columns = df.columns
    marked = flag_duplicates(df, "event_id", "timestamp", DUPLICATE_FLAG)
    reasons = [f"CASE WHEN {condition} THEN '{reason}' END" for reason, condition
               in rule_conditions([*columns, DUPLICATE_FLAG], rules, now_ms)]
    reason = f"concat_ws('{SEPARATOR}', {', '.join(reasons)})"
    return (marked.select(*columns, F.expr(reason).alias("failure_reason"))
            .select(*columns, (F.col("failure_reason") == "").alias("is_valid"), "failure_reason"))


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that passed, without the flag columns; rows that failed, with them)."""
    passed = checked.filter(F.col("is_valid")).drop("is_valid", "failure_reason")
    return passed, checked.filter(~F.col("is_valid"))


def quarantine(invalid: DataFrame) -> DataFrame:
    return invalid.withColumn("quarantine_timestamp", F.current_timestamp())


def gate_metrics() -> list[Column]:
    return [F.count(F.lit(1)).alias("total_records"),
            F.count_if(F.col("is_valid")).alias("valid_records"),
            F.count_if(~F.col("is_valid")).alias("invalid_records")]


def gate_counts(checked: DataFrame) -> DataFrame:
    """One row: how many rows came in, passed and failed."""
    return checked.agg(*gate_metrics())
