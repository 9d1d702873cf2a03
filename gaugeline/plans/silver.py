"""Staging to silver: the quality gate."""

from __future__ import annotations

import time
from functools import partial

from pyspark.sql import Observation, SparkSession

from gaugeline import COMPONENTS
from gaugeline.operators.quality import (apply_quality_rules, gate_metrics, quarantine, split_valid)
from gaugeline.operators.reshape import between_dates
from gaugeline.operators.rules import RULES, RuleSet
from gaugeline.plans.concurrent import run_all
from gaugeline.sources.scratch import Scratch
from gaugeline.sources.storage import join_path
from gaugeline.sources.tables import merge_insert, read_table

DEAD_LETTERS = "dlq"


def staging_to_silver(spark: SparkSession, input_dir: str, output_dir: str, start=None, end=None,
                      now_ms: int | None = None, rules: dict[str, RuleSet] | None = None,
                      fmt: str = "parquet", ids_fix_date: bool = False) -> dict[str, dict[str, int]]:
    """Valid rows to ``<component>``, rejected ones with their reasons to ``dlq/<component>``.

    Returns the gate counters per component. The gate is evaluated once: its rows are stored, split by
    outcome, and both merges read the stored part that is theirs. The counters are observed meanwhile.
    """
    now_ms = int(time.time() * 1000) if now_ms is None else now_ms
    rules = RULES if rules is None else rules
    with Scratch(spark, "silver") as scratch:

        def gate(component: str) -> dict[str, int] | None:
            staged = read_table(spark, join_path(input_dir, component), fmt)
            if staged is None:
                return None
            staged = between_dates(staged, start, end)
            if staged.isEmpty():
                return None
            checked = apply_quality_rules(staged, rules.get(component, RuleSet()), now_ms)
            seen = Observation(f"gate-{component}")
            valid, invalid = split_valid(scratch.store(checked.observe(seen, *gate_metrics()),
                                                       partition_by=("is_valid",)))
            counted = seen.get
            if counted["valid_records"]:
                merge_insert(valid, join_path(output_dir, component), ["event_id"], ["date"], fmt,
                             ids_fix_date)
            if counted["invalid_records"]:
                merge_insert(quarantine(invalid), join_path(output_dir, DEAD_LETTERS, component),
                             ["event_id"], ["date"], fmt, ids_fix_date)
            return counted

        done = run_all({c: partial(gate, c) for c in COMPONENTS})
    return {component: counted for component, counted in done.items() if counted is not None}
