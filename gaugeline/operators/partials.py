"""Mergeable partial aggregates.

A coarser grain is computed from a finer one by merging counts, sums, minima and maxima - never by
averaging averages - so the readings themselves are scanned and shuffled once for all grains.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_FIRST = {"n": F.count, "sum": F.sum, "min": F.min, "max": F.max}
_MERGE = {"n": F.sum, "sum": F.sum, "min": F.min, "max": F.max}

Part = tuple[str, str]  # (kind, column)


def part_name(kind: str, column: str) -> str:
    return f"{kind}__{column}"


def build_parts(df: DataFrame, keys: Sequence[str], parts: Iterable[Part]) -> DataFrame:
    """Partial aggregates of the listed columns; columns the frame lacks are skipped."""
    wanted = [p for p in dict.fromkeys(parts) if p[1] in df.columns]
    if not wanted:
        return df.select(*keys).distinct()
    return df.groupBy(*keys).agg(*[_FIRST[kind](column).alias(part_name(kind, column))
                                   for kind, column in wanted])


def merge_parts(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Partial aggregates at a coarser grain."""
    columns = [c for c in parts.columns if "__" in c]
    if not columns:
        return parts.select(*keys).distinct()
    return parts.groupBy(*keys).agg(*[_MERGE[c.split("__", 1)[0]](c).alias(c) for c in columns])


def mean_of(column: str) -> Column:
    """Mean from its parts; NULL where no value was seen."""
    n = F.col(part_name("n", column))
    return F.when(n > 0, F.col(part_name("sum", column)) / n)
