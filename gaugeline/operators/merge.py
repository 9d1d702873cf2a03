"""The two merge forms as frame algebra; ``gaugeline.sources.tables`` applies them to storage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _known_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is complete; a NULL in any part means no match."""
    return df.filter(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))


def _spread(source: DataFrame, keys: Sequence[str]) -> Column:
    """-1 for a complete key; for others a number from the row's content, since rows that match nothing
    need not meet in one task."""
    hashable = [f.name for f in source.schema if isinstance(f.dataType, T.AtomicType)
                and not isinstance(f.dataType, T.VariantType)]
    number = F.pmod(F.xxhash64(*hashable), F.lit(65_536)).cast("int")
    missing = " OR ".join(f"`{k}` IS NULL" for k in keys)
    return F.when(F.expr(missing), number).otherwise(-1)


def unmatched(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target lacks; a NULL key never matches. Both sides are read once, the
    target for its key columns only."""
    held = _known_keys(target.select(*keys), keys).select(
        *[F.col(k).alias(f"_held_{n}") for n, k in enumerate(keys)], F.lit(-1).alias("_held"))
    rows = source.withColumn("_spread", _spread(source, keys))
    match = F.col("_spread") == F.col("_held")
    for n, k in enumerate(keys):
        match = match & (F.col(f"`{k}`") == F.col(f"_held_{n}"))
    return rows.join(held, match, "left_anti").select(*source.columns)


def insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows stay as they are; unmatched source rows are added, repeated ones included."""
    return target.unionByName(unmatched(target, source, keys), allowMissingColumns=True)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matched rows take the source's values, the rest of both sides is kept.

    Columns only the target has keep their value on matched rows; a source row that matches
    several target rows updates each of them.
    """
    keys = list(keys)
    kept = target.join(_known_keys(source.select(*keys), keys).distinct(), keys, "left_anti")
    target_only = [c for c in target.columns if c not in source.columns]
    written = source.join(target.select(*keys, *target_only), keys, "left")
    return kept.unionByName(written, allowMissingColumns=True)


def ambiguous_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that would update one target row from several source rows; an upsert must see none."""
    keys = list(keys)
    repeated = (_known_keys(source, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
                .filter("_n > 1").drop("_n"))
    return repeated.join(target.select(*keys), keys, "left_semi")
