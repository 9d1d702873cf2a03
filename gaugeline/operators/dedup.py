"""Duplicate detection and one-row-per-key selection that hold up when one key is very frequent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def flag_duplicates(df: DataFrame, key: str = "event_id", order: str = "timestamp",
                    flag: str = "is_duplicate") -> DataFrame:
    """Mark every row but the latest of its key. NULL keys count as one key.

    One scan, two rankings. Rows are ranked first per key and input partition, the partition being
    noted before any shuffle, then the winners of the partitions per key. A task holds no more of
    one key than one input partition does in the first step, and one row for each input partition
    in the second. Ties on ``order`` are settled by row content.
    """
    columns = df.columns
    ranked = df.withColumns({"_part": F.spark_partition_id(), "_tie": F.xxhash64(*columns)})
    newest_first = (F.col(order).desc(), F.col("_tie"))
    local = Window.partitionBy(key, "_part").orderBy(*newest_first)
    ranked = ranked.withColumn("_local", F.row_number().over(local))
    # Partition winners meet under slot -1; the others are settled and stay spread out.
    ranked = ranked.withColumn("_slot", F.when(F.col("_local") == 1, -1).otherwise(F.col("_part")))
    final = Window.partitionBy(key, "_slot").orderBy(*newest_first)
    ranked = ranked.withColumn(
        flag, (F.col("_local") > 1) | (F.row_number().over(final) > 1))
    return ranked.drop("_part", "_tie", "_local", "_slot")


def latest_per_key(df: DataFrame, keys: Sequence[str], columns: Sequence[str],
                   order: str = "timestamp") -> DataFrame:
    """One row per key: the attribute values seen last, equal times settled by value.

    Grouping by key and attributes first leaves one row per distinct combination; the second
    aggregation is combined on the map side too, so no task has to hold one key's whole history.
    """
    attributes = [c for c in columns if c not in keys]
    history = df.groupBy(*keys, *attributes).agg(F.max(order).alias("_seen"))
    newest = F.max(F.struct("_seen", *attributes)).alias("_newest")
    return (history.groupBy(*keys).agg(newest)
            .select(*keys, *[F.col("_newest")[c].alias(c) for c in attributes]).select(*columns))


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()
