"""Layer tables: partitioned files with a recorded schema, written by append, merge or upsert.

The schema of a table is kept next to its data, so a read needs no footer pass, a column added by a
later writer is NULL in older rows, and a column's type grows with what is written to it. A ``delta`` table is handed to Delta Lake where the
session has it; everything else is done with plain Spark writes.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.operators import merge
from gaugeline.sources.scratch import Scratch
from gaugeline.sources.storage import exists, join_path, read_text, write_text
from gaugeline.sources.widening import (TypeDriftError, grown, physical_schema, to_logical,
                                        to_physical)

__all__ = ["AmbiguousMergeError", "TypeDriftError", "append", "merge_insert", "read_table",
           "recorded_types", "table_exists", "upsert"]

_SCHEMA_FILE = "_table_schema.json"


class AmbiguousMergeError(ValueError):
    """Several source rows would update the same target row."""


def _recorded_schema(spark: SparkSession, path: str) -> T.StructType | None:
    text = read_text(spark, join_path(path, _SCHEMA_FILE))
    return T.StructType.fromJson(json.loads(text)) if text else None


def recorded_types(spark: SparkSession, path: str) -> dict[str, str]:
    """Column types of a table as text; empty where none is recorded."""
    return {f.name: f.dataType.simpleString() for f in _recorded_schema(spark, path) or ()}


def _record_schema(spark: SparkSession, path: str, written: T.StructType,
                   fixed: Sequence[str] = ()) -> T.StructType:
    """Record what a batch adds to the table and return its schema. Raises before anything is written
    that the table could not be read back with. Older files stay readable with the new schema."""
    known = _recorded_schema(spark, path)
    merged = grown(known, written, fixed)
    if known is None or merged.json() != known.json():
        write_text(spark, join_path(path, _SCHEMA_FILE), merged.json())
    return merged


def table_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    marker = "_delta_log" if fmt == "delta" else _SCHEMA_FILE
    return exists(spark, join_path(path, marker)) or (fmt != "delta" and exists(
        spark, join_path(path, "_SUCCESS")))


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table, or None where there is none."""
    if not table_exists(spark, path, fmt):
        return None
    reader = spark.read.format(fmt)
    if fmt == "delta":
        return reader.load(path)
    schema = _recorded_schema(spark, path)
    if schema is None:
        return reader.option("mergeSchema", "true").load(path)
    return to_logical(reader.schema(physical_schema(schema)).load(path), schema)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet",
           rebalance: bool = False) -> None:
    """Append as is. ``rebalance`` gathers rows by partition value before writing, splitting large
    partitions and packing small ones, so that file sizes stay even."""
    if fmt != "delta":
        df = to_physical(df, _record_schema(df.sparkSession, path, df.schema, partition_by))
    out = df.hint("rebalance", *[F.col(c) for c in partition_by]) if rebalance else df
    out.write.format(fmt).mode("append").partitionBy(*partition_by).save(path)


def _within(df: DataFrame, source: DataFrame, column: str) -> tuple[DataFrame, DataFrame, bool]:
    """Rows of the frame, and values of the batch, between the batch's least and greatest value of the
    column; and whether the batch has NULL. Two numbers reach the driver."""
    low, high, rows, given = source.agg(F.min(column), F.max(column), F.count(F.lit(1)),
                                        F.count(column)).first()
    inside = F.col(column).between(F.lit(low), F.lit(high))
    return df.filter(inside), source.select(column).filter(inside), given < rows


def _in_partitions(df: DataFrame, column: str, source: DataFrame) -> DataFrame:
    """The partitions a batch touches. The files between its first and last value are what is listed;
    the semi join prunes those of other values when it runs."""
    rows, values, with_null = _within(df, source, column)
    touched = rows.join(values.distinct(), column, "left_semi").select(*df.columns)
    return touched.unionByName(df.filter(F.col(column).isNull())) if with_null else touched


def _with_keys(df: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the frame that the batch may have. The range of the first key prunes row groups; beyond
    that Spark may send a Bloom filter of a small batch to the scan of a large table."""
    rows, values, _ = _within(df, source, keys[0])
    wanted = source.select(*keys) if len(keys) > 1 else values
    return rows.select(*keys).join(wanted, list(keys), "left_semi")


def merge_insert(df: DataFrame, path: str, keys: Sequence[str],
                 partition_by: Sequence[str] = (), fmt: str = "parquet",
                 key_fixes_partition: bool = False, rebalance: bool = False) -> None:
    """Insert rows whose key the table lacks; the first write of a key wins.

    The first write to a new table appends everything. By default keys are compared with the whole
    table, of which only the key columns are read and only keys of the batch are kept. Where a key
    always comes with the same partition value, ``key_fixes_partition`` limits the comparison to the
    partitions of the batch. The batch is read a few times, mostly its keys alone: store it first where
    that is dear.
    """
    spark = df.sparkSession
    target = read_table(spark, path, fmt)
    if target is None:
        append(df, path, partition_by, fmt, rebalance or bool(partition_by))
    elif fmt == "delta":
        _delta_merge(df, path, keys, update=False)
    else:
        if key_fixes_partition and partition_by:
            target = _in_partitions(target, partition_by[0], df)
        append(merge.unmatched(_with_keys(target, df, keys), df, keys), path, partition_by, fmt,
               rebalance=bool(partition_by))


def upsert(df: DataFrame, path: str, keys: Sequence[str], scratch: Scratch,
           partition_by: Sequence[str] = (), fmt: str = "parquet") -> DataFrame:
    """Update matched rows and insert the others; returns the written source rows.

    The source is stored once - in the table itself when that is new, else in the scratch area -
    and read from there by every following step. A partitioned table is rewritten only in the partitions the source touches, which is exact as
    long as the partition columns are among the keys. Spark stages such a write and swaps the
    partitions in on commit, so the table may be read by the same job.
    """
    spark = df.sparkSession
    target = read_table(spark, path, fmt)
    if target is None:
        append(df, path, partition_by, fmt, rebalance=bool(partition_by))
        return read_table(spark, path, fmt)
    source = scratch.store(df)
    if fmt == "delta":
        _delta_merge(source, path, keys, update=True)
        return source
    if partition_by and not set(partition_by) <= set(keys):
        raise ValueError("partition columns must be part of the key")
    schema = grown(_recorded_schema(spark, path), source.schema, partition_by)
    if partition_by:
        target = _in_partitions(target, partition_by[0], source)
    if not merge.ambiguous_keys(target, source, keys).isEmpty():
        raise AmbiguousMergeError(f"{path}: several source rows for one key {list(keys)}")
    _record_schema(spark, path, source.schema, partition_by)
    merged = to_physical(merge.upsert(target, source, keys), schema)
    if partition_by:
        (merged.hint("rebalance", *[F.col(c) for c in partition_by]).write.format(fmt)
         .mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*partition_by).save(path))
    else:
        # Small unpartitioned table: a plain overwrite empties the folder before it writes, so the
        # result is stored elsewhere first.
        (scratch.store(merged).write.format(fmt).mode("overwrite").save(path))
        write_text(spark, join_path(path, _SCHEMA_FILE), schema.json())
    return source


def _delta_merge(df: DataFrame, path: str, keys: Sequence[str], update: bool) -> None:
    try:
        from delta.tables import DeltaTable
    except ImportError as missing:
        raise RuntimeError("format 'delta' needs the delta-spark package") from missing
    condition = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
    builder = (DeltaTable.forPath(df.sparkSession, path).alias("t")
               .merge(df.alias("s"), condition))
    if update:
        builder = builder.whenMatchedUpdateAll()
    builder.whenNotMatchedInsertAll().execute()
