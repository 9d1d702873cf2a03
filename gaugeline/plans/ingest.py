"""Raw documents to bronze, bronze to staging."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline import COMPONENTS
from gaugeline.operators import documents
from gaugeline.operators.reshape import (between_dates, explode_records, flatten_record, route,
                                         snake_case_columns, with_event_date)
from gaugeline.plans.concurrent import run_all
from gaugeline.sources.raw import read_raw
from gaugeline.sources.scratch import Scratch
from gaugeline.sources.storage import join_path
from gaugeline.sources.tables import merge_insert, read_table, recorded_types

#: Table of the texts that are no documents.
DEAD_DOCUMENTS = "dead_documents"


def flatten_documents(raw: DataFrame) -> DataFrame:
    """Documents to typed rows, one per reading."""
    return with_event_date(flatten_record(explode_records(raw)))


def write_bronze(rows: DataFrame, output_dir: str, fmt: str = "parquet",
                 ids_fix_date: bool = False) -> list[str]:
    """Merge document readings (see ``documents.document_readings``) into one table per component type
    and texts that are no documents into ``dead_documents``; returns the types that had data.

    Rows are stored once, split by component type, so JSON, the dearest format to read, is parsed once
    whatever the number of tables. Fields that the schema does not know become columns of the types they
    have in this store; the texts are not read again for them.
    """
    spark = rows.sparkSession
    with Scratch(spark, "bronze") as scratch:
        kind = F.when(F.col(documents.REASON).isNotNull(), DEAD_DOCUMENTS).otherwise(
            F.col("componentType"))
        known = rows.withColumn("componentType", kind).filter(
            F.col("componentType").isin(*COMPONENTS, DEAD_DOCUMENTS))
        stored = scratch.store(known, partition_by=("componentType",))
        dead = documents.unreadable(stored.filter(F.col("componentType") == DEAD_DOCUMENTS))
        frames = route(documents.readings(stored.filter(F.col("componentType") != DEAD_DOCUMENTS)))

        def write(component: str) -> bool:
            routed = frames[component]
            if routed.isEmpty():
                return False
            path = join_path(output_dir, component)
            routed = documents.promote_unknown(routed, documents.unknown_fields(routed),
                                               recorded_types(spark, path))
            merge_insert(routed, path, ["eventId"], ["date"], fmt, ids_fix_date, rebalance=True)
            return True

        def write_dead() -> bool:
            if not dead.isEmpty():
                merge_insert(dead.withColumn("received_at", F.current_timestamp()),
                             join_path(output_dir, DEAD_DOCUMENTS), ["document_id"], fmt=fmt)
            return False

        done = run_all({**{c: partial(write, c) for c in COMPONENTS}, DEAD_DOCUMENTS: write_dead})
    return [component for component, wrote in done.items() if wrote]


def raw_to_bronze(spark: SparkSession, input_dir: str, output_dir: str,
                  dates: Iterable[dt.date] | None = None, schema: T.StructType | None = None,
                  multi_line: bool = True, fmt: str = "parquet", ids_fix_date: bool = False
                  ) -> list[str]:
    """Write one bronze table per component type; returns the types that had data.

    ``ids_fix_date`` says that an event id implies its date (ids made from device and time do); merges
    then read only the dates of the batch instead of the key column of the whole table. Texts that are no
    documents go to ``dead_documents`` with their reason; a rerun adds none twice.
    """
    texts = read_raw(spark, input_dir, dates, multi_line)
    if texts is None:
        return []
    rows = documents.document_readings(documents.parse_documents(texts, schema), schema)
    return write_bronze(rows, output_dir, fmt, ids_fix_date)


def bronze_to_staging(spark: SparkSession, input_dir: str, output_dir: str, start=None, end=None,
                      fmt: str = "parquet", ids_fix_date: bool = False) -> list[str]:
    """Rename to snake_case and merge on the event id; absent or empty tables are skipped."""
    def write(component: str) -> bool:
        bronze = read_table(spark, join_path(input_dir, component), fmt)
        if bronze is None:
            return False
        rows = snake_case_columns(between_dates(bronze, start, end))
        if rows.isEmpty():
            return False
        merge_insert(rows, join_path(output_dir, component), ["event_id"], ["date"], fmt,
                     ids_fix_date)
        return True

    done = run_all({c: partial(write, c) for c in COMPONENTS})
    return [component for component, wrote in done.items() if wrote]
