"""Raw day-batch documents."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

from gaugeline.operators.ledger import MONTHS
from gaugeline.sources.storage import glob, join_path


def raw_directories(spark: SparkSession, input_dir: str,
                    dates: Iterable[dt.date] | None = None) -> list[str]:
    """``location_*`` folders, or only their folders for the given days.

    Restricting the days keeps the listing - one small file per device and day - to what the run
    needs.
    """
    if dates is None:
        return glob(spark, join_path(input_dir, "location_*"))
    return [path for day in sorted(set(dates)) for path in glob(spark, join_path(
        input_dir, "location_*", f"{day.year:04d}", MONTHS[day.month - 1], f"day{day.day}"))]


def raw_texts(reader: DataFrameReader | DataStreamReader, multi_line: bool,
              paths: str | list[str]) -> DataFrame:
    """(text, path) of every file below the paths, or of every line with ``multi_line`` off."""
    return (reader.option("recursiveFileLookup", "true").option("wholetext", multi_line)
            .format("text").load(paths)
            .select(F.col("value").alias("text"), F.col("_metadata.file_path").alias("path")))


def read_raw(spark: SparkSession, input_dir: str, dates: Iterable[dt.date] | None = None,
             multi_line: bool = True) -> DataFrame | None:
    """All document texts below ``input_dir`` as (text, path), or None when it has no location folders.

    ``multi_line`` is one text per file; turn it off for line-delimited files, which Spark can split.
    """
    directories = raw_directories(spark, input_dir, dates)
    return raw_texts(spark.read, multi_line, directories) if directories else None


def raw_paths(spark: SparkSession, input_dir: str) -> DataFrame | None:
    """Paths of all raw files in column ``path``; contents are not read."""
    directories = raw_directories(spark, input_dir)
    if not directories:
        return None
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .load(directories).select(F.col("path")))
