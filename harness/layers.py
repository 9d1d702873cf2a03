"""Folders for what registered queries store; they go when the application ends."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from gaugeline.sources.scratch import checkpoint_folder
from gaugeline.sources.storage import join_path, make_until_exit


def layer(spark: SparkSession, name: str) -> str:
    path = join_path(checkpoint_folder(spark), f"gaugeline-query-{name}-{uuid.uuid4().hex}")
    make_until_exit(spark, path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame as read back from storage."""
    path = join_path(layer(df.sparkSession, name), "t")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
