"""Intermediate results in the shared checkpoint folder.

Results that several steps read are written as tables, not cached: a lost executor costs nothing,
and Spark knows the exact size of what it reads back, which is what its broadcast decision uses.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from gaugeline.sources.storage import delete_tree, join_path


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names. A session of one machine that names none gets its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="gaugeline-"))
    return spark.conf.get("spark.checkpoint.dir")


class Scratch:
    """Folder of one job run below ``spark.checkpoint.dir``.

    Removed when the run succeeds and kept when it fails, so that a table whose replacement was
    interrupted can be restored from it.
    """

    def __init__(self, spark: SparkSession, name: str):
        self._spark = spark
        base = checkpoint_folder(spark)
        self._root = join_path(base, f"gaugeline-{name}-{uuid.uuid4().hex}")

    def store(self, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        """Write the frame and return it as read from storage."""
        path = join_path(self._root, uuid.uuid4().hex)
        df.write.partitionBy(*partition_by).parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, failure, *_details) -> None:
        if failure is None:
            delete_tree(self._spark, self._root)
