"""Helpers shared by the corpus operators."""

from __future__ import annotations

import posixpath
import uuid
from pathlib import Path

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeline.sources.scratch import checkpoint_folder
from gaugeline.sources.storage import delete_tree, make_until_exit

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()

# Classes of the characters most texts are made of, for the standard library's quick matcher. Inside
# LATIN, LETTER and NUMBER are Unicode's general categories L and N.
LATIN = r"\t-\r\x20-\x7e\xa1-\u017f"
LETTER = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f"
NUMBER = r"0-9\xb2\xb3\xb9\xbc-\xbe"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workers_import_package(spark: SparkSession) -> None:
    """Let Python workers import this package when the driver found it by its own path only."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        environment["PYTHONPATH"] = f"{root}:{known}" if known else root


def corpus_folder(spark: SparkSession) -> str:
    """Folder of this application's tables, in the shared folder that ``spark.checkpoint.dir`` names.
    It goes, with all in it, when the application ends."""
    path = posixpath.join(checkpoint_folder(spark), f"corpus-{spark.sparkContext.applicationId}")
    make_until_exit(spark, path)
    return path


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and return it as read from there.

    Cuts lineage: what reads the table repeats none of the work behind it, and a lost executor
    costs the tasks it was running.
    """
    spark = df.sparkSession
    path = posixpath.join(corpus_folder(spark), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def remove(stored: DataFrame) -> None:
    """Delete a table that :func:`store` returned and nothing reads any more."""
    delete_tree(stored.sparkSession, stored.stored_at)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def share_bound(distinct: Column, size: int) -> Column:
    """Hash under which half as many again as ``size`` of so many distinct hashes lie, give or take; the
    greatest one where there are few."""
    share = F.lit(1.5 * size + 100) / F.greatest(distinct, F.lit(1))
    return F.when(share >= 1, F.lit((1 << 63) - 1)).otherwise(
        ((share - 0.5) * F.lit(2.0 ** 64)).cast("long"))


def hash_sample(df: DataFrame, key: Column, size: int) -> DataFrame:
    """Rows of the ``size`` distinct keys with the smallest hashes, one row for each.

    Deterministic, independent of partitioning, and bounded however often a key is repeated. Hashes
    are counted first, so those that are ranked are about half as many again as ``size``, from however
    many tasks.
    """
    hashed = df.withColumn("_sample_hash", F.xxhash64(key))
    limit = hashed.agg(share_bound(F.approx_count_distinct("_sample_hash", 0.02), size)).first()[0]
    few = hashed.where(F.col("_sample_hash") <= limit).select("_sample_hash").distinct()
    bound = few.orderBy("_sample_hash").limit(size).agg(F.max("_sample_hash")).first()[0]
    if bound is None:
        return hashed.limit(0)
    return hashed.where(F.col("_sample_hash") <= bound).dropDuplicates(["_sample_hash"])


def hash_sample_each(df: DataFrame, group: str, key: Column, size: int) -> DataFrame:
    """For each value of the column ``group``, rows of the ``size`` distinct keys with the smallest
    hashes, one row for each.

    Hashes are counted first, so about half as many again as ``size`` are ranked of a group, however
    many it has.
    """
    hashed = df.withColumn("_sample_hash", F.xxhash64(key))
    limits = hashed.groupBy(group).agg(share_bound(
        F.approx_count_distinct("_sample_hash", 0.02), size).alias("_limit"))
    few = (hashed.join(limits, group).where(F.col("_sample_hash") <= F.col("_limit"))
           .select(group, "_sample_hash").distinct())
    place = F.row_number().over(Window.partitionBy(group).orderBy("_sample_hash"))
    bounds = few.withColumn("_place", place).where(F.col("_place") <= size).groupBy(group).agg(
        F.max("_sample_hash").alias("_bound"))
    return (hashed.join(bounds, group).where(F.col("_sample_hash") <= F.col("_bound"))
            .drop("_bound").dropDuplicates([group, "_sample_hash"]))


class HashFilter:
    """Bitmap over a column ``hash`` (long): tells most values that are not in it, never errs on one
    that is.

    At most ``1 << most_bits`` bits whatever the number of values, so it may travel to every task; a
    fuller map only lets more values through to what looks at them exactly.
    """

    def __init__(self, hashes: DataFrame, bits_each: int = 32, most_bits: int = 27):
        n = hashes.count()
        self.shift = 64 - min(most_bits, max(10, (bits_each * n).bit_length()))
        bit = F.pmod(F.shiftrightunsigned("hash", self.shift), F.lit(64)).cast("int")
        words = (hashes.select(F.shiftrightunsigned("hash", self.shift + 6).alias("word"),
                               F.call_function("shiftleft", F.lit(1).cast("long"), bit)
                               .alias("bit"))
                 .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow())
        self.bits = np.zeros(1 << (64 - self.shift - 6), np.uint64)
        at, bits = (words[c].to_numpy().astype(np.int64) for c in ("word", "bits"))
        self.bits[at] = bits.view(np.uint64)

    def maybe(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes.view(np.uint64) >> np.uint64(self.shift)
        return (self.bits[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)) > 0

    def may_hold(self, value: int) -> bool:
        at = value >> self.shift
        return bool(int(self.bits[at >> 6]) >> (at & 63) & 1)


class WordHashes(dict):
    """64-bit hashes of words, worked out when first asked for; a bounded number is remembered."""

    def __init__(self, remembered: int = 150_000):
        super().__init__()
        self.remembered = remembered

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < self.remembered:
            self[word] = value
        return value


#: Shared by the operators: a worker that runs several of them one after another remembers words once.
HASHES = WordHashes()
