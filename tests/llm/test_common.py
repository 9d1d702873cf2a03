import pytest
from pyspark.sql import functions as F

from gaugeline.llm import common


@pytest.mark.parametrize("size", [1, 50, 700, 10_000])
def test_samples_are_the_smallest_hashes(spark, size):
    df = spark.range(6_000).select((F.col("id") % 3_000).alias("k"),
                                   (F.col("id") % 3 == 0).cast("string").alias("g")).repartition(7)
    got = sorted(r["k"] for r in common.hash_sample(df, F.col("k"), size).collect())
    hashes = sorted((h, k) for k, h in df.select("k", F.xxhash64("k")).distinct().collect())
    assert got == sorted(k for _, k in hashes[:size])
    each = common.hash_sample_each(df, "g", F.col("k"), size).collect()
    for group in ("true", "false"):
        own = sorted((h, k) for k, h in df.where(F.col("g") == group)
                     .select("k", F.xxhash64("k")).distinct().collect())
        assert sorted(r["k"] for r in each if r["g"] == group) == sorted(k for _, k in own[:size])
    assert common.hash_sample(df.limit(0), F.col("k"), size).count() == 0
    assert common.hash_sample_each(df.limit(0), "g", F.col("k"), size).count() == 0


def test_stored_tables_lie_in_the_shared_folder_and_can_be_removed(spark):
    stored = common.store(spark.range(5), "t")
    folder = spark.conf.get("spark.checkpoint.dir")
    assert stored.stored_at.startswith(f"{folder}/corpus-{spark.sparkContext.applicationId}/")
    assert stored.count() == 5
    common.remove(stored)
    files = spark._jvm.org.apache.hadoop.fs.Path(stored.stored_at)
    assert not files.getFileSystem(spark._jsc.hadoopConfiguration()).exists(files)
