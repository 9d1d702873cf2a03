import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[8]").appName("tests")
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.session.timeZone", "UTC")
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(autouse=True)
def utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    yield


@pytest.fixture(scope="session")
def lake(spark, tmp_path_factory):
    """All layers of a two-machine fleet, built in two runs of one day each."""
    import fleet

    from gaugeline.plans import gold, ingest, silver
    root = tmp_path_factory.mktemp("lake")
    fleet.write_config(root / "config")
    paths = {k: str(root / k) for k in ("raw", "bronze", "staging", "silver", "gold", "config")}
    counters = []
    for day in fleet.DAYS:
        fleet.write(root / "raw", {day: fleet.standard_day(day)})
        ingest.raw_to_bronze(spark, paths["raw"], paths["bronze"], dates=[day])
        ingest.bronze_to_staging(spark, paths["bronze"], paths["staging"], day, day)
        counters.append(silver.staging_to_silver(spark, paths["staging"], paths["silver"], day, day,
                                                 now_ms=fleet.NOW_MS))
        gold.silver_to_gold(spark, paths["silver"], paths["gold"], paths["config"], day, day)
    return paths, counters


@pytest.fixture()
def scratch(spark):
    from gaugeline.sources.scratch import Scratch
    with Scratch(spark, "test") as area:
        yield area
