import datetime as dt
import importlib.util

import pytest
from pyspark.sql import functions as F

from gaugeline.operators import merge
from gaugeline.sources import tables
from gaugeline.sources.tables import AmbiguousMergeError

D1, D2, D3 = (dt.date(2025, 1, d) for d in (1, 2, 3))


def rowset(df):
    return sorted(map(str, map(tuple, df.collect())))


def test_insert_only_keeps_first_write(spark):
    target = spark.createDataFrame([("a", 1), ("b", 1), (None, 1)], "k string, v int")
    source = spark.createDataFrame([("a", 2), ("c", 2), ("c", 3), (None, 2)], "k string, v int")
    got = merge.insert_only(target, source, ["k"])
    assert rowset(got) == sorted(map(str, [("a", 1), ("b", 1), (None, 1), ("c", 2), ("c", 3),
                                           (None, 2)]))


def test_upsert_replaces_and_keeps_target_only_columns(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y"), (None, 1, "z")],
                                   "k string, v int, note string")
    source = spark.createDataFrame([("a", 2, 1.0), ("c", 2, 2.0), (None, 2, 3.0)],
                                   "k string, v int, extra double")
    got = merge.upsert(target, source, ["k"]).select("k", "v", "note", "extra")
    assert rowset(got) == sorted(map(str, [
        ("a", 2, "x", 1.0), ("b", 1, "y", None), ("c", 2, None, 2.0), (None, 1, "z", None),
        (None, 2, None, 3.0)]))


def test_ambiguous_keys(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    source = spark.createDataFrame([("a", 2), ("a", 3), ("b", 1), ("b", 2), (None, 1), (None, 2)],
                                   "k string, v int")
    assert [r["k"] for r in merge.ambiguous_keys(target, source, ["k"]).collect()] == ["a"]


def test_merge_insert_on_storage(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "k string, v int, date date"
    assert tables.read_table(spark, path) is None
    first = spark.createDataFrame([("a", 1, D1), ("a", 2, D1), (None, 1, D1)], schema)
    tables.merge_insert(first, path, ["k"], ["date"])  # the first write appends as is
    assert tables.read_table(spark, path).count() == 3
    again = spark.createDataFrame([("a", 9, D1), ("b", 1, D2), (None, 1, D1)], schema)
    tables.merge_insert(again, path, ["k"], ["date"])
    got = tables.read_table(spark, path)
    assert rowset(got.select("k", "v")) == sorted(map(str, [
        ("a", 1), ("a", 2), ("b", 1), (None, 1), (None, 1)]))
    tables.merge_insert(again.dropna(), path, ["k"], ["date"])
    assert tables.read_table(spark, path).count() == 5


def test_merge_insert_within_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "k string, date date"
    tables.merge_insert(spark.createDataFrame([("a", D1), ("b", D2)], schema), path, ["k"], ["date"])
    tables.merge_insert(spark.createDataFrame([("b", D2), ("c", D2)], schema), path, ["k"], ["date"],
                        key_fixes_partition=True)
    assert rowset(tables.read_table(spark, path).select("k")) == ["('a',)", "('b',)", "('c',)"]


def test_new_columns_are_null_in_older_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append(spark.createDataFrame([("a", D1)], "k string, date date"), path, ["date"])
    tables.append(spark.createDataFrame([("b", 2, D2)], "k string, v int, date date"), path, ["date"])
    got = tables.read_table(spark, path).select("k", "v")
    assert rowset(got) == ["('a', None)", "('b', 2)"]


def test_upsert_rewrites_only_touched_partitions(spark, tmp_path, scratch):
    path = str(tmp_path / "t")
    schema = "k string, v int, date date"
    tables.upsert(spark.createDataFrame([("a", 1, D1), ("b", 1, D1), ("a", 1, D2)], schema), path,
                  ["date", "k"], scratch, ["date"])
    untouched = sorted(p.name for p in (tmp_path / "t" / "date=2025-01-02").iterdir())
    tables.upsert(spark.createDataFrame([("a", 2, D1), ("c", 2, D3)], schema), path, ["date", "k"],
                  scratch, ["date"])
    got = tables.read_table(spark, path).select("date", "k", "v")
    assert rowset(got) == sorted(map(str, [(D1, "a", 2), (D1, "b", 1), (D2, "a", 1), (D3, "c", 2)]))
    assert untouched == sorted(p.name for p in (tmp_path / "t" / "date=2025-01-02").iterdir())


def test_upsert_of_unpartitioned_table_is_idempotent(spark, tmp_path, scratch):
    path = str(tmp_path / "t")
    source = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    for _ in range(3):
        tables.upsert(source, path, ["k"], scratch)
    tables.upsert(spark.createDataFrame([("b", 3, "n")], "k string, v int, note string"), path, ["k"],
                  scratch)
    assert rowset(tables.read_table(spark, path).select("k", "v", "note")) == [
        "('a', 1, None)", "('b', 3, 'n')"]


def test_upsert_refuses_ambiguous_source(spark, tmp_path, scratch):
    path = str(tmp_path / "t")
    schema = "k string, v int, date date"
    tables.upsert(spark.createDataFrame([("a", 1, D1)], schema), path, ["date", "k"], scratch, ["date"])
    twice = spark.createDataFrame([("a", 2, D1), ("a", 3, D1)], schema)
    with pytest.raises(AmbiguousMergeError):
        tables.upsert(twice, path, ["date", "k"], scratch, ["date"])
    with pytest.raises(ValueError):
        tables.upsert(twice, path, ["k"], scratch, ["date"])
    assert tables.read_table(spark, path).count() == 1


@pytest.mark.skipif(importlib.util.find_spec("delta") is not None, reason="package present")
def test_delta_without_the_package_says_so(spark, tmp_path):
    with pytest.raises(RuntimeError):
        tables._delta_merge(spark.range(1), str(tmp_path), ["id"], update=False)


def test_type_drift_is_refused_before_writing(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append(spark.createDataFrame([("a", "1")], "k string, v string"), path)
    with pytest.raises(tables.TypeDriftError):
        tables.append(spark.createDataFrame([("b", 2.0)], "k string, v double"), path)
    assert tables.read_table(spark, path).count() == 1


def test_first_write_has_few_files_per_date(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(4000).selectExpr("id AS k", "id % 10 AS date").repartition(8)
    tables.merge_insert(rows, path, ["k"], ["date"])
    for folder in (tmp_path / "t").glob("date=*"):
        assert len(list(folder.glob("part-*"))) <= 2


def test_null_keys_stay_out_of_the_join(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    source = spark.createDataFrame([(None, 2), (None, 3), ("a", 4), ("b", 5)], "k string, v int")
    got = merge.unmatched(target, source, ["k"])
    assert sorted(r["v"] for r in got.collect()) == [2, 3, 5]


def test_types_grow_with_what_is_written(spark, tmp_path, scratch):
    path = str(tmp_path / "t")

    def put(rows, kind):
        tables.append(spark.createDataFrame(rows, f"k string, v {kind}"), path)

    put([("a", 1)], "int")
    put([("b", 2 ** 40)], "bigint")
    put([("c", 2.5)], "double")
    put([("d", 7), ("e", None)], "int")
    got = tables.read_table(spark, path)
    assert dict(got.dtypes)["v"] == "double"
    assert {r["k"]: r["v"] for r in got.collect()} == {"a": 1.0, "b": 2.0 ** 40, "c": 2.5, "d": 7.0,
                                                       "e": None}
    tables.upsert(spark.createDataFrame([("a", 9), ("f", 10)], "k string, v bigint"), path, ["k"], scratch)
    assert {r["k"]: r["v"] for r in tables.read_table(spark, path).collect()} == {
        "a": 9.0, "b": 2.0 ** 40, "c": 2.5, "d": 7.0, "e": None, "f": 10.0}
    for write in (lambda df: tables.append(df, path), lambda df: tables.upsert(df, path, ["k"], scratch)):
        with pytest.raises(tables.TypeDriftError):
            write(spark.createDataFrame([("a", "text")], "k string, v string"))
    assert tables.read_table(spark, path).count() == 6


def test_types_grow_in_upserts_of_partitions(spark, tmp_path, scratch):
    path = str(tmp_path / "t")

    def put(rows, kind):
        tables.upsert(spark.createDataFrame(rows, f"k string, v {kind}, date date"), path, ["date", "k"],
                      scratch, ["date"])

    put([("a", 1, D1), ("b", 1, D2)], "int")
    put([("a", 1.5, D1), ("c", 2.5, D3)], "double")
    got = tables.read_table(spark, path).select("k", "v", "date")
    assert rowset(got) == sorted(map(str, [("a", 1.5, D1), ("b", 1.0, D2), ("c", 2.5, D3)]))
    with pytest.raises(tables.TypeDriftError):
        tables.append(spark.createDataFrame([("a", 1.0, "x")], "k string, v double, date string"), path,
                      ["date"])


@pytest.mark.parametrize("a, b, want", [
    ("int", "bigint", "bigint"), ("bigint", "decimal(10,2)", "decimal(22,2)"),
    ("decimal(38,0)", "decimal(10,5)", "double"), ("float", "int", "double"),
    ("array<int>", "array<double>", "array<double>"), ("string", "int", None),
    ("struct<a:int>", "struct<a:bigint,b:string>", "struct<a:bigint,b:string>"),
    ("date", "timestamp", None), ("boolean", "int", None), ("map<string,int>", "map<string,bigint>",
                                                           "map<string,bigint>"),
    ("struct<a:int>", "struct<a:string>", None), ("void", "date", "date")])
def test_supremum(a, b, want):
    from gaugeline.sources.widening import _parsed, supremum
    for x, y in ((a, b), (b, a)):
        got = supremum(_parsed(x), _parsed(y))
        assert (got and got.simpleString()) == want


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")


def test_merge_reads_the_batch_once_and_null_keys_are_spread(spark, tmp_path):
    for name in ("t", "s"):
        spark.range(1_000).selectExpr("cast(id AS string) AS k", "id AS v").write.parquet(
            str(tmp_path / name))
    target, source = (spark.read.parquet(str(tmp_path / n)) for n in ("t", "s"))
    assert scans(merge.unmatched(target, source, ["k"])) == 2
    many = source.select(F.lit(None).cast("string").alias("k"), "v")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = merge.unmatched(target, many, ["k"]).withColumn("p", F.spark_partition_id())
        assert parts.groupBy("p").count().agg(F.max("count")).first()[0] < 300
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_merge_prunes_partitions_and_filters_the_scan_by_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append(spark.range(3_000).selectExpr(
        "cast(id AS string) AS k", "date_add(DATE '2025-01-01', cast(id % 30 AS int)) AS date"), path,
        ["date"])
    batch_path = str(tmp_path / "b")
    spark.createDataFrame([("7", D1), ("8", None), ("x", D3)], "k string, date date").write.parquet(
        batch_path)
    target, batch = tables.read_table(spark, path), spark.read.parquet(batch_path)
    touched = tables._in_partitions(target, "date", batch)
    assert {r["date"] for r in touched.select("date").distinct().collect()} == {D1, D3}
    assert "dynamicpruning" in touched._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        held = tables._with_keys(target, batch, ["k"])
        plan = held._jdf.queryExecution().executedPlan().toString()
        assert "might_contain" in plan and "GreaterThanOrEqual(k,7)" in plan
        assert [r["k"] for r in held.collect()] == ["7", "8"]
    finally:
        spark.conf.unset("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
