import json

import pytest
from pyspark.sql import types as T

from gaugeline import schemas
from gaugeline.operators import documents as op
from gaugeline.plans import ingest
from gaugeline.sources.tables import read_table
from gaugeline.streaming.ingest import stream_raw_to_bronze

DOC = {"componentId": "C1", "componentType": "compressor", "circuitId": "A"}


def texts(spark, *rows):
    return spark.createDataFrame([(r if isinstance(r, str) or r is None else json.dumps(r), f"f{k}")
                                  for k, r in enumerate(rows)], "text string, path string")


def read(spark, *rows, schema=None):
    return op.document_readings(op.parse_documents(texts(spark, *rows), schema), schema)


def record(event, **more):
    return {"eventId": event, "timestamp": "1740787200000", **more}


def test_texts_that_are_no_documents_keep_text_and_reason(spark):
    good = {**DOC, "records": [record("a")]}
    broken, cut = '{"componentId": C1}', json.dumps(good)[:-4]
    rows = read(spark, good, broken, cut, "12", '"text"', "null", {**DOC, "records": "none"},
                [good, 5], [{**DOC, "records": [record("b")]}, {**DOC, "records": [record("c")]}],
                "", " \n ", None, {**DOC, "records": None}, {**DOC, "records": []}, "[]",
                {**DOC, "records": [record("d"), 7]}, json.dumps([good])[:-6])
    assert sorted(r["eventId"] for r in op.readings(rows).collect()) == ["a", "b", "c"]
    dead = {(r["path"], r["reason"]) for r in op.unreadable(rows).collect()}
    assert dead == {("f1", op.MALFORMED), ("f2", op.MALFORMED), ("f3", op.NO_DOCUMENT),
                    ("f4", op.NO_DOCUMENT), ("f5", op.NO_DOCUMENT), ("f6", op.OTHER_KIND),
                    ("f7", op.OTHER_KIND), ("f15", op.OTHER_KIND), ("f16", op.MALFORMED)}
    assert {r["path"]: r["text"] for r in op.unreadable(rows).collect()}["f2"] == cut


def test_known_fields_have_their_types_and_unknown_ones_are_kept(spark):
    doc = {**DOC, "readingIntervalSeconds": "60", "recordCount": 2.0, "siteTag": "s", "tier": 3,
           "records": [record("a", cop=4.5, noiseDb=61, circuitId="B", tags=["x"], siteTag="inner"),
                       record("b", cop="4.5", noiseDb=61.5, healthActiveFaultCode=float("nan"),
                              deep={"k": [1]}, none=None)]}
    rows = op.readings(read(spark, doc, {**DOC, "records": [record("c")]}))
    fields = op.unknown_fields(rows)
    assert fields == {"siteTag": "STRING", "tier": "BIGINT", "noiseDb": "DECIMAL(21,1)",
                      "tags": "ARRAY<STRING>", "deep": "OBJECT<k: ARRAY<BIGINT>>"}
    flat = op.promote_unknown(rows, fields)
    assert dict(flat.dtypes)["noiseDb"] == "double" and op.LEFT_OVER not in flat.columns
    got = {r["eventId"]: r for r in flat.collect()}
    assert [got[k]["noiseDb"] for k in "abc"] == [61.0, 61.5, None]
    assert [got[k]["tier"] for k in "abc"] == [3, 3, None]
    assert got["a"]["siteTag"] == "s" and json.loads(got["b"]["deep"]) == {"k": [1]}
    assert (got["a"]["circuitId"], got["a"]["cop"], got["b"]["readingIntervalSeconds"],
            got["a"]["recordCount"], got["b"]["healthActiveFaultCode"]) == ("A", "4.5", 60, 2, None)


def test_fields_that_cannot_be_columns_stay_as_json(spark):
    doc = {**DOC, "records": [record("a", component_id=9, **{"a b": 1}, level="high", n=1),
                              record("b", level=5, n=2.5)]}
    rows = op.readings(read(spark, doc))
    flat = op.promote_unknown(rows, op.unknown_fields(rows), {"level": "bigint", "n": "bigint"})
    got = {r["eventId"]: r for r in flat.collect()}
    assert json.loads(got["a"][op.LEFT_OVER]) == {"component_id": 9, "a b": 1, "level": "high"}
    assert got["b"][op.LEFT_OVER] is None
    assert (got["a"]["level"], got["b"]["level"], got["b"]["n"]) == (None, 5, 2.5)
    few = op.unknown_fields(rows, most=1)
    assert json.loads(op.promote_unknown(rows, few).where("eventId = 'b'").first()[op.LEFT_OVER]) == {
        "component_id": None, "level": 5, "n": 2.5} or set(few) == {"a b", "component_id"}


def test_single_reading_documents(spark):
    doc = {"ingestionMode": "REALTIME", "companyId": "outer", "rawPayload": {
        **DOC, "companyId": "inner", "eventId": "r", "eventTimestamp": "1740787200000",
        "oilPressureKpa": "7", "building": "B1", "latitude": 1.5, "noiseDb": 9}}
    rows = op.readings(read(spark, doc, {**DOC, "records": [record("a")]}))
    flat = op.promote_unknown(rows, op.unknown_fields(rows))
    got = {r["eventId"]: r for r in flat.collect()}
    assert (got["r"]["componentId"], got["r"]["companyId"], got["r"]["timestamp"],
            got["r"]["oilPressureKpa"], got["r"]["building"], got["r"]["latitude"], got["r"]["noiseDb"],
            got["r"]["ingestionMode"]) == ("C1", "outer", 1_740_787_200_000, "7", "B1", "1.5", 9,
                                           "REALTIME")
    assert got["a"]["building"] is None and str(got["r"]["date"]) == "2025-03-01"


def test_extra_fields_of_the_schema(spark):
    schema = schemas.raw_schema({"noiseDb": T.DoubleType()}, {"siteTag": T.StringType()})
    doc = {**DOC, "siteTag": "s", "records": [record("a", noiseDb=2.5, more=1)]}
    rows = op.readings(read(spark, doc, schema=schema))
    assert op.unknown_fields(rows) == {"more": "BIGINT"}
    assert rows.select("noiseDb", "siteTag").first() == (2.5, "s")


@pytest.fixture()
def put(tmp_path):
    folder = tmp_path / "raw" / "location_01" / "2025" / "march" / "day1"
    folder.mkdir(parents=True)

    def write(name, doc):
        (folder / name).write_text(doc if isinstance(doc, str) else json.dumps(doc, indent=1))
    return write


def bronze(spark, tmp_path, name="compressor"):
    return read_table(spark, str(tmp_path / "bronze" / name))


def test_batch_job_keeps_everything(spark, tmp_path, put):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "bronze")
    put("a.json", {**DOC, "siteTag": "s", "records": [record("a", noiseDb=61)]})
    put("b.json", '{"componentId": "C1", "records": [{"eve')
    put("c.json", [{**DOC, "records": [record("c", fanSpeedRpm="3")]}])
    put("d.json", {**DOC, "componentType": "boiler", "records": [record("d")]})
    assert ingest.raw_to_bronze(spark, raw, out) == ["compressor"]
    put("e.json", {**DOC, "records": [record("e", noiseDb=61.5, siteTag=4), record("a", noiseDb=0)]})
    assert ingest.raw_to_bronze(spark, raw, out) == ["compressor"]
    got = {r["eventId"]: r for r in bronze(spark, tmp_path).collect()}
    assert set(got) == {"a", "c", "e"}
    assert [got[k]["noiseDb"] for k in "ace"] == [61.0, None, 61.5]
    assert [got[k]["siteTag"] for k in "ace"] == ["s", None, "4"]
    dead = bronze(spark, tmp_path, ingest.DEAD_DOCUMENTS).collect()
    assert [(r["reason"], r["text"][:14]) for r in dead] == [(op.MALFORMED, '{"componentId"')]


def test_stream_takes_both_forms_repeats_and_late_readings(spark, tmp_path, put):
    def run():
        stream_raw_to_bronze(spark, str(tmp_path / "raw"), str(tmp_path / "bronze"),
                             str(tmp_path / "cp"), max_files=1).awaitTermination()

    def single(event, at, value):
        return {"ingestionMode": "REALTIME", "rawPayload": {
            **DOC, "eventId": event, "timestamp": at, "cop": value, "noiseDb": 5}}

    put("1.json", {**DOC, "records": [record("a", cop="1"), record(None, cop="1"), record("a", cop="2")]})
    run()
    put("2.json", single("a", "1740787200000", "3"))
    put("3.json", single("r", "1740787200000", "4"))
    put("4.json", single("late", "1000", "5"))
    put("5.json", single("r", "1740787200000", "6"))
    put("6.json", {**DOC, "records": [record(None, cop="1")]})
    put("7.json", "{cut")
    run()
    rows = bronze(spark, tmp_path)
    got = sorted((r["eventId"] or "", r["cop"], r["noiseDb"]) for r in rows.collect())
    assert got[0] == got[1] == ("", "1", None)
    assert [g for g in got[2:] if g[0] != "a"] == [("late", "5", 5), ("r", "4", 5)]
    assert [g[1] in "12" for g in got if g[0] == "a"] == [True]
    assert bronze(spark, tmp_path, ingest.DEAD_DOCUMENTS).count() == 1
