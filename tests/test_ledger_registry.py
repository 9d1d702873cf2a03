import datetime as dt
import json

from gaugeline.operators import dimensions, ledger, registry
from gaugeline.sources.reference_data import read_fault_codes, read_ledger_document


def d(text):
    return dt.date.fromisoformat(text)


def dates(spark, *texts):
    return spark.createDataFrame([(d(t),) for t in texts], "date date")


def values(df):
    return sorted(str(r[0]) for r in df.select("date").collect())


def test_discover_skips_what_is_no_date(spark):
    paths = ["s3a://b/raw/location_01/2025/march/day14/a.json", "raw/location_02/2025/March/day14/b.json",
             "raw/location_02/2025/february/day31/c.json", "raw/location_02/20x5/march/day1/c.json",
             "raw/location_02/2025/smarch/day1/c.json", "raw/location_02/2025/march/daily/c.json",
             "raw/location_03/2024/february/day29/c.json", "raw/other/2025/march/day2/c.json",
             "raw/location_04/2025/april/day07/d.json", "raw/location_04/2025/april/day123/d.json"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    assert values(ledger.discover_dates(df)) == ["2024-02-29", "2025-03-14", "2025-04-07"]


def test_reconcile(spark):
    found = dates(spark, "2025-01-02", "2025-01-03", "2025-01-03")
    assert values(ledger.reconcile(None, found)) == ["2025-01-02", "2025-01-03"]
    merged = ledger.reconcile(dates(spark, "2025-01-01", "2025-01-05"), found)
    assert values(merged) == ["2025-01-01", "2025-01-02", "2025-01-03", "2025-01-05"]
    assert tuple(ledger.ledger_state(merged).first()) == (d("2025-01-05"), 4)


def test_overlap_decisions(spark):
    known = dates(spark, "2025-01-01", "2025-01-02")
    for request, decision in ((("2025-01-01", 2), "skip"), (("2025-01-02", 2), "partial"),
                              (("2025-02-27", 3), "proceed")):
        asked = ledger.run_dates(spark, d(request[0]), request[1])
        assert asked.count() == request[1]
        assert ledger.overlap(asked, known).first()["decision"] == decision


def test_next_window(spark):
    row = ledger.next_window(dates(spark, "2024-12-31"), d("2020-01-01"), 2).first()
    assert (row["start"], row["end"]) == (d("2025-01-01"), d("2025-01-02"))
    row = ledger.next_window(spark.createDataFrame([], "date date"),
                             d("2020-01-01")).first()
    assert (row["start"], row["end"]) == (d("2020-01-01"), d("2020-01-01"))


def test_ledger_document(spark, tmp_path):
    path = tmp_path / "ledger.json"
    path.write_text(json.dumps({
        "latest_date": "2025-01-02", "generated_dates": ["2025-01-01", "2025-01-02", "bad"],
        "run_history": [{"start": "2025-01-01", "end": "2025-01-02", "days": 2, "note": "n"}]}))
    days, runs = read_ledger_document(spark, str(path))
    assert values(days) == ["2025-01-01", "2025-01-02"]
    assert tuple(runs.first()) == (d("2025-01-01"), d("2025-01-02"), 2, None, "n")


def topology(spark):
    machines = spark.createDataFrame([("HVAC-01-01", "LOC-01", "Maker", "X"),
                                      ("HVAC-12-03", "LOC-12", "Maker", "Y")],
                                     "hvacMachineId string, locationId string, manufacturer string, "
                                     "model string")
    locations = spark.createDataFrame([("LOC-01", "C1", "A", "a", "", "u"), ("LOC-12", "C1", "B", "b", "", "u")],
                                      "locationId string, companyId string, locationName string, "
                                      "city string, state string, country string")
    companies = spark.createDataFrame([("C1", "Acme", "Works", "SMB")],
                                      "companyId string, companyName string, industry string, accountType string")
    return machines, locations, companies


def test_registry_and_replacement(spark):
    swaps = spark.createDataFrame(
        [("HVAC-01-01", "compressor", "A", "COMP-9999", d("2026-03-15"))],
        "hvac_machine_id string, component_type string, circuit_id string, component_id string, "
        "effective_date date")
    before = registry.component_registry(*topology(spark), swaps, "2026-03-14")
    ids = {r["component_id"] for r in before.collect()}
    assert ids == {"COMP-0101A", "COMP-0101B", "COND-0101", "EVAP-0101", "EXV-0101A", "EXV-0101B",
                   "COMP-1203A", "COMP-1203B", "COND-1203", "EVAP-1203", "EXV-1203A", "EXV-1203B"}
    after = registry.component_registry(*topology(spark), swaps, "2026-03-15")
    changed = {r["component_id"] for r in after.collect()}
    assert changed - ids == {"COMP-9999"} and ids - changed == {"COMP-0101A"}
    assert {r["circuit_id"] for r in after.filter("component_type = 'condenser'").collect()} == {None}
    assert registry.component_registry(*topology(spark), None, "2026-03-15").count() == 12


def test_swaps_meet_machines_before_these_become_components(spark):
    schema = ("hvac_machine_id string, component_type string, circuit_id string, component_id string, "
              "effective_date date")
    swaps = spark.createDataFrame(
        [("HVAC-01-01", "compressor", "A", "older", d("2026-03-01")),
         ("HVAC-01-01", "compressor", "A", "b", d("2026-03-02")),
         ("HVAC-01-01", "compressor", "A", "a", d("2026-03-02")),
         ("HVAC-01-01", "condenser", None, "new", d("2026-03-02")),
         ("HVAC-01-01", "condenser", "A", "no such slot", d("2026-03-02")),
         ("HVAC-01-01", "boiler", None, "no such kind", d("2026-03-02")),
         ("HVAC-12-03", "evaporator", None, "dropped", d("2026-03-01")),
         ("HVAC-12-03", "evaporator", None, None, d("2026-03-02")),
         ("HVAC-12-03", "expansion_valve", "B", "undated", None),
         (None, "compressor", "A", "of no machine", d("2026-03-02"))], schema)
    machines, locations, companies = topology(spark)
    machines = machines.unionByName(spark.createDataFrame(
        [(None, "LOC-01", "Maker", "Z"), ("HVAC-12-03", "LOC-12", "Maker", "Y")], machines.schema))
    got = registry.component_registry(machines, locations, companies, swaps, "2026-03-15")
    ids = {}
    for r in got.collect():
        ids.setdefault(r["hvac_machine_id"], []).append(r["component_id"])
    assert sorted(ids["HVAC-01-01"]) == ["COMP-0101B", "EVAP-0101", "EXV-0101A", "EXV-0101B", "a", "new"]
    assert sorted(ids["HVAC-12-03"]) == sorted(2 * [
        "COMP-1203A", "COMP-1203B", "COND-1203", "EVAP-1203", "EXV-1203A", "EXV-1203B"])
    assert len(ids[None]) == 6 and "of no machine" not in ids[None]

    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    # A plan is printed from its last step to its first.
    assert plan(got).index("Generate explode") < plan(got).index("LeftOuter")
    manifest = registry.fleet_manifest(got)
    assert "LeftOuter" not in plan(manifest)
    assert "LeftOuter" not in plan(registry.fleet_totals(manifest))


def test_manifest_and_totals(spark):
    parts = registry.component_registry(*topology(spark), None, "2025-01-01")
    manifest = registry.fleet_manifest(parts)
    assert {(r["location_id"], r["machine_count"], r["component_count"]) for r in manifest.collect()} == {
        ("LOC-01", 1, 6), ("LOC-12", 1, 6)}
    totals = registry.fleet_totals(manifest).first()
    assert (totals["location_count"], totals["machine_count"], totals["component_count"],
            totals["compressor_count"], totals["condenser_count"]) == (2, 2, 12, 4, 2)


def test_fault_dictionary_defaults(spark, tmp_path):
    path = tmp_path / "codes.json"
    path.write_text(json.dumps({"codes": {"7": {"label": "L"}, "12": {"severity": "WARNING"}}}))
    got = {r["fault_code_key"]: r for r in dimensions.dim_fault_code(
        read_fault_codes(spark, str(path))).collect()}
    assert (got[7]["fault_code"], got[7]["fault_description"], got[7]["severity"]) == ("7", "L", "")
    assert got[12]["is_active"] and got[12]["recommended_action"] == ""


def test_fault_code_keys_are_nullable(spark):
    codes = spark.createDataFrame([(288,)], "fault_code_key bigint")
    rows = spark.createDataFrame([("a", 288.0), ("b", 1.0), ("c", None)],
                                 "event_id string, health_active_fault_code double")
    got = {r["event_id"]: r["fault_code_key"] for r in dimensions.with_fault_code_key(rows, codes).collect()}
    assert got == {"a": 288, "b": None, "c": None}


def test_calendar(spark):
    got = {str(r["date"]): r for r in dimensions.dim_date(
        dates(spark, "2024-12-29", "2024-12-30", "2025-01-04", "2025-01-04")).collect()}
    assert len(got) == 3
    sunday, monday, saturday = got["2024-12-29"], got["2024-12-30"], got["2025-01-04"]
    assert (sunday["day_of_week"], sunday["is_weekend"]) == (1, True)
    assert (monday["day_of_week"], monday["is_weekend"], monday["quarter"]) == (2, False, 4)
    assert (saturday["day_of_week"], saturday["is_weekend"], saturday["year"]) == (7, True, 2025)


def test_history_lists_the_dates_of_each_run(spark, tmp_path):
    from gaugeline.plans import ledger as plan
    from gaugeline.sources.tables import read_table
    document = tmp_path / "ledger.json"
    document.write_text(json.dumps({
        "latest_date": "2025-01-02", "generated_dates": ["2025-01-01"], "run_history": [
            {"start": "2025-01-01", "end": "2025-01-02", "days": 2, "dates_added": ["2025-01-02", "x"]},
            {"start": "2025-01-09", "end": "2025-01-09", "days": 1}]}))
    where = str(tmp_path / "ledger")
    plan.import_document(spark, where, str(document))
    plan.record_run(spark, where, d("2025-02-28"), 2)
    runs = {str(r["start"]): r["dates_added"] for r in read_table(spark, f"{where}/runs").collect()}
    assert runs == {"2025-01-01": [d("2025-01-02")], "2025-01-09": [],
                    "2025-02-28": [d("2025-02-28"), d("2025-03-01")]}
    assert values(read_table(spark, f"{where}/dates")) == ["2025-01-01", "2025-01-02", "2025-02-28",
                                                           "2025-03-01"]
    known = ledger.reconcile(None, dates(spark, "2025-05-05"), read_table(spark, f"{where}/runs"))
    assert values(known) == ["2025-01-02", "2025-02-28", "2025-03-01", "2025-05-05"]
