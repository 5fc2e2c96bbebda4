"""A whole small warehouse: land, validate, model, test, rerun, second delivery."""

import json

import pytest
from pyspark.sql import functions as F

from fieldgap.operators.incremental import first_versions, next_history
from fieldgap.plans import marts, reports
from fieldgap.plans import refresh as plan
from fieldgap.plans.reference import COMPLAINT_COLUMNS, FITMENT_FEED_COLUMNS, PART_FEED_COLUMNS, RECALL_COLUMNS
from fieldgap.plans.refresh import DataTestError, Inputs, refresh
from fieldgap.plans.suite import several_vehicles_per_complaint
from fieldgap.sources.store import Warehouse

YEAR = 2025


def tabbed(columns, records):
    return "".join("\t".join(str(r.get(c, "")) for c in columns) + "\n" for r in records)


def complaint(cmplid, odino, **cells):
    base = {
        "cmplid": cmplid, "odino": odino, "maketxt": "HONDA", "modeltxt": "CIVIC", "yeartxt": "2018", "crash": "N", "fire": "N",
        "injured": "0", "deaths": "0", "compdesc": "STEERING", "state": "CA", "vin": "V", "datea": "20240110", "ldate": "20240105",
        "faildate": "20240101", "miles": "1000", "cdescr": "text", "cmpl_type": "IVOQ", "prod_type": "V",
    }
    return {**base, **cells}


COMPLAINTS = [
    complaint(1, 100, compdesc="STEERING:COLUMN", injured="2"),
    complaint(2, 100, compdesc="SERVICE BRAKES", injured="2", crash="Y", cdescr="a longer text"),
    complaint(3, 100, compdesc="AIR BAGS", injured="2"),
    complaint(4, 101, modeltxt="CIVIC HYBRID", ldate="20200101"),
    complaint(5, 102, maketxt="HARLEY", modeltxt="GLIDE"),
    complaint(6, 103, yeartxt="9999"),
    complaint(7, 104, yeartxt="20l5"),
    complaint(8, 105, maketxt="Chevy", modeltxt="SILVERADO 2500 HD", yeartxt="2020", compdesc="ENGINE"),
    complaint(9, 106, prod_type="T"),
    complaint(10, 107, compdesc=""),
]
RECALLS = [
    {
        "record_id": i, "campno": "20V1", "maketxt": make, "modeltxt": model, "yeartxt": "2018", "compname": comp,
        "rcltypecd": kind, "potaff": "1000", "rcdate": "20200601", "odate": "20200701", "desc_defect": "d" * i, "mfgname": f"M{i}",
        "do_not_drive": "Yes" if i == 2 else "No",
    }
    for i, (make, model, comp, kind) in enumerate(
        [
            ("HONDA", "CIVIC", "STEERING", "V"), ("HONDA", "CIVIC", "STEERING", "V"), ("HONDA", "CIVIC", "SEATS", "V"),
            ("ACME", "BUS", "SEATS", "V"), ("HONDA", "CIVIC", "TIRES", "T"),
        ],
        start=1,
    )
]
PARTS = [
    ("AB12345", "Steering", "10.00", "Active"), ("AB12346", "Brakes", "20.00", "Active"), ("AB12347", "Brakes", "30.00", "Discontinued"),
    ("AB12345", "Steering", "99.00", "Active"), ("ab12348-", "Brakes", "5.00", "Active"), ("AB12349", "", "5.00", "Active"),
    ("AB12350", "Brakes", "N/A", "Pending"), ("AB12351", "Brakes", "0", "Active"),
]
FITMENT = [
    ("AB12345", "Honda", "Civic", "2017", "2019", "Front", ""), ("AB12345", "Honda", "Civic", "2017", "2019", "Front", "later copy"),
    ("AB12346", "Chevy", "Silverado HD", "2020", "2020", "", "Interchange"), ("AB12347", "HONDA", "  Civic ", "2018", "2018", "Rear", ""),
    ("AB12345", "TOYTOA", "Camry", "2018", "2018", "", ""), ("AB12345", "HONDA", "", "2018", "2018", "", ""),
    ("AB12345", "HONDA", "Civic", "2019", "2017", "", ""), ("AB12345", "HONDA", "Civic", "2099", "2099", "", ""),
    ("AB12345", "HONDA", "Civic", "20l5", "2018", "", ""), ("XX99999", "HONDA", "Civic", "2018", "2018", "", ""),
]


def csv(columns, records):
    return ",".join(columns) + "\n" + "".join(",".join(r) + "\n" for r in records)


def part_lines(parts):
    return [(n, "Apex", "Kind", c, "text", p, s, "2015-03-01", "") for n, c, p, s in parts]


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("refresh")
    (root / "recalls.txt").write_text(tabbed(RECALL_COLUMNS, RECALLS))
    (root / "complaints.txt").write_text(tabbed(COMPLAINT_COLUMNS, COMPLAINTS))
    for kind in ("years", "types"):
        (root / kind).mkdir()
    models = [("HONDA", 1, "Civic", "Passenger Car", 2018), ("CHEVROLET", 2, "Silverado HD", "Truck", 2020), ("HONDA", 3, "Fit", "Passenger Car", 2018)]
    for make, number, name, kind, year in models:
        item = {"Make_ID": 1, "Make_Name": make, "Model_ID": number, "Model_Name": name}
        for folder, criteria, extra in (("years", f"Make:{make} | ModelYear:{year}", {}), ("types", f"Make:{make} | VehicleType:x", {"VehicleTypeName": kind})):
            (root / folder / f"{number}.json").write_text(json.dumps({"SearchCriteria": criteria, "Results": [{**item, **extra}]}))
    (root / "parts.csv").write_text(csv(PART_FEED_COLUMNS, part_lines(PARTS)))
    (root / "fitment.csv").write_text(csv(FITMENT_FEED_COLUMNS, FITMENT))
    inputs = Inputs(
        as_of_year=YEAR,
        flat_files={"recalls_post_2010": str(root / "recalls.txt"), "complaints_2015_2019": str(root / "complaints.txt")},
        reference_years=str(root / "years"),
        reference_types=str(root / "types"),
        parts_feed=str(root / "parts.csv"),
        fitment_feed=str(root / "fitment.csv"),
    )
    wh = Warehouse(spark, str(root / "wh"))
    refresh(spark, wh, inputs)
    return root, wh, inputs


def test_header_collapse(built):
    _, wh, _ = built
    facts = {r.complaint_id: r for r in wh.read("marts.fct_complaint").collect()}
    assert sorted(facts) == [100, 101, 105, 107]
    one = facts[100]
    assert (one.is_crash, one.injuries, one.components_cited, one.is_severe, one.narrative) == (True, 2, 3, True, "a longer text")
    campaign = wh.read("marts.dim_recall_campaign").first()
    assert (campaign.units_affected, campaign.vehicles_named, campaign.components_named, campaign.do_not_drive) == (1000, 1, 2, True)
    assert campaign.defect_summary == "dddd"


def test_conformance_and_universe(built):
    _, wh, _ = built
    methods = {r.source_model_norm: (r.model_norm, r.match_method) for r in wh.read("intermediate.int_model_conformance").collect()}
    assert methods == {
        "CIVIC": ("CIVIC", "exact"), "CIVIC HYBRID": ("CIVIC", "prefix"), "SILVERADO 2500 HD": ("SILVERADO HD", "rule"),
    }
    seen = {(r.model_norm, r.model_year): (r.in_vpic, list(r.seen_in), r.model_name) for r in wh.read("marts.dim_vehicle").collect()}
    assert seen[("CIVIC", 2018)] == (True, ["catalog", "complaint", "recall"], "Civic")
    assert seen[("FIT", 2018)] == (True, [], "Fit") and seen[("CIVIC", 2017)][:2] == (False, ["catalog"])


def test_feed_contract(built):
    _, wh, _ = built
    quarantined = {r.part_number: r["_reasons"] for r in wh.read("quarantine.catalog_parts").collect()}
    assert quarantined == {
        "AB12345": "duplicate_part_number", "ab12348-": "malformed_part_number", "AB12349": "unknown_part_category",
        "AB12350": "invalid_price,invalid_status", "AB12351": "invalid_price",
    }
    reasons = sorted(r["_reasons"] for r in wh.read("quarantine.catalog_fitment").collect())
    assert reasons == ["invalid_year", "invalid_year", "missing_model", "orphan_part_number", "reversed_year_range", "unknown_make"]
    fitment = wh.read("bronze.catalog_fitment")
    assert fitment.count() == 3 and fitment.filter("note = 'later copy'").count() == 0
    flags = {r.part_number: (r.make_standardized, r.model_standardized) for r in fitment.collect()}
    assert flags == {"AB12345": (True, False), "AB12346": (True, False), "AB12347": (False, True)}
    for run in reports.feed_summary(wh.read("meta.catalog_dq_runs")).collect():
        assert run.rows_in == run.rows_valid + run.rows_quarantined + run.deduplicated


def test_every_data_test_is_recorded(built):
    _, wh, _ = built
    results = wh.log("meta.test_results")
    assert results.where("resource_type = 'test'").groupBy("invocation_id").count().first()["count"] == 50
    written = results.where("resource_type <> 'test'").collect()
    assert {r.status for r in written} == {"success"} and all(r.seconds > 0 for r in written)
    assert {r.unique_id for r in written if r.resource_type == "snapshot"} == {"snapshots.snap_catalog_parts"}
    assert len({r.invocation_id for r in results.select("invocation_id").collect()}) == 1
    counts = {r.resource_type: r for r in reports.latest_test_status(results).collect()}
    assert counts["test"]["pass"] + counts["test"]["warn"] == 50 and counts["model"]["success"] == len(written) - 1
    runs, more = reports.run_history(wh.log("meta.pipeline_runs"), 3)
    assert runs.count() == 3 and more.first().truncated
    failing = {r.unique_id for r in reports.failing_nodes(results).collect()}
    assert failing == set()
    stages = {r.stage for r in wh.log("meta.pipeline_runs").collect()}
    assert stages == {"land", "reference", "catalog", "models", "tests"}


def test_rerun_without_changes_rebuilds_nothing(spark, built):
    _, wh, inputs = built
    before = wh.read("marts.mart_coverage_gap").inputFiles()
    again = refresh(spark, wh, Inputs(as_of_year=YEAR, flat_files=inputs.flat_files))
    assert {r.status for r in again} == {"unchanged"}
    assert wh.read("marts.mart_coverage_gap").inputFiles() == before
    refresh(spark, wh, inputs)
    assert wh.read("marts.mart_coverage_gap").inputFiles() == before
    latest = wh.log("meta.ingest_manifest").orderBy(F.desc("loaded_at")).limit(2).collect()
    assert {(r.source, r.status) for r in latest} == {("reference", "unchanged"), ("catalog", "unchanged")}


def test_ad_hoc_sql(spark, built):
    _, wh, _ = built
    m = {"dim_vehicle": wh.read("marts.dim_vehicle")}
    rows, flag = reports.ask(spark, "select make from {dim_vehicle} where model_year >= ? order by make", m, [2017], limit=2)
    assert rows.count() == 2 and tuple(flag.first()) == (2, True)


def test_failed_builds_are_made_up_for(spark, built, monkeypatch):
    """A delivery that landed before a failure reaches the marts with the next run."""
    root, wh, inputs = built
    (root / "extra.txt").write_text(tabbed(COMPLAINT_COLUMNS, [complaint(30, 300, compdesc="STEERING")]))
    later = Inputs(as_of_year=YEAR, flat_files={**inputs.flat_files, "complaints_2020_2024": str(root / "extra.txt")})
    before = wh.read("marts.fct_complaint").count()

    def broken(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(plan, "write_models", broken)
        with pytest.raises(RuntimeError, match="lost"):
            refresh(spark, wh, later)
    with monkeypatch.context() as patch:
        patch.setattr(plan.marts, "mart_component_trends", broken)
        with pytest.raises(RuntimeError, match="lost"):
            refresh(spark, wh, later)
    assert wh.read("marts.fct_complaint").count() == before
    vehicles = marts.dim_vehicle
    with monkeypatch.context() as patch:
        patch.setattr(plan.marts, "dim_vehicle", lambda rows, year: vehicles(rows, year).withColumn("make", F.lit(None).cast("string")))
        with pytest.raises(DataTestError, match="dim_vehicle"):
            refresh(spark, wh, later)
    assert wh.read("marts.fct_complaint").count() == before
    again = refresh(spark, wh, later)
    assert {r.status for r in again} == {"unchanged"}
    assert wh.read("marts.fct_complaint").filter("complaint_id = 300").count() == 1
    (root / "extra.txt").write_text("")
    refresh(spark, wh, later, run_tests=False, drop_vanished=True)


def test_parameters_are_part_of_the_build(spark, built):
    _, wh, inputs = built
    quiet = inputs.flat_files
    ages = lambda: {r.model_year: r.vehicle_age_years for r in wh.read("marts.dim_vehicle").collect()}
    now = ages()
    refresh(spark, wh, Inputs(as_of_year=YEAR + 5, flat_files=quiet), run_tests=False)
    assert ages() != now
    refresh(spark, wh, Inputs(as_of_year=YEAR, flat_files=quiet), run_tests=False)
    assert ages() == now


def test_lines_count_with_their_place(spark, tmp_path):
    (tmp_path / "a.csv").write_text("h\n1\n2\n")
    (tmp_path / "b.csv").write_text("h\n2\n1\n")
    state = lambda *args: plan.delivery_state(spark, *args)
    a, b = [str(tmp_path / "a.csv")], [str(tmp_path / "b.csv")]
    assert state(a, 1) == state(a, 1) and state(a, 1)[0] == 3
    assert len({state(a, 1)[1], state(a, 2)[1], state(b, 1)[1]}) == 3


def test_half_a_pair_is_refused(spark, built):
    _, wh, inputs = built
    with pytest.raises(ValueError, match="parts_feed"):
        refresh(spark, wh, Inputs(as_of_year=YEAR, parts_feed=inputs.parts_feed))


def test_history_takes_new_and_missing_columns(spark):
    first = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, price int, old string")
    history = first_versions(first, F.lit("2024-01-01").cast("timestamp"))
    second = spark.createDataFrame([("a", 1, "n"), ("b", 3, "m")], "k string, price int, extra string")
    rows = next_history(history, second, "k", ["price"], F.lit("2024-02-01").cast("timestamp")).collect()
    found = sorted(((r.k, r.price, r.old, r.extra, r.valid_to is None) for r in rows), key=str)
    assert found == [("a", 1, "x", None, True), ("b", 2, "y", None, False), ("b", 3, None, "m", True)]


def test_second_delivery_updates_facts_and_history(spark, built):
    root, wh, inputs = built
    # A correction moves complaint 100 to one component, a re-delivered row wins by load time.
    newer = [complaint(2, 100, compdesc="SERVICE BRAKES", crash="N", injured="1", datea="20240301"), complaint(20, 200, compdesc="ENGINE")]
    (root / "later.txt").write_text(tabbed(COMPLAINT_COLUMNS, newer))
    changed = [(n, c, "12.00" if n == "AB12345" else p, s) for n, c, p, s in PARTS if n != "AB12347"]
    (root / "parts.csv").write_text(csv(PART_FEED_COLUMNS, part_lines(changed + [("AB12399", "Brakes", "1.00", "Active")])))
    refresh(
        spark, wh,
        Inputs(
            as_of_year=YEAR,
            flat_files={**inputs.flat_files, "complaints_2020_2024": str(root / "later.txt")},
            parts_feed=inputs.parts_feed, fitment_feed=inputs.fitment_feed,
        ),
        run_tests=False,
    )
    incremental = wh.read("marts.fct_complaint")
    full = marts.fct_complaint(wh.read("staging.stg_complaints"), wh.read("intermediate.int_model_conformance"))
    assert sorted(map(str, incremental.select(*full.columns).collect())) == sorted(map(str, full.collect()))
    assert incremental.filter("complaint_id = 200").count() == 1
    bridge = wh.read("marts.fct_complaint_component")
    assert bridge.filter("complaint_id = 100").count() == 3

    history = wh.read("snapshots.snap_catalog_parts")
    several = {r.part_number for r in wh.read("marts.dim_part").filter("version_count > 1").collect()}
    assert several == {"AB12345"}
    closed = {r.part_number for r in history.filter(F.col("valid_to").isNotNull()).collect()}
    assert closed == {"AB12345", "AB12347"}
    assert {r.part_number for r in wh.read("marts.dim_part").collect()} == {"AB12345", "AB12346", "AB12399"}


def test_vanished_complaints_can_be_dropped(spark, built):
    root, wh, inputs = built
    before = wh.read("marts.fct_complaint").count()
    (root / "later.txt").write_text(tabbed(COMPLAINT_COLUMNS, [complaint(20, 200, compdesc="STEERING")]))
    later = Inputs(as_of_year=YEAR, flat_files={**inputs.flat_files, "complaints_2020_2024": str(root / "later.txt")})
    refresh(spark, wh, later, run_tests=False)
    assert wh.read("marts.fct_complaint").count() == before
    (root / "later.txt").write_text("")
    refresh(spark, wh, later, run_tests=False, drop_vanished=True)
    assert wh.read("marts.fct_complaint").filter("complaint_id = 200").count() == 0
    assert wh.read("marts.fct_complaint_component").filter("complaint_id = 200").count() == 0
    assert wh.read("marts.fct_complaint").count() == before - 1


def test_changed_conformance_moves_old_complaints(spark):
    rows = spark.createDataFrame(
        [(1, 10, "HONDA", "CIVIC HYBRID", 2018, 1), (2, 11, "HONDA", "FIT", 2018, 1)],
        "complaint_component_id long, complaint_id long, make string, model_norm string, model_year int, t int",
    )
    extra = {
        "component_path": "A", "narrative": "n", "owner_state": "CA", "complaint_source": "x",
    }
    staged = rows.withColumns({k: F.lit(x) for k, x in extra.items()}).withColumns(
        {
            **{c: F.lit(False) for c in ("is_crash", "is_fire", "needed_medical_attention", "vehicle_towed")},
            **{c: F.lit(0) for c in ("injuries", "deaths", "odometer_miles")},
            **{c: F.lit("2024-01-01").cast("date") for c in ("received_date", "failure_date")},
            "_loaded_at": F.lit("2024-01-01").cast("timestamp"),
        }
    )
    schema = "make string, source_model_norm string, model_year int, model_norm string, match_method string"
    before = spark.createDataFrame([("HONDA", "CIVIC HYBRID", 2018, "CIVIC HYBRID", "unmatched"), ("HONDA", "FIT", 2018, "FIT", "exact")], schema)
    now = spark.createDataFrame([("HONDA", "CIVIC HYBRID", 2018, "CIVIC", "prefix"), ("HONDA", "FIT", 2018, "FIT", "exact")], schema)
    first = marts.fct_complaint(staged, before)
    moved = marts.fct_complaint(staged, now, first, marts.renamed_models(before, now))
    full = marts.fct_complaint(staged, now)
    assert {(r.complaint_id, r.vehicle_key) for r in moved.collect()} == {(r.complaint_id, r.vehicle_key) for r in full.collect()}


def test_complaints_with_several_vehicles_are_found_by_whole_names(spark):
    rows = spark.createDataFrame(
        [
            (1, "A", "B|1|C", 2018), (1, "1|C|A", "B", 2018),
            (2, "FORD", "F 150", 2018), (2, "FORD", "F 150", 2018),
            (3, "FORD", "F 150", 2018), (3, "FORD", "F 150", 2019),
            (4, "FORD", "F 150", 2018), (4, None, "F 250", 2018), (4, "FORD", "", 2018), (4, "FORD", "F 250", None),
            (None, "FORD", "F 150", 2018), (None, "HONDA", "FIT", 2018), (None, "HONDA", "FIT", 2018),
        ],
        "complaint_id long, make string, model_norm string, model_year int",
    )
    found = {r.complaint_id: r.vehicles for r in several_vehicles_per_complaint(rows).collect()}
    assert found == {1: 2, 3: 2, None: 2}


def test_untested_builds_do_not_count_as_tested(spark, built, monkeypatch):
    """Models published without tests are built again, and tested, by the next refresh that tests."""
    _, wh, inputs = built
    quiet = Inputs(as_of_year=YEAR + 7, flat_files=inputs.flat_files)
    vehicles = marts.dim_vehicle
    with monkeypatch.context() as patch:
        patch.setattr(plan.marts, "dim_vehicle", lambda rows, year: vehicles(rows, year).withColumn("make", F.lit(None).cast("string")))
        refresh(spark, wh, quiet, run_tests=False)
    assert wh.read("marts.dim_vehicle").where("make is null").count() > 0
    runs = wh.log("meta.test_results").where("resource_type = 'test'").select("invocation_id").distinct().count()
    refresh(spark, wh, quiet)
    assert wh.read("marts.dim_vehicle").where("make is null").count() == 0
    assert wh.log("meta.test_results").where("resource_type = 'test'").select("invocation_id").distinct().count() == runs + 1
    files = wh.read("marts.dim_vehicle").inputFiles()
    refresh(spark, wh, quiet)
    refresh(spark, wh, quiet, run_tests=False)
    assert wh.read("marts.dim_vehicle").inputFiles() == files
