"""Scans, landing, documents, feeds and the versioned warehouse, on files the tests write."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fieldgap.operators.checks import repeated_keys
from fieldgap.plans.reference import COMPLAINT_COLUMNS, PERSONAL_COLUMNS
from fieldgap.sources import documents, feeds
from fieldgap.sources.landing import land_flat_files
from fieldgap.sources.positional import FlatFileSpec, columns_seen, content_fingerprint, positional_columns, read_lines
from fieldgap.sources.store import Warehouse, sources_to_reload

SPECS = [
    FlatFileSpec(name, "nhtsa_complaints", tuple(COMPLAINT_COLUMNS), PERSONAL_COLUMNS) for name in ("complaints_a", "complaints_b")
]


def line(number, extra=0, **cells):
    values = {"cmplid": str(number), "odino": str(1000 + number), "maketxt": "HONDA", "vin": "1HG", **cells}
    return "\t".join([values.get(c, "") for c in COMPLAINT_COLUMNS] + ["more"] * extra)


def write(path, lines, newline="\n"):
    path.write_bytes((newline.join(lines) + newline).encode() if lines else b"")
    return str(path)


def test_positional_edges(spark, tmp_path):
    path = write(tmp_path / "f.txt", ["1\t a \t\t x y ", "2\tb", "3\tc\td\te\textra", '4\t"q\tt\r inside\tz'])
    lines = read_lines(spark, path)
    got = [tuple(r) for r in positional_columns(lines, ["id", "a", "secret", "c"], {"secret"}).orderBy("id").collect()]
    assert got == [("1", "a", "x y"), ("2", "b", None), ("3", "c", "e"), ("4", '"q', "z")]
    assert tuple(columns_seen(lines).first()) == (4, 5)
    windows = write(tmp_path / "w.txt", ["1\ta", "2\tb"], "\r\n")
    assert [r.a for r in positional_columns(read_lines(spark, windows), ["id", "a"]).orderBy("id").collect()] == ["a", "b"]


def test_fingerprint_ignores_order_but_not_content(spark, tmp_path):
    prints = [
        content_fingerprint(read_lines(spark, write(tmp_path / f"{i}.txt", data))).first().fingerprint
        for i, data in enumerate([["a", "b", "b"], ["b", "a", "b"], ["a", "b"], ["a", "b", "c"], []])
    ]
    assert prints[0] == prints[1] and len(set(prints)) == 4


def test_landing_is_idempotent_and_per_source(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    paths = {
        "complaints_a": write(tmp_path / "a.txt", [line(i) for i in range(3)]),
        "complaints_b": write(tmp_path / "b.txt", [line(i) for i in range(10, 12)]),
    }
    land = lambda **kw: [(r.source, r.status, r.rows) for r in land_flat_files(spark, wh, SPECS, paths, **kw)]
    assert land() == [("complaints_a", "loaded", 3), ("complaints_b", "loaded", 2)]
    assert land() == [("complaints_a", "unchanged", 0), ("complaints_b", "unchanged", 0)]
    bronze = wh.read("bronze.nhtsa_complaints")
    assert bronze.count() == 5 and not PERSONAL_COLUMNS & set(bronze.columns)

    write(tmp_path / "b.txt", [line(20)])
    assert land() == [("complaints_a", "unchanged", 0), ("complaints_b", "loaded", 1)]
    counts = {r["_source"]: r["count"] for r in wh.read("bronze.nhtsa_complaints").groupBy("_source").count().collect()}
    assert counts == {"complaints_a": 3, "complaints_b": 1}

    write(tmp_path / "b.txt", [])
    assert land()[1] == ("complaints_b", "loaded", 0)
    assert wh.read("bronze.nhtsa_complaints").select("_source").distinct().count() == 1
    assert land()[1] == ("complaints_b", "unchanged", 0)
    assert land(force=True)[0] == ("complaints_a", "loaded", 3)
    assert [r.source for r in sources_to_reload(wh.latest_loads(), wh.read("bronze.nhtsa_complaints")).collect()] == ["complaints_b"]
    statuses = wh.log("meta.ingest_manifest").groupBy("status").count().collect()
    assert {r.status: r["count"] for r in statuses} == {"loaded": 6, "unchanged": 6}


def test_lost_rows_are_loaded_again(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    paths = {"complaints_a": write(tmp_path / "a.txt", [line(1)])}
    land_flat_files(spark, wh, SPECS, paths)
    empty = wh.read("bronze.nhtsa_complaints").limit(0)
    wh.replace_source("bronze.nhtsa_complaints", "complaints_a", empty)
    assert land_flat_files(spark, wh, SPECS, paths)[0].status == "loaded"


def test_drift_is_recorded(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    paths = {"complaints_a": write(tmp_path / "a.txt", [line(1, extra=2), line(2, extra=2)])}
    result = land_flat_files(spark, wh, SPECS, paths)[0]
    assert (result.rows, result.columns_seen, result.columns_expected, result.drifted) == (2, 53, 51, True)
    logged = wh.log("meta.ingest_manifest").first()
    assert (logged.columns_seen, logged.columns_expected) == (53, 51)


def test_missing_file_raises(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    with pytest.raises(FileNotFoundError, match="complaints_a"):
        land_flat_files(spark, wh, SPECS, {"complaints_a": str(tmp_path / "none.txt")})


def test_quoted_line_breaks(spark, tmp_path):
    (tmp_path / "feed.csv").write_text('a,b\n1,"two\nlines"\n2,x\n')
    assert [(r.a, r.b) for r in feeds.read_feed(spark, str(tmp_path / "feed.csv"), ["a", "b"]).collect()] == [("1", "two\nlines"), ("2", "x")]


def test_publish_is_all_or_nothing(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.publish({"a.x": spark.range(2), "a.y": spark.range(3)})
    broken = spark.range(1).select(F.raise_error(F.lit("no")).alias("id"))
    with pytest.raises(Exception):
        wh.publish({"a.x": spark.range(9), "a.y": broken})
    assert (wh.read("a.x").count(), wh.read("a.y").count()) == (2, 3)
    wh.replace("a.x", wh.read("a.x").filter("id = 1"))
    assert wh.read("a.x").count() == 1 and wh.tables() == ["a.x", "a.y"] and not wh.exists("a.z")
    wh.register_views(["a.y"])
    assert spark.sql("select count(*) from y").first()[0] == 3
    with pytest.raises(KeyError):
        wh.read("a.z")


def test_reference_documents(spark, tmp_path):
    def document(name, criteria, results):
        (tmp_path / name).mkdir(exist_ok=True)
        path = tmp_path / name / f"{abs(hash(criteria))}.json"
        path.write_text(json.dumps({"Count": 1, "Message": "ok", "SearchCriteria": criteria, "Results": results}, indent=1))

    ford = {"Make_ID": 460, "Make_Name": "FORD", "Model_ID": 1801, "Model_Name": "F-150"}
    edge = {"Make_ID": 460, "Make_Name": "FORD", "Model_ID": 1800, "Model_Name": "Edge"}
    noise = {"Make_ID": 9, "Make_Name": "AFFORDABLE ALUMINUM", "Model_ID": 5, "Model_Name": "Trailer"}
    document("years", "Make:FORD | ModelYear:2020", [ford, edge, noise])
    document("years", "Make:KIA | ModelYear:2020", None)
    for kind, items in (
        ("Truck", [ford, edge, noise]), ("Multipurpose Passenger Vehicle (MPV)", [edge]), ("Passenger Car", []),
    ):
        document("types", f"Make:FORD | VehicleType:{kind}", [{**i, "VehicleTypeId": 1, "VehicleTypeName": kind} for i in items])
    got = documents.reference_models(
        documents.read_documents(spark, str(tmp_path / "years")), documents.read_documents(spark, str(tmp_path / "types")), ["FORD", "KIA"]
    )
    assert sorted(tuple(r) for r in got.collect()) == [
        (460, "FORD", 1800, "Edge", 2020, "Multipurpose Passenger Vehicle (MPV)"),
        (460, "FORD", 1801, "F-150", 2020, "Truck"),
    ]


def test_feed_keeps_empty_text_and_file_order(spark, tmp_path):
    (tmp_path / "f.csv").write_text('a,b\n1,\n2,""\n"3,x",NA\n' + "".join(f"{i},v\n" for i in range(4, 200)))
    rows = feeds.read_feed(spark, str(tmp_path / "f.csv"), ["a", "b"])
    got = [(r.a, r.b) for r in rows.orderBy(feeds.ORDINAL).collect()]
    assert got[:3] == [("1", ""), ("2", ""), ("3,x", "NA")] and [a for a, _ in got[3:]] == [str(i) for i in range(4, 200)]


def test_seed_and_export(spark, tmp_path):
    (tmp_path / "s.csv").write_text('k,flag\n"A, B",true\nC,false\n')
    seed = feeds.read_seed(spark, str(tmp_path / "s.csv"), "k string, flag boolean")
    assert {tuple(r) for r in seed.collect()} == {("A, B", True), ("C", False)}
    feeds.write_csv(seed, str(tmp_path / "out"))
    assert feeds.read_seed(spark, str(tmp_path / "out"), "k string, flag boolean").count() == 2


def test_manifest_latest(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    assert wh.latest_loads() is None
    at = [datetime(2024, 1, d) for d in (1, 2, 3)]
    wh.record_loads([("b1", "s", "u", None, None, "h1", 1, 1, 1, "loaded", at[0]), ("b2", "s", "u", None, None, "h2", 1, 1, 1, "loaded", at[1])])
    wh.record_loads([("b3", "s", "u", None, None, "h2", 0, 0, 1, "unchanged", at[2])])
    assert [r.sha256 for r in wh.latest_loads().collect()] == ["h2"]
    assert repeated_keys(wh.log("meta.ingest_manifest"), ["source"]).first().occurrences == 3


def test_rows_go_in_by_name(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.replace("a.t", spark.createDataFrame([], "k int, v string"))
    wh.insert_by_name("a.t", spark.createDataFrame([("x", 1)], "v string, k long"))
    wh.insert_by_name("a.t", spark.createDataFrame([(2,)], "k int"))
    assert sorted(tuple(r) for r in wh.read("a.t").collect()) == [(1, "x"), (2, None)]
    assert wh.read("a.t").dtypes == [("k", "int"), ("v", "string")]
    with pytest.raises(ValueError, match="no column w"):
        wh.insert_by_name("a.t", spark.createDataFrame([(1, 2)], "k int, w int"))


def test_kinds_of_models(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    first, second = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, "c")], "k int, v string")
    wh.materialize("a.seen", first, "view")
    assert spark.table("seen").count() == 2 and not wh.exists("a.seen")
    for rows in (first, second):
        wh.materialize("a.whole", rows, "table")
        wh.materialize("a.keyed", rows, "incremental", ["k"])
    assert [tuple(r) for r in wh.read("a.whole").collect()] == [(2, "c")]
    assert sorted(tuple(r) for r in wh.read("a.keyed").collect()) == [(1, "a"), (2, "c")]
    for mode in ("incremental", "other"):
        with pytest.raises(ValueError):
            wh.materialize("a.x", first, mode)


def test_exported_cells_keep_blanks_and_breaks(spark, tmp_path):
    rows = spark.createDataFrame([("1", " a ", 'b "c",\nd'), ("2", "", None)], "k string, v string, w string")
    feeds.write_csv(rows.orderBy("k"), str(tmp_path / "out"))
    back = feeds.read_feed(spark, str(tmp_path / "out"), ["k", "v", "w"]).select("k", "v", "w")
    assert sorted(tuple(r) for r in back.collect()) == [("1", " a ", 'b "c",\nd'), ("2", "", "")]
