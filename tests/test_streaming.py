"""Landing files as a stream: each file once, newest row per key, safe to rerun."""

from pyspark.sql import functions as F

from fieldgap.sources.positional import FlatFileSpec
from fieldgap.sources.store import Warehouse
from fieldgap.streaming.landing import arriving_rows, land_new_files, replace_by_key

SPEC = FlatFileSpec("s", "t", ("id", "v", "secret"), frozenset({"secret"}))


def test_stream_landing(spark, tmp_path):
    folder, wh = tmp_path / "in", Warehouse(spark, str(tmp_path / "wh"))
    folder.mkdir()

    def run():
        handler = replace_by_key(wh, "bronze.t", ["id"], [F.desc("v")])
        land_new_files(arriving_rows(spark, str(folder), SPEC), handler, str(tmp_path / "cp")).awaitTermination()

    (folder / "1.txt").write_text("1\ta\tx\n2\tb\tx\n")
    run()
    assert sorted((r.id, r.v) for r in wh.read("bronze.t").collect()) == [("1", "a"), ("2", "b")]
    (folder / "2.txt").write_text("2\tc\tx\n3\td\tx\n2\tb2\tx\n")
    run()
    assert sorted((r.id, r.v) for r in wh.read("bronze.t").collect()) == [("1", "a"), ("2", "c"), ("3", "d")]
    files = wh.read("bronze.t").inputFiles()
    run()
    assert wh.read("bronze.t").inputFiles() == files and "secret" not in wh.read("bronze.t").columns
    (folder / "3.txt").write_text("2\tb9\tx\n1\tz\tx\n")
    run()
    assert sorted((r.id, r.v) for r in wh.read("bronze.t").collect()) == [("1", "z"), ("2", "c"), ("3", "d")]
