"""Bucketed tables: a delivery concerns its buckets alone."""

import os

import pytest
from pyspark.sql import functions as F

from fieldgap.operators.buckets import BUCKET, BucketedTable
from fieldgap.operators.incremental import keyed_replace


def files(path):
    """Every data file with its time of writing, by bucket."""
    return {
        os.path.join(folder, name): os.stat(os.path.join(folder, name)).st_mtime_ns
        for folder, _, names in os.walk(path)
        for name in names
        if name.endswith(".parquet")
    }


@pytest.fixture
def held(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "held"), ["k"], 32)
    table.create(spark.range(2000).select(F.col("id").alias("k"), F.lit("old").alias("v")))
    return table


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_only_touched_buckets_are_read_and_written(spark, held):
    delivery = spark.createDataFrame([(5, "new"), (5, "twice"), (4000, "fresh")], "k long, v string")
    expected = rows(keyed_replace(held.read(), delivery, ["k"]))
    before = files(held.path)
    touched = held.replace_keys(delivery)
    after = files(held.path)
    assert 1 <= len(touched) <= 2
    folders = tuple(f"/{BUCKET}={b}/" for b in touched)
    assert {f for f in before if before[f] == after.get(f)} == {f for f in before if not any(x in f for x in folders)}
    assert all(any(x in f for x in folders) for f in after if f not in before)
    plan = held.read(touched)._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters:") :].split("]", 1)[0]
    assert BUCKET in filters and all(str(b) in filters for b in touched)
    assert rows(held.read()) == expected


def test_rebuild_equals_full_build(spark, held, tmp_path):
    def count(df):
        return df.groupBy("k").agg(F.count("*").alias("n"))

    facts = BucketedTable(spark, str(tmp_path / "facts"), ["k"], 32)
    facts.create(count(held.read()))
    delivery = spark.createDataFrame([(7, "a"), (7, "b"), (3000, "c")], "k long, v string")
    held.replace_keys(delivery)
    before = files(facts.path)
    touched = facts.rebuild_keys(delivery, held, count)
    assert sum(before.get(f) == t for f, t in files(facts.path).items()) >= len(before) - len(touched) > 0
    assert rows(facts.read()) == rows(count(held.read()))


def test_odd_deliveries(spark, held, tmp_path):
    nothing = spark.createDataFrame([], "k long, v string")
    before = files(held.path)
    assert held.replace_keys(nothing) == [] and files(held.path) == before
    held.replace_keys(spark.createDataFrame([(None, "x")], "k long, v string"))
    assert held.read().where("k is null").count() == 1
    with pytest.raises(ValueError, match="share keys"):
        held.rebuild_keys(nothing, BucketedTable(spark, held.path, ["k"], 8), lambda df: df)
    lone = BucketedTable(spark, str(tmp_path / "lone"), ["k"], 32)
    lone.create(spark.createDataFrame([(1, "x")], "k long, v string"))
    with pytest.raises(ValueError, match="without rows"):
        lone.rebuild_keys(lone.read(), lone, lambda df: df.where("false"))
    assert lone.read().count() == 1


def test_keys_of_any_integer_width_share_a_bucket(spark):
    table = BucketedTable(spark, "unused", ["k"], 1000)
    wide, narrow = (spark.range(50).select(F.col("id").cast(t).alias("k")) for t in ("long", "int"))
    assert table.touched(wide) == table.touched(narrow)
