"""SQL functions give what the column functions of the same name give."""

import pytest
from pyspark.sql import functions as F

from fieldgap.functions import sql, text
from fieldgap.plans import reports

VALUES = [
    None, "", " ", " ", "ford", " Ford\tF-150 ", "straße 5", "A B", "　x ", "y", "Yes", "NO", "yes ",
    "it's a 'test'", "back\\slash", "a:b:c", "F’150 $1", "éclair", "line\nbreak", "a  b",
]


@pytest.mark.parametrize("name", [f[0] for f in sql.FUNCTIONS])
def test_equal_to_the_column_function(spark, name):
    sql.register(spark)
    df = spark.createDataFrame([(v,) for v in VALUES], "v string")
    rows = df.select("v", F.expr(f"{name}(v)").alias("a"), getattr(text, name)(F.col("v")).alias("b")).collect()
    assert len(rows) == len(VALUES) and all(r["a"] == r["b"] for r in rows), [tuple(r) for r in rows if r["a"] != r["b"]]


def test_ad_hoc_sql_calls_them(spark):
    df = spark.createDataFrame([("Ford  Motor",), ("ford motor",), ("kia",)], "make string")
    rows, _ = reports.ask(spark, "select make_name_key(make) as k, count(*) as n from {t} group by 1", {"t": df})
    assert {tuple(r) for r in rows.collect()} == {("FORD MOTOR", 2), ("KIA", 1)}
