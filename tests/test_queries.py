"""Every registered query against its DuckDB statement, on plain and on skewed tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from fieldgap.workload import deliveries, models, tables
from verify import rows as canonical

PLAIN = "/root/testdata/sf0.001"
NEEDS_TABLES = pytest.mark.skipif(not os.path.isdir(PLAIN), reason="test tables are not here")
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()
SKEW_SENSITIVE = [
    "header_collapse_total", "line_to_header_flags", "dedup_latest_line", "universe_full_outer", "argmax_null_safe",
    "usual_flag_per_supplier", "islands_of_days", "monthly_trends_full_outer", "coverage_gap_scored",
    "rank_lines_by_unit_price", "contract_reasons", "incremental_equals_full", "stg_complaints", "int_vehicles",
    "fct_complaint", "dim_recall_campaign", "mart_coverage_gap", "mart_data_conformance", "incremental_fct_complaint",
]


def connection(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"create view {name} as select * from '{files}'")
    return con


def check(spark, con, name, folder):
    df = QUERIES[name](spark, str(folder))
    got = canonical(df.columns, df.collect())
    if name not in ORACLE:
        assert got
        return
    result = con.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == canonical(columns, result.fetchall())


@NEEDS_TABLES
@pytest.mark.parametrize("name", [*tables.QUERIES, *deliveries.QUERIES, *models.QUERIES])
def test_query(spark, name):
    check(spark, connection(PLAIN), name, PLAIN)


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """The tables with a third of all lines on one order and of all events on one user."""
    folder = tmp_path_factory.mktemp("skewed")
    con = connection(PLAIN)
    changes = {
        "lineitem": "replace (case when l_partkey % 3 = 0 then 48 else l_orderkey end as l_orderkey)",
        "events": "replace (case when event_id % 3 = 0 then 7 else user_id end as user_id)",
        "orders": "replace (case when o_orderkey % 3 = 0 then 5 else o_custkey end as o_custkey)",
    }
    for path in glob.glob(f"{PLAIN}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"copy (select * {changes.get(name, '')} from {name}) to '{folder}/{name}.parquet' (format parquet)")
    return folder


@NEEDS_TABLES
@pytest.mark.parametrize("name", SKEW_SENSITIVE)
def test_query_on_skewed_tables(spark, skewed, name):
    check(spark, connection(skewed), name, skewed)
