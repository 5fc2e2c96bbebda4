"""Data tests over tables (DQ-8..DQ-11, DQ-16, SRC-20)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldgap.operators.dedup import distinct_by


@dataclass(frozen=True)
class RowTest:
    """Counts rows that satisfy the SQL condition; all row tests of one table share one scan."""

    name: str
    table: str
    fails: str
    severity: str = "error"


@dataclass(frozen=True)
class UniqueTest:
    """Counts key combinations that occur more than once. NULL single keys are skipped."""

    name: str
    table: str
    columns: tuple[str, ...]
    severity: str = "error"


@dataclass(frozen=True)
class RelationTest:
    """Counts child rows whose reference is missing in the parent."""

    name: str
    table: str
    column: str
    parent: str
    parent_column: str
    severity: str = "error"


@dataclass(frozen=True)
class FrameTest:
    """Counts the rows of a frame of violations."""

    name: str
    violations: DataFrame
    severity: str = "error"


def not_null(table: str, column: str) -> RowTest:
    return RowTest(f"{table}.{column}.not_null", table, f"{column} is null")


def accepted(table: str, column: str, values: Sequence[str]) -> RowTest:
    listed = ", ".join("'" + value.replace("'", "\\'") + "'" for value in values)
    return RowTest(f"{table}.{column}.accepted_values", table, f"{column} not in ({listed})")


def valid_year(table: str, column: str, as_of_year: int, lowest: int = 1950) -> RowTest:
    fails = f"{column} < {lowest} or {column} > {as_of_year + 2}"
    return RowTest(f"{table}.{column}.valid_model_year", table, fails)


def unique(table: str, *columns: str) -> UniqueTest:
    return UniqueTest(f"{table}.{'+'.join(columns)}.unique", table, tuple(columns))


def related(table: str, column: str, parent: str, parent_column: str) -> RelationTest:
    return RelationTest(
        f"{table}.{column}.relationships", table, column, parent, parent_column
    )


def repeated_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key combinations with their number of occurrences, where above one.

    Keys that should be unique shuffle as they come: combining them per map task would drop hardly any, and
    its hash table spills where a task reads many (a part of a file holds some forty million short keys).
    Where they lie, keys are sorted; of most there is one row, and only those with a second are counted.
    """
    rows = df.filter(F.col(columns[0]).isNotNull()) if len(columns) == 1 else df
    lying = rows.select(*columns).repartition(*columns)
    key = Window.partitionBy(*columns).orderBy(*columns)
    numbered = lying.withColumn("_nth", F.row_number().over(key)).filter("_nth > 1")
    return numbered.groupBy(*columns).agg(F.max("_nth").cast("bigint").alias("occurrences"))


def _row_test_results(df: DataFrame, tests: Sequence[RowTest]) -> DataFrame:
    results = F.array(
        *[
            F.struct(
                F.lit(t.name).alias("test"),
                F.lit(t.severity).alias("severity"),
                F.count_if(F.expr(t.fails)).alias("failures"),
            )
            for t in tests
        ]
    )
    return df.agg(results.alias("_r")).select(F.inline("_r"))


def orphan_counts(child: DataFrame, parent: DataFrame, column: str, parent_column: str) -> DataFrame:
    """References without a parent, with their number of rows (J-13).

    Rows are counted per reference before the join. An anti join would be moved below the counts
    and shuffle every row, so this is a left join that keeps what found no parent.
    """
    counts = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_rows"))
    side = distinct_by(parent.select(F.col(parent_column).alias("_parent")), ["_parent"]).withColumn("_found", F.lit(True))
    return counts.join(side, F.col(column) == F.col("_parent"), "left").filter(F.col("_found").isNull())


def _counted(
    name: str, severity: str, violations: DataFrame, rows: str | None = None
) -> DataFrame:
    number = F.count(F.lit(1)) if rows is None else F.coalesce(F.sum(rows), F.lit(0).cast("bigint"))
    return violations.agg(number.alias("failures")).select(
        F.lit(name).alias("test"), F.lit(severity).alias("severity"), "failures"
    )


def run_checks(tables: Mapping[str, DataFrame], suite: Sequence[object]) -> DataFrame:
    """(test, severity, failures, status) for every test of the suite, as one frame."""
    parts = []
    by_table: dict[str, list[RowTest]] = {}
    for test in suite:
        if isinstance(test, RowTest):
            by_table.setdefault(test.table, []).append(test)
    for table, tests in by_table.items():
        parts.append(_row_test_results(tables[table], tests))
    for test in suite:
        if isinstance(test, UniqueTest):
            found = repeated_keys(tables[test.table], test.columns)
            parts.append(_counted(test.name, test.severity, found))
        elif isinstance(test, RelationTest):
            found = orphan_counts(tables[test.table], tables[test.parent], test.column, test.parent_column)
            parts.append(_counted(test.name, test.severity, found, "_rows"))
        elif isinstance(test, FrameTest):
            parts.append(_counted(test.name, test.severity, test.violations))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    status = F.when(F.col("failures") == 0, "pass").otherwise(
        F.when(F.col("severity") == "warn", "warn").otherwise("fail")
    )
    return out.withColumn("status", status)


def freshness(
    df: DataFrame, ts: str, as_of: Column, warn_days: int, error_days: int, source: str
) -> DataFrame:
    """Age of the newest load in whole periods: pass, warn or error (SRC-20, DQ-10)."""
    newest = F.max(ts)
    late = F.unix_timestamp(as_of) - F.unix_timestamp("newest")
    day = 86400
    status = (
        F.when(F.col("newest").isNull() | (late > error_days * day), "error")
        .when(late > warn_days * day, "warn")
        .otherwise("pass")
    )
    return df.agg(newest.alias("newest")).select(
        F.lit(source).alias("source"), "newest", status.alias("status")
    )
