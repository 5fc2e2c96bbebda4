"""Join shapes used by the models (J-1, J-7, J-9..J-13, J-16, P-8, P-13, A-18)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def full_outer_merge(
    left: DataFrame, right: DataFrame, keys: Sequence[str], defaults: Mapping[str, object]
) -> DataFrame:
    """Full outer join on shared keys with defaults for the measures of the absent side.

    Both sides should already be one row per key. NULL keys never match and survive on
    their own rows.
    """
    joined = left.join(right, list(keys), "full")
    filled = {
        name: F.coalesce(F.col(name), F.lit(value).cast(joined.schema[name].dataType))
        for name, value in defaults.items()
    }
    return joined.withColumns(filled)


def lookup(
    df: DataFrame, table: DataFrame, on: Mapping[str, str], take: Mapping[str, str],
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """Left lookup: add `take` columns (table name -> new name), optionally with defaults."""
    defaults = defaults or {}
    side = table.select(
        *[F.col(t).alias(f"_l_{t}") for t in on.values()],
        *[F.col(t).alias(f"_v_{new}") for t, new in take.items()],
    )
    cond = [F.col(d) == F.col(f"_l_{t}") for d, t in on.items()]
    joined = df.join(side, cond, "left")
    added = {}
    for new in take.values():
        value = F.col(f"_v_{new}")
        added[new] = F.coalesce(value, F.lit(defaults[new])) if new in defaults else value
    return joined.withColumns(added).drop(
        *[f"_l_{t}" for t in on.values()], *[f"_v_{n}" for n in take.values()]
    )


def orphans(child: DataFrame, parent: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Child rows whose non-null reference has no parent (J-13)."""
    side = parent.select(*[F.col(p).alias(f"_p_{p}") for p in on.values()]).distinct()
    cond = [F.col(c) == F.col(f"_p_{p}") for c, p in on.items()]
    present = None
    for c in on:
        known = F.col(c).isNotNull()
        present = known if present is None else present & known
    return child.filter(present).join(side, cond, "left_anti")


def scalar_of(df: DataFrame, expr: Column) -> Column:
    """One aggregated value of a frame as a scalar subquery (J-8, P-13)."""
    return df.select(expr).scalar()


def kpi_row(spark: SparkSession, **measures: Column) -> DataFrame:
    """One row of independent scalar subqueries (A-18)."""
    return spark.range(1).select(*[c.alias(name) for name, c in measures.items()])
