"""Demand against supply (MART-1, MART-2, P-11, P-12, A-13)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldgap.functions.scalars import log1p_sum
from fieldgap.operators.ranking import rank_within

# How much of the demand counts for each coverage status.
GAP_FACTORS = {"uncovered": 1.0, "thin": 0.5, "covered": 0.0}


def group_median(df: DataFrame, by: Sequence[str], value: str, out: str) -> DataFrame:
    """Exact interpolated median per group.

    Values are counted per (group, value) first; the percentile then reads a frequency
    column, so a group's state is its distinct values and not its rows.
    """
    counts = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*by).agg(F.percentile(value, 0.5, F.col("_n")).alias(out))


def coverage_gap(
    signals: DataFrame,
    coverage: DataFrame,
    entities: DataFrame,
    entity: str,
    category: str,
    supply: str,
    demand_terms: Mapping[str, float],
    weight: str,
    median_name: str,
    thin_share: float = 0.5,
    rank_name: str = "category_rank",
) -> DataFrame:
    """Score every (entity, category) pair that has a demand signal.

    `signals` and `coverage` hold one row per pair. A pair without supply is uncovered, one
    below `thin_share` of the category's median supply is thin, any other covered. Score =
    weighted log demand * entity weight * gap factor, ranked per category on the unrounded
    value.
    """
    depth = group_median(coverage, [category], supply, median_name)
    pairs = (
        signals.join(entities, entity)
        .join(coverage.select(entity, category, supply), [entity, category], "left")
        .join(depth, category, "left")
        .withColumn(supply, F.coalesce(F.col(supply), F.lit(0).cast("bigint")))
    )
    status = (
        F.when(F.col(supply) == 0, "uncovered")
        .when(F.col(supply) < F.col(median_name) * F.lit(thin_share), "thin")
        .otherwise("covered")
    )
    factor = F.lit(None).cast("double")
    for name, value in GAP_FACTORS.items():
        factor = F.when(F.col("coverage_status") == name, F.lit(value)).otherwise(factor)
    scored = (
        pairs.withColumn("coverage_status", status)
        .withColumn("_demand", log1p_sum(demand_terms))
        .withColumn("_score", F.col("_demand") * F.col(weight).cast("double") * factor)
    )
    ranked = rank_within(scored.withColumnRenamed("_score", "_raw_score"), category, "_raw_score", rank_name)
    return ranked.withColumns(
        {
            "demand_index": F.round("_demand", 3),
            "opportunity_score": F.round("_raw_score", 3),
        }
    ).drop("_demand", "_raw_score")
