"""Ranks, top-k, caps, shares and dense domains (W-3, T-1..T-6, A-20..A-22, J-12)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldgap.session import small_table


def rank_within(
    df: DataFrame, group: str, score: str, out: str, width: float = 0.0625, digits: int = 9
) -> DataFrame:
    """rank() by `score` descending within `group`, without one task per group.

    Ties share a rank; scores are compared after rounding to `digits`, so that differences
    in the last bit do not split ties. The work is on distinct (group, score) pairs, which
    map-side combining reduces first: a tie held by a third of all rows is one pair. Those
    pairs are split into score intervals of `width`; running counts over the intervals give
    each interval's offset, and rows are only ordered inside an interval.
    """
    scored = df.withColumn("_score", F.round(F.col(score), digits))
    pairs = (
        scored.groupBy(group, "_score")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_slot", F.floor(F.col("_score") / F.lit(width)))
    )
    slots = pairs.groupBy(group, "_slot").agg(F.sum("_n").alias("_slot_n"))
    before = Window.partitionBy(group).orderBy(F.col("_slot").desc_nulls_last())
    above = F.sum("_slot_n").over(before.rowsBetween(Window.unboundedPreceding, -1))
    offsets = slots.select(
        F.col(group).alias("_o_group"),
        F.col("_slot").alias("_o_slot"),
        F.coalesce(above, F.lit(0)).alias("_offset"),
    )
    inside = Window.partitionBy(group, "_slot").orderBy(F.col("_score").desc_nulls_last())
    higher = F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    ranked = (
        pairs.withColumn("_higher", F.coalesce(higher, F.lit(0)))
        .join(
            offsets,
            F.col(group).eqNullSafe(F.col("_o_group")) & F.col("_slot").eqNullSafe(F.col("_o_slot")),
        )
        .select(
            F.col(group).alias("_r_group"),
            F.col("_score").alias("_r_score"),
            (F.col("_offset") + F.col("_higher") + 1).cast("bigint").alias(out),
        )
    )
    return scored.join(
        ranked,
        F.col(group).eqNullSafe(F.col("_r_group")) & F.col("_score").eqNullSafe(F.col("_r_score")),
    ).drop("_score", "_r_group", "_r_score")


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Ordered first k rows; Spark keeps k rows per partition and merges them."""
    return df.orderBy(*order).limit(k)


def keep_top_groups(df: DataFrame, group: str, measure: str, k: int) -> DataFrame:
    """Rows of the k groups with the largest total measure (T-6, J-12)."""
    totals = df.groupBy(group).agg(F.sum(measure).alias("_total"))
    best = top_k(totals, [F.desc_nulls_last("_total"), F.asc_nulls_last(group)], k)
    return df.join(best.select(group), group, "left_semi")


def capped(df: DataFrame, n: int, order: Sequence[Column] = ()) -> tuple[DataFrame, DataFrame]:
    """At most n rows, plus a one-row frame (rows_returned, truncated) that says if more exist (T-5)."""
    probe = (df.orderBy(*order) if order else df).limit(n + 1)
    flag = probe.agg(
        F.least(F.count(F.lit(1)), F.lit(n).cast("bigint")).alias("rows_returned"),
        (F.count(F.lit(1)) > n).alias("truncated"),
    )
    return probe.limit(n), flag


def with_share(totals: DataFrame, measure: str, out: str, by: Sequence[str] = ()) -> DataFrame:
    """Share of the group's total, or of the grand total (A-21)."""
    if not by:
        whole = totals.agg(F.sum(measure)).scalar()
        return totals.withColumn(out, F.try_divide(F.col(measure), whole))
    sums = totals.groupBy(*by).agg(F.sum(measure).alias("_whole"))
    return totals.join(sums, list(by)).withColumn(out, F.try_divide(F.col(measure), F.col("_whole"))).drop("_whole")


def on_domain(df: DataFrame, column: str, values: Sequence[str], zero: Sequence[str]) -> DataFrame:
    """One row per listed value; measures of absent values become 0 (A-22)."""
    domain = small_table(df.sparkSession, [(v,) for v in values], f"{column} string")
    return domain.join(df, column, "left").fillna(0, subset=list(zero))


def pivot_counts(df: DataFrame, rows: str, column: str, values: Sequence[str]) -> DataFrame:
    """Counts per row value and listed column value, 0 where absent (A-20).

    Conditional counts in one pass: the column values are given, so no extra job finds them.
    """
    return df.groupBy(rows).agg(
        *[F.count_if(F.col(column) == v).alias(v) for v in values]
    )
