"""Ranges and contiguous runs (F-21, INT-2, W-5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def explode_range(df: DataFrame, lo: str, hi: str, out: str) -> DataFrame:
    """One row per integer in [lo, hi]; reversed or missing bounds give no row.

    A narrow row-to-rows step: no shuffle.
    """
    years = F.explode(F.sequence(F.col(lo), F.col(hi)))
    return df.filter(F.col(lo) <= F.col(hi)).withColumn(out, years)


def range_row_count(df: DataFrame, lo: str, hi: str) -> DataFrame:
    """Rows that `explode_range` has to produce, as a one-row frame."""
    spans = F.when(F.col(lo) <= F.col(hi), F.col(hi) - F.col(lo) + 1).otherwise(0)
    return df.agg(F.coalesce(F.sum(spans), F.lit(0)).cast("bigint").alias("expected_rows"))


def islands(
    df: DataFrame, keys: Sequence[str], seq: str, start: str = "run_start", end: str = "run_end"
) -> DataFrame:
    """Maximal runs of consecutive integers (or days) per key.

    Rows are made distinct on (key, seq) with map-side combining first, so a group holds at
    most its distinct sequence values (years, days), however many rows a hot key has.
    """
    steps = df.select(*keys, seq).filter(F.col(seq).isNotNull()).distinct()
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(seq))
    if dict(steps.dtypes)[seq] == "date":
        anchor = F.date_sub(F.col(seq), nth)
    else:
        anchor = F.col(seq) - nth
    return (
        steps.withColumn("_run", anchor)
        .groupBy(*keys, "_run")
        .agg(
            F.min(seq).alias(start),
            F.max(seq).alias(end),
            F.count(F.lit(1)).alias("run_length"),
        )
        .drop("_run")
    )
