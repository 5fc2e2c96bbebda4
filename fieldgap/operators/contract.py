"""Row contracts with quarantine (DQ-1, DQ-4..DQ-7, A-19)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldgap.functions.text import reason_text


@dataclass(frozen=True)
class Check:
    """A named condition that a bad row satisfies. NULL counts as not failing."""

    reason: str
    fails: Column


def apply_contract(df: DataFrame, checks: Sequence[Check], out: str = "_reasons") -> DataFrame:
    """Add the sorted list of failed checks; every check is evaluated, in one pass."""
    hits = F.array(*[F.when(c.fails, F.lit(c.reason)) for c in checks])
    return df.withColumn(out, F.array_sort(F.array_distinct(F.array_compact(hits))))


def valid_rows(df: DataFrame, reasons: str = "_reasons") -> DataFrame:
    return df.filter(F.size(reasons) == 0).drop(reasons)


def quarantined_rows(
    df: DataFrame, raw_columns: Sequence[str], raw: str = "_raw", reasons: str = "_reasons"
) -> DataFrame:
    """Rejected rows with their raw values and comma-joined reasons."""
    return df.filter(F.size(reasons) > 0).select(
        *[F.col(f"{raw}.{c}").alias(c) for c in raw_columns],
        reason_text(F.col(reasons)).alias(reasons),
    )


def feed_metrics(
    judged: DataFrame, feed: str, repeated: Column | None = None, standardized: Column | None = None
) -> DataFrame:
    """Run metrics of a judged feed, one row per reason (or one row with a NULL reason).

    rows_in = rows_valid + rows_quarantined + deduplicated. Each row counts once under a NULL
    reason and once under each of its reasons, so totals and reasons come from one pass. Only
    the handful of per-reason rows is then folded into the output.
    """
    bad = F.size("_reasons") > 0
    again = F.lit(False) if repeated is None else repeated
    touched = F.lit(False) if standardized is None else standardized
    outcomes = judged.select(
        (~bad & ~again).alias("valid"),
        bad.alias("bad"),
        (~bad & ~again & touched).alias("touched"),
        (~bad & again).alias("again"),
        F.explode(F.concat(F.array(F.lit(None).cast("string")), "_reasons")).alias("reason"),
    )
    per_reason = outcomes.groupBy("reason").agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if("valid").alias("rows_valid"),
        F.count_if("bad").alias("rows_quarantined"),
        F.count_if("touched").alias("standardized"),
        F.count_if("again").alias("deduplicated"),
    )
    totals = ["rows_in", "rows_valid", "rows_quarantined", "standardized", "deduplicated"]
    whole = F.col("reason").isNull()
    folded = per_reason.agg(
        *[F.coalesce(F.max(F.when(whole, F.col(c))), F.lit(0)).alias(c) for c in totals],
        F.collect_list(F.when(~whole, F.struct("reason", F.col("rows_in").alias("n")))).alias("_r"),
    )
    return folded.select(*totals, F.inline_outer("_r").alias("reason", "n")).select(
        F.lit(feed).alias("feed"),
        *totals,
        "reason",
        F.coalesce("n", F.lit(0)).alias("reason_count"),
    )
