"""Result-set equivalence without collecting either side (DQ-12)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _canonical(field: T.StructField, digits: int) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.BooleanType):
        value = F.concat(F.lit("b:"), c.cast("string"))
    elif isinstance(field.dataType, T.NumericType):
        # + 0.0 folds -0.0 into 0.0; NaN counts as missing.
        number = F.round(c.cast("double"), digits) + F.lit(0.0)
        value = F.when(~F.isnan(number), F.concat(F.lit("n:"), number.cast("string")))
    else:
        value = F.concat(F.lit("s:"), F.upper(F.trim(c.cast("string"))))
    return F.coalesce(value, F.lit("<null>"))


def column_signatures(df: DataFrame, digits: int = 2) -> DataFrame:
    """One row per column: (column, rows, signature), in a single aggregation.

    The signature sums two independent 64-bit hashes of the canonical values, so it does not
    depend on row order and tells multisets apart.
    """
    entries = []
    for field in df.schema.fields:
        value = _canonical(field, digits)
        total = F.sum(F.xxhash64(value).cast("decimal(38,0)"))
        second = F.sum(F.xxhash64(F.lit("second"), value).cast("decimal(38,0)"))
        entries.append(
            F.struct(
                F.lit(field.name).alias("column"),
                F.count(F.lit(1)).alias("rows"),
                F.concat_ws("/", F.coalesce(total, F.lit(0)), F.coalesce(second, F.lit(0))).alias(
                    "signature"
                ),
            )
        )
    return df.agg(F.array(*entries).alias("_s")).select(F.inline("_s"))


def result_equivalent(expected: DataFrame, actual: DataFrame, digits: int = 2) -> DataFrame:
    """One row (expected_rows, actual_rows, unmatched_columns, matches).

    Every expected column must equal some actual column as a multiset, each actual column
    used once; names, row order and extra columns do not matter. Numbers compare after
    rounding, text after trimming and upper-casing.
    """
    want = column_signatures(expected, digits).groupBy("signature").agg(
        F.count(F.lit(1)).alias("_want"), F.max("rows").alias("_want_rows")
    )
    have = column_signatures(actual, digits).groupBy("signature").agg(
        F.count(F.lit(1)).alias("_have"), F.max("rows").alias("_have_rows")
    )
    missing = F.greatest(
        F.coalesce("_want", F.lit(0)) - F.coalesce("_have", F.lit(0)), F.lit(0)
    )
    return (
        want.join(have, "signature", "full")
        .agg(
            F.max("_want_rows").alias("expected_rows"),
            F.max("_have_rows").alias("actual_rows"),
            F.sum(missing).cast("bigint").alias("unmatched_columns"),
        )
        .withColumn(
            "matches",
            F.col("expected_rows").eqNullSafe(F.col("actual_rows")) & (F.col("unmatched_columns") == 0),
        )
    )
