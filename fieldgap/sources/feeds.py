"""Supplier feeds, seeds and exports as CSV (SRC-12, SRC-13, SRC-18)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ORDINAL = "_ordinal"


def read_feed(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """All cells as text, empty cells as '' and never NULL, plus the row position.

    The position is (file, block offset, order within the task), which follows the file
    order whichever way Spark packs blocks into tasks.
    """
    schema = ", ".join(f"`{c}` string" for c in columns)
    # Quoted cells may hold line breaks, so a file is one task.
    rows = spark.read.csv(path, schema=schema, header=True, enforceSchema=False, escape='"', multiLine=True)
    position = F.struct(
        F.col("_metadata.file_path"),
        F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id().alias("row"),
    )
    return rows.select(
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns], position.alias(ORDINAL)
    )


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Typed reference table from a small CSV."""
    return spark.read.csv(path, schema=schema, header=True, escape='"', mode="FAILFAST")


def write_csv(df: DataFrame, path: str) -> None:
    """Export a result; each task writes its part of the folder, sorted parts in the order of their names.

    Blanks at the ends of cells stay.
    """
    df.write.mode("overwrite").csv(
        path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
