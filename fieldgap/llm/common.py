"""What the operators share: reading tables, written cuts, row keys, bounded Arrow batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldgap.session import scratch_path

#: Stands for a missing document id where ids are ordered: such rows come last.
LAST_ID = 2**63 - 1
BATCH_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """Cut the lineage: write below `spark.checkpoint.dir` and read back.

    The files are on the folder that all executors share, so a lost executor costs nothing.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(df: DataFrame) -> DataFrame:
    """Let Arrow batches end by size, so that very long texts do not share one large batch."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def ordered_id(column: str | Column) -> Column:
    """The id as a number that is never missing."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(LAST_ID).cast("long")).cast("long")


def text_key(column: str | Column) -> Column:
    """Tells rows of one id with different texts apart; repeated rows stay equal."""
    return F.xxhash64(column)
