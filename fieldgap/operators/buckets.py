"""Tables in hash buckets of their key, where a delivery reads and writes only the buckets it touches (INC-1, INC-2, INC-5)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldgap.operators.incremental import keyed_replace

BUCKET = "_bucket"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """A stable bucket of a key. NULL keys have one too; integers of any width share theirs."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


class BucketedTable:
    """A Parquet table partitioned by a hash of its key.

    Equal keys share a bucket, so replacing the rows of a delivery's keys, or rebuilding all rows of
    them from a bucketed source, concerns the delivery's buckets alone: the others are neither
    read nor written. Buckets are replaced by dynamic partition overwrite, which leaves a bucket as it
    was until its new files are complete; a retried task or lost executor leaves no trace. The number
    of buckets is fixed at the first write: take so many that one fits a task, since a bucket is
    never split in writing; a key with a third of all rows makes its bucket large, and that bucket
    is written in files of `rows_per_file`.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int, rows_per_file: int = 4_000_000):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets
        self.rows_per_file = rows_per_file

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The rows, of some buckets if these are given. The bucket is a partition column, so others are not listed."""
        rows = self.spark.read.parquet(self.path)
        if buckets is not None:
            rows = rows.where(F.col(BUCKET).isin(list(buckets)))
        return rows.drop(BUCKET)

    def bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, bucket_of(self.keys, self.buckets))

    def create(self, df: DataFrame) -> None:
        """Write all rows; what was there goes."""
        self._write(df, "static")

    def touched(self, delivery: DataFrame) -> list[int]:
        """The delivery's buckets, found in the delivery alone. At most `buckets` numbers reach the driver."""
        return sorted(r[0] for r in self.bucketed(delivery.select(*self.keys)).select(BUCKET).distinct().collect())

    def replace_keys(self, delivery: DataFrame) -> list[int]:
        """Put the delivery's rows in place of all rows of its keys; returns the buckets that were written.

        A column that only the delivery has is NULL in older rows of these buckets and absent in the files of
        others; read with `mergeSchema` then.
        """
        touched = self.touched(delivery)
        if touched:
            self._write(keyed_replace(self.read(touched), delivery, self.keys), "dynamic")
        return touched

    def rebuild_keys(
        self, delivery: DataFrame, source: BucketedTable, build: Callable[[DataFrame], DataFrame]
    ) -> list[int]:
        """Put `build(all source rows of the delivery's keys)` in place of all rows of these keys.

        The source has the same keys and number of buckets and holds the delivery already, so its rows of the
        delivery's keys stand in the same buckets. Keys that `build` gives no rows disappear; where a
        bucket would be left without any row, which overwriting cannot express, nothing is written and an
        error is raised.
        """
        if (source.keys, source.buckets) != (self.keys, self.buckets):
            raise ValueError("source and table must share keys and number of buckets")
        touched = self.touched(delivery)
        if touched:
            changed = delivery.select(*self.keys).distinct()
            old = self.read(touched).join(changed, self.keys, "left_anti")
            new = old.unionByName(build(source.read(touched).join(changed, self.keys, "left_semi")))
            if len(self.touched(new)) < len(touched):
                raise ValueError("a bucket would be left without rows")
            self._write(new, "dynamic")
        return touched

    def _write(self, df: DataFrame, mode: str) -> None:
        (
            self.bucketed(df).repartition(BUCKET).sortWithinPartitions(BUCKET, *self.keys)
            .write.mode("overwrite").partitionBy(BUCKET)
            .option("partitionOverwriteMode", mode).option("maxRecordsPerFile", self.rows_per_file)
            .parquet(self.path)
        )
