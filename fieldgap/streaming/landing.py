"""Land newly arrived flat files as a stream (INC-1, INC-8).

The stream's checkpoint plays the part of the load manifest: a file is processed once, and a
run without new files changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fieldgap.operators.dedup import latest_per_key
from fieldgap.operators.incremental import keyed_replace
from fieldgap.sources.positional import FlatFileSpec, positional_columns
from fieldgap.sources.store import Warehouse


def arriving_rows(spark: SparkSession, folder: str, spec: FlatFileSpec) -> DataFrame:
    """Streaming bronze rows of all files that arrive in a folder."""
    lines = spark.readStream.option("lineSep", "\n").text(folder)
    return positional_columns(lines, spec.columns, spec.drop, spec.sep)


def land_new_files(
    rows: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Process everything that is available now, in one batch per trigger, then stop."""
    return (
        rows.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def replace_by_key(wh: Warehouse, table: str, keys: list[str], order: list) -> Callable[[DataFrame, int], None]:
    """Batch handler: the newest row per key, of the batch and the table, stays.

    An older row that arrives late does not replace a newer one; of equal ones the later batch
    wins. A replayed batch gives the same table, so a restart after a failure is safe.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        newest = latest_per_key(batch, keys, order).withColumn("_batch", F.lit(batch_id))
        old = wh.read_or_none(table)
        if old is not None:
            met = old.join(newest.select(*keys), keys, "left_semi").unionByName(newest, allowMissingColumns=True)
            newest = keyed_replace(old, latest_per_key(met, keys, [*order, F.desc("_batch")]), keys)
        wh.replace(table, newest)

    return apply
