"""A bounded sample of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASHES = 1 << 30


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, usable: Column, rows_per_class: int,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """(id, y, text) of at most `rows_per_class` ids of either label, in the order of a hash of the id.

    `usable` selects label rows. Ids with several labels take the largest. The sample's ids are
    bounded by the parameter, so they may be broadcast; texts are not shuffled.
    """
    known = (
        labels.where(usable & F.col(id_column).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(id_column).cast("long").alias("id"))
        .agg(F.max(F.col(label).cast("int")).alias("y"))
    )
    # A little more than the sample passes by its hash, so that the ordering is over few rows.
    number = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    part = F.pmod(F.xxhash64("id", F.lit("part")), F.lit(HASHES))
    passing = F.lit(False)
    for y, n in number.items():
        passing |= (F.col("y") == y) & (part <= int(HASHES * min(1.0, 1.1 * rows_per_class / n)))
    order = F.row_number().over(Window.partitionBy("y").orderBy(F.xxhash64("id"), "id"))
    chosen = known.where(passing).withColumn("n", order).where(F.col("n") <= rows_per_class).select("id", "y")
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(text_column, F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "id")
