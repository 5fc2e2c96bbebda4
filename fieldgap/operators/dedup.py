"""Version and duplicate handling (W-1, W-2, W-4, A-11, A-16, A-23, DQ-6, T-4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldgap.functions.text import BETWEEN, packed_texts, unpacked_texts


def packed(df: DataFrame, texts: Sequence[str]) -> DataFrame:
    """The rows with the named text columns as one text."""
    return df.select(*[c for c in df.columns if c not in texts], *packed_texts(texts))


def unpacked(df: DataFrame, texts: Sequence[str]) -> DataFrame:
    """The rows of `packed`, and columns added since, with the named texts again."""
    others = [c for c in df.columns if c not in ("_texts", "_apart")]
    cells = df.select(*others, "_apart", F.split("_texts", BETWEEN, -1).alias("_cells"))
    return cells.select(*others, *unpacked_texts(texts))


def laid_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows, those of a key in one partition. Text columns other than the keys travel as one text."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in keys]
    if len(texts) < 2:
        return df.repartition(*keys)
    return unpacked(packed(df, texts).repartition(*keys), texts).select(*df.columns)


def distinct_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct rows, those of a key in one partition, after one shuffle on the keys.

    Rows are sorted where they lie. A hash table of them, and Spark would keep two per task, takes three
    times the memory, and short rows come in large numbers to a task.
    """
    w = Window.partitionBy(*df.columns).orderBy(*df.columns)
    lying = df.repartition(*keys).withColumn("_nth", F.row_number().over(w))
    return lying.filter("_nth = 1").drop("_nth")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], few_versions: bool = False
) -> DataFrame:
    """One row per key: the first in `order`, which should be a total order.

    The `= 1` filter lets Spark put a group limit in front of the shuffle, so every map task
    sends at most one row per key and a hot key does not pile up in one reducer. That limit
    sorts whole rows per map task, which spills once a task's input outgrows its memory.
    `few_versions` says that keys hold few rows each, so the limit would hardly drop any: rows
    are then shuffled as they come, texts packed, and sorted once, in the partitions of their keys.
    """
    if few_versions:
        df = laid_by(df, keys)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(w)).filter("_nth = 1").drop("_nth")


def best_candidate(
    df: DataFrame, keys: Sequence[str], payload: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """The payload of the smallest `order` tuple per key, by partial aggregation (no window)."""
    best = F.min_by(F.struct(*payload), F.struct(*order)).alias("_best")
    picked = df.groupBy(*keys).agg(best)
    return picked.select(*keys, *[F.col(f"_best.{p}").alias(p) for p in payload])


def flag_repeats(
    df: DataFrame, keys: Sequence[str], ordinal: str, flag: str, among: Column | None = None
) -> DataFrame:
    """Add `flag`: true for every row of a key after its first `ordinal`.

    With `among`, only rows satisfying it take part; all others get false. Keys compare
    null-safe. Only keys that do repeat are joined back, so the join side is small and the
    row side is a plain left join that adaptive execution can split when a key is hot.
    """
    taking_part = F.lit(True) if among is None else among
    firsts = (
        df.filter(taking_part)
        .groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys])
        .agg(F.count(F.lit(1)).alias("_copies"), F.min(ordinal).alias("_first"))
        .filter("_copies > 1")
        .drop("_copies")
    )
    on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    joined = df.join(firsts, on, "left")
    later = taking_part & (F.col(ordinal) > F.col("_first"))
    return joined.withColumn(flag, F.coalesce(later, F.lit(False))).drop(
        "_first", *[f"_k_{k}" for k in keys]
    )


def most_frequent(df: DataFrame, keys: Sequence[str], value: str, out: str | None = None) -> DataFrame:
    """The most frequent non-null value per key, the lowest value on ties.

    Counting (key, value) first keeps a hot key's state to its distinct values.
    """
    out = out or value
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(out))


def latest_row(df: DataFrame, ts: str, tie: Sequence[str] = ()) -> DataFrame:
    """The newest row as a one-row frame, without sorting the input (T-4)."""
    order = F.struct(ts, *tie)
    return df.agg(F.max_by(F.struct("*"), order).alias("_row")).select("_row.*")
