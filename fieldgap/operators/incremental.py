"""Keyed replacement, touched keys and slowly changing history (INC-1..INC-5, SNAP-1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldgap.operators.merge import scalar_of


def keyed_replace(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of `new`, plus the old rows whose key does not occur in `new`.

    Columns that only one side has are filled with NULL, so a column added by the new load
    is appended.
    """
    touched = new.select(*keys).distinct()
    return old.join(touched, list(keys), "left_anti").unionByName(new, allowMissingColumns=True)


def rows_of_touched_keys(
    source: DataFrame, target: DataFrame | None, key: str, ts: str
) -> DataFrame:
    """All source rows of keys that have any row newer than the target's newest `ts`.

    With no target this is the whole source (first build or full refresh).
    """
    if target is None:
        return source
    newest = scalar_of(target, F.max(ts))
    touched = source.filter(newest.isNull() | (F.col(ts) > newest)).select(key).distinct()
    return source.join(touched, key, "left_semi")


def rows_after(source: DataFrame, target: DataFrame | None, ts: str) -> DataFrame:
    """Source rows newer than the target's newest `ts` (row-level watermark)."""
    if target is None:
        return source
    newest = scalar_of(target, F.max(ts))
    return source.filter(newest.isNull() | (F.col(ts) > newest))


def open_versions(history: DataFrame, valid_to: str = "valid_to") -> DataFrame:
    return history.filter(F.col(valid_to).isNull())


def first_versions(
    source: DataFrame, as_of: Column, valid_from: str = "valid_from", valid_to: str = "valid_to"
) -> DataFrame:
    """History of a first load: every row is an open version."""
    return source.withColumns({valid_from: as_of, valid_to: F.lit(None).cast("timestamp")})


def next_history(
    history: DataFrame,
    source: DataFrame,
    key: str,
    check_cols: Sequence[str],
    as_of: Column,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
) -> DataFrame:
    """History after one more delivery of `source` (one row per key).

    A version closes when a check column changed (null-safe) or the key is gone; a changed,
    new or returning key opens one. Other columns of an unchanged key keep the values of the
    version that is open. Closed versions pass through without being joined. Columns that only the
    delivery has are null in older versions; columns it lacks are not compared, and null in new ones.
    """
    known = [c for c in history.columns if c not in (valid_from, valid_to)]
    cols = known + [c for c in source.columns if c not in known]

    def whole_row(df: DataFrame) -> list[Column]:
        other = source if df is history else history
        return [F.col(c) if c in df.columns else F.lit(None).cast(other.schema[c].dataType).alias(c) for c in cols]

    old = open_versions(history, valid_to).select(
        F.struct(*whole_row(history), valid_from).alias("_old"), F.col(key).alias("_old_key")
    )
    new = source.select(F.struct(*whole_row(source)).alias("_new"), F.col(key).alias("_new_key"))
    pairs = old.join(new, F.col("_old_key") == F.col("_new_key"), "full")

    had, has = F.col("_old_key").isNotNull(), F.col("_new_key").isNotNull()
    same = F.lit(True)
    for c in (c for c in check_cols if c in source.columns):
        same = same & F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}"))
    unchanged = had & has & same

    def version(side: str, start: Column, end: Column) -> Column:
        fields = [F.col(f"{side}.{c}").alias(c) for c in cols]
        return F.struct(*fields, start.alias(valid_from), end.alias(valid_to))

    never = F.lit(None).cast("timestamp")
    started = F.col(f"_old.{valid_from}")
    kept = F.when(had, version("_old", started, F.when(unchanged, never).otherwise(as_of)))
    opened = F.when(has & ~unchanged, version("_new", as_of, never))
    versions = pairs.select(F.explode(F.array_compact(F.array(kept, opened))).alias("_v")).select("_v.*")
    closed = history.filter(F.col(valid_to).isNotNull())
    return closed.unionByName(versions, allowMissingColumns=True)


def current_with_versions(
    history: DataFrame,
    key: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
) -> DataFrame:
    """Open version per key with version_count and first_seen_at (INC-4, J-14).

    One aggregation over the history; keys without an open version drop out.
    """
    row = F.struct(*history.columns)
    return (
        history.groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("version_count"),
            F.min(valid_from).alias("first_seen_at"),
            F.max_by(row, F.when(F.col(valid_to).isNull(), F.col(valid_from))).alias("_open"),
        )
        .filter(F.col("_open").isNotNull())
        .select("_open.*", "version_count", "first_seen_at")
    )
