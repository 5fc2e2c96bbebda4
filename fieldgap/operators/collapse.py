"""Line-to-header collapse (DIM-3, FCT-1): header values once per header, flags OR-ed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame


def collapse(df: DataFrame, keys: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """One row per header key with the named aggregates, in the given column order."""
    return df.groupBy(*keys).agg(*[agg.alias(name) for name, agg in values.items()])
