"""Group sampling and redaction (DQ-13, DQ-14, SRC-3, F-29)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldgap.functions.text import hash_fraction, left_text
from fieldgap.operators.merge import scalar_of


def hash_sample(df: DataFrame, group: str, rate: float) -> DataFrame:
    """Every row of the groups whose md5 bucket lies below `rate`: a filter, no shuffle."""
    return df.filter(hash_fraction(F.col(group)) < F.lit(float(rate)))


def hash_sample_groups(df: DataFrame, group: str, target: int) -> DataFrame:
    """Sample about `target` groups; the rate comes from the number of distinct groups."""
    groups = scalar_of(df, F.count_distinct(group))
    rate = F.least(F.lit(1.0), F.lit(float(target)) / F.greatest(groups, F.lit(1)))
    return df.filter(hash_fraction(F.col(group)) < rate)


def redact(df: DataFrame, blank: Sequence[str] = (), shorten: Mapping[str, int] | None = None) -> DataFrame:
    """Blank the listed columns and shorten free text."""
    changes = {c: F.lit("") for c in blank}
    changes.update({c: left_text(F.col(c), n) for c, n in (shorten or {}).items()})
    return df.withColumns(changes)
