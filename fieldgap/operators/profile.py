"""Table profile (DQ-15)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile(
    tables: Mapping[str, DataFrame],
    descriptions: Mapping[str, Mapping[str, str]] | None = None,
) -> DataFrame:
    """(table_name, position, column_name, data_type, description, row_count) of several tables.

    The schema is known without a job; the counts are one aggregate per table.
    """
    descriptions = descriptions or {}
    out = None
    for name, df in tables.items():
        notes = descriptions.get(name, {})
        columns = F.array(
            *[
                F.struct(
                    F.lit(i).alias("position"),
                    F.lit(f.name).alias("column_name"),
                    F.lit(f.dataType.simpleString()).alias("data_type"),
                    F.lit(notes.get(f.name, "")).alias("description"),
                )
                for i, f in enumerate(df.schema.fields, start=1)
            ]
        )
        part = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), F.inline(columns), "row_count"
        )
        out = part if out is None else out.unionByName(part)
    return out.select(
        "table_name", "position", "column_name", "data_type", "description", "row_count"
    )
