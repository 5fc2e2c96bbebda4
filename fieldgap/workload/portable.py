"""Result types that print alike in Spark and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def portable(df: DataFrame) -> DataFrame:
    """Dates, timestamps and lists as text, decimals as doubles; everything else unchanged."""
    out = []
    for field in df.schema.fields:
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, T.DecimalType):
            c = c.cast("double")
        elif isinstance(kind, T.ArrayType):
            c = F.array_join(c, ",")
        out.append(c.alias(field.name))
    return df.select(*out)


def sql_columns(spec: str) -> str:
    """Select list for 'name', 'name:date', 'name:ts', 'name:num', 'name:int' or 'name:list' words."""
    shapes = {
        "date": "strftime({c}, '%Y-%m-%d')",
        "ts": "strftime({c}, '%Y-%m-%d %H:%M:%S')",
        "num": "cast({c} as double)",
        "int": "cast({c} as bigint)",
        "list": "array_to_string({c}, ',')",
    }
    out = []
    for word in spec.split():
        name, _, kind = word.partition(":")
        out.append(f"{shapes[kind].format(c=name)} as {name}" if kind else name)
    return ", ".join(out)


def names(spec: str) -> list[str]:
    return [word.partition(":")[0] for word in spec.split()]
