"""Nested model-reference documents (SRC-9..SRC-11, F-28)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldgap.functions.scalars import tolerant_int

ENVELOPE = (
    "SearchCriteria string, Results array<struct<Make_ID: int, Make_Name: string, "
    "Model_ID: int, Model_Name: string, VehicleTypeId: int, VehicleTypeName: string>>"
)
# Precedence when a model is listed under several vehicle types.
TYPE_PRIORITY = {"Passenger Car": 1, "Multipurpose Passenger Vehicle (MPV)": 2, "Truck": 3}


def read_documents(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per response document; a document may span lines."""
    return spark.read.schema(ENVELOPE).option("multiLine", True).json(path)


def parse_documents(df: DataFrame, column: str) -> DataFrame:
    """The same shape from a column of JSON text."""
    return df.select(F.from_json(column, ENVELOPE).alias("_d")).select("_d.*")


def resolve_by_priority(
    df: DataFrame, keys: Sequence[str], value: str, priority: Mapping[str, int], other: int = 9
) -> DataFrame:
    """One value per key by a fixed precedence, the lowest value among equals (SRC-10)."""
    order = F.lit(other)
    for name, rank in priority.items():
        order = F.when(F.col(value) == name, F.lit(rank)).otherwise(order)
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys)
        .agg(F.min_by(value, F.struct(order, F.col(value))).alias(value))
    )


def reference_models(years: DataFrame, types: DataFrame, makes: Sequence[str]) -> DataFrame:
    """Listed model x year rows of the exact makes in scope, with one vehicle type each.

    The service matches makes by substring, so other makes are filtered out; models without
    a known type are out of scope.
    """
    listed_types = types.select(F.inline("Results")).select(
        F.col("Model_ID").alias("model_id"), F.col("VehicleTypeName").alias("vehicle_type")
    )
    typed = resolve_by_priority(listed_types, ["model_id"], "vehicle_type", TYPE_PRIORITY)
    year = tolerant_int(F.nullif(F.regexp_extract("SearchCriteria", r"ModelYear:(\d+)", 1), F.lit("")))
    listed = (
        years.select(year.alias("model_year"), F.inline("Results"))
        .filter(F.upper("Make_Name").isin(*makes))
        .select(
            F.col("Make_ID").alias("make_id"),
            F.col("Make_Name").alias("make_name"),
            F.col("Model_ID").alias("model_id"),
            F.col("Model_Name").alias("model_name"),
            "model_year",
        )
    )
    return listed.join(typed, "model_id").select(
        "make_id", "make_name", "model_id", "model_name", "model_year", "vehicle_type"
    )
