"""Name conformance, exploded fitment and the vehicle universe (INT-1..INT-3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldgap.functions.aggregates import min_by_present
from fieldgap.functions.text import joined_key
from fieldgap.operators.conform import attach_conformed, conform_names, distinct_names
from fieldgap.operators.ranges import explode_range

VEHICLE = ["make", "model_norm", "model_year"]


def resolvable() -> Column:
    """Make, model and year are all known."""
    return F.col("make").isNotNull() & F.col("model_year").isNotNull() & (F.col("model_norm") != "")


def vehicle_key() -> Column:
    return joined_key(*[F.col(c) for c in VEHICLE])


def model_conformance(
    recalls: DataFrame, complaints: DataFrame, reference: DataFrame, rules: DataFrame
) -> DataFrame:
    """One row per observed make / name / year (INT-1)."""
    observed = distinct_names([recalls, complaints], VEHICLE, resolvable())
    return conform_names(observed, reference, rules)


def fitment_years(fitment: DataFrame, drop_overlaps: bool = False) -> DataFrame:
    """One row per fitted model year (INT-2).

    `drop_overlaps` removes repeated part x vehicle x position rows of overlapping ranges.
    """
    rows = explode_range(fitment, "year_start", "year_end", "model_year").select(
        vehicle_key().alias("vehicle_key"),
        "part_number",
        "make",
        "model_name",
        "model_norm",
        "model_year",
        "position",
        "is_interchange",
    )
    return rows.dropDuplicates(["part_number", "vehicle_key", "position"]) if drop_overlaps else rows


def _reference_vehicles(reference: DataFrame) -> DataFrame:
    type_rank = (
        F.when(F.col("vehicle_type") == "Passenger Car", 1)
        .when(F.col("vehicle_type") == "Multipurpose Passenger Vehicle (MPV)", 2)
        .otherwise(3)
    )
    return (
        reference.filter("model_norm <> ''")
        .groupBy(*VEHICLE)
        .agg(
            min_by_present(F.col("model_name"), F.col("vpic_model_id"), F.col("model_name")).alias(
                "_listed_name"
            ),
            min_by_present(F.col("vehicle_type"), type_rank, F.col("vehicle_type")).alias("vehicle_type"),
            F.lit(True).alias("_listed"),
        )
    )


def _observed_vehicles(
    recalls: DataFrame, complaints: DataFrame, conformance: DataFrame, fitted: DataFrame
) -> DataFrame:
    """Counted spellings per vehicle; the rows shrink to distinct spellings before any join.

    A popular vehicle may hold a large share of all rows, so the conformance join runs on
    (vehicle, spelling, source) counts and never on the rows themselves.
    """
    spelled = None
    for frame, tag in ((recalls, "recall"), (complaints, "complaint")):
        part = frame.filter(resolvable()).select(*VEHICLE, F.col("model_raw").alias("model_name"), F.lit(tag).alias("seen_in"))
        spelled = part if spelled is None else spelled.unionByName(part)
    spelled = spelled.groupBy(*VEHICLE, "model_name", "seen_in").agg(F.count(F.lit(1)).alias("n"))
    conformed = attach_conformed(spelled, conformance).select(*VEHICLE, "model_name", "seen_in", "n")
    cataloged = (
        fitted.filter(resolvable())
        .groupBy(*VEHICLE, "model_name")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*VEHICLE, "model_name", F.lit("catalog").alias("seen_in"), "n")
    )
    counts = conformed.unionByName(cataloged)
    names = counts.groupBy(*VEHICLE, "model_name").agg(F.sum("n").alias("n"), F.collect_set("seen_in").alias("_s"))
    # At most three source tags exist, so the tag lists stay short.
    return names.groupBy(*VEHICLE).agg(
        F.min_by(
            "model_name",
            F.when(F.col("model_name").isNotNull(), F.struct(-F.col("n"), F.col("model_name"))),
        ).alias("_seen_name"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("_s")))).alias("seen_in"),
    )


def vehicle_universe(
    reference: DataFrame,
    recalls: DataFrame,
    complaints: DataFrame,
    conformance: DataFrame,
    fitted: DataFrame,
) -> DataFrame:
    """Listed vehicles full-outer observed vehicles (INT-3)."""
    listed = _reference_vehicles(reference)
    seen = _observed_vehicles(recalls, complaints, conformance, fitted)
    return listed.join(seen, VEHICLE, "full").select(
        vehicle_key().alias("vehicle_key"),
        "make",
        F.coalesce("_listed_name", "_seen_name").alias("model_name"),
        "model_norm",
        "model_year",
        F.coalesce("vehicle_type", F.lit("Unknown")).alias("vehicle_type"),
        F.coalesce("_listed", F.lit(False)).alias("in_vpic"),
        F.coalesce("seen_in", F.array().cast("array<string>")).alias("seen_in"),
    )
