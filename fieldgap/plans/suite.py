"""Data tests of the warehouse (DQ-8..DQ-11)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldgap.functions.scalars import tolerant_int
from fieldgap.functions.text import make_name_key, model_name_key
from fieldgap.operators.checks import (
    FrameTest,
    accepted,
    not_null,
    related,
    unique,
    valid_year,
)
from fieldgap.operators.dedup import distinct_by
from fieldgap.operators.merge import scalar_of
from fieldgap.operators.ranges import range_row_count
from fieldgap.plans.intermediate import resolvable
from fieldgap.plans.reference import AGE_BANDS, COVERAGE_STATUSES, PART_STATUSES
from fieldgap.plans.staging import UNKNOWN_YEAR

Tables = Mapping[str, DataFrame]


def column_tests(as_of_year: int) -> list:
    """The tests that are declared per column or per grain."""
    bands = [name for _, name, _ in AGE_BANDS]
    return [
        unique("int_vehicles", "vehicle_key"),
        not_null("int_vehicles", "vehicle_key"),
        not_null("int_vehicles", "model_year"),
        valid_year("int_vehicles", "model_year", as_of_year),
        unique("int_model_conformance", "make", "source_model_norm", "model_year"),
        accepted("int_model_conformance", "match_method", ["exact", "rule", "prefix", "unmatched"]),
        unique("int_fitment_exploded", "part_number", "vehicle_key", "position"),
        not_null("int_fitment_exploded", "vehicle_key"),
        unique("dim_vehicle", "vehicle_key"),
        not_null("dim_vehicle", "vehicle_key"),
        not_null("dim_vehicle", "make"),
        related("dim_vehicle", "make", "make_aliases", "canonical_make"),
        not_null("dim_vehicle", "model_year"),
        valid_year("dim_vehicle", "model_year", as_of_year),
        accepted("dim_vehicle", "age_band", bands),
        unique("dim_component", "component_key"),
        not_null("dim_component", "component_key"),
        not_null("dim_component", "part_category"),
        unique("dim_recall_campaign", "campaign_number"),
        not_null("dim_recall_campaign", "campaign_number"),
        unique("fct_recall_vehicle_component", "campaign_number", "vehicle_key", "component_key"),
        not_null("fct_recall_vehicle_component", "campaign_number"),
        related("fct_recall_vehicle_component", "campaign_number", "dim_recall_campaign", "campaign_number"),
        not_null("fct_recall_vehicle_component", "vehicle_key"),
        related("fct_recall_vehicle_component", "vehicle_key", "dim_vehicle", "vehicle_key"),
        related("fct_recall_vehicle_component", "component_key", "dim_component", "component_key"),
        unique("fct_complaint", "complaint_id"),
        not_null("fct_complaint", "complaint_id"),
        not_null("fct_complaint", "vehicle_key"),
        related("fct_complaint", "vehicle_key", "dim_vehicle", "vehicle_key"),
        not_null("fct_complaint", "received_date"),
        unique("fct_complaint_component", "complaint_id", "component_key"),
        related("fct_complaint_component", "complaint_id", "fct_complaint", "complaint_id"),
        related("fct_complaint_component", "component_key", "dim_component", "component_key"),
        unique("dim_part", "part_number"),
        not_null("dim_part", "part_number"),
        not_null("dim_part", "part_category"),
        accepted("dim_part", "part_status", PART_STATUSES),
        unique("fct_part_fitment", "part_number", "vehicle_key", "position"),
        related("fct_part_fitment", "part_number", "dim_part", "part_number"),
        related("fct_part_fitment", "vehicle_key", "dim_vehicle", "vehicle_key"),
        unique("mart_coverage_gap", "vehicle_key", "part_category"),
        related("mart_coverage_gap", "vehicle_key", "dim_vehicle", "vehicle_key"),
        accepted("mart_coverage_gap", "coverage_status", COVERAGE_STATUSES),
        unique("mart_data_conformance", "source"),
    ]


def unreconciled_complaints(bronze: DataFrame, aliases: DataFrame, facts: DataFrame) -> DataFrame:
    """A row when the in-scope complaints of bronze and the fact rows differ in number."""
    year = F.nullif(tolerant_int(F.col("yeartxt")), F.lit(UNKNOWN_YEAR))
    known = aliases.select(F.col("raw_make").alias("_make"))
    ids = (
        bronze.filter((F.col("prod_type") == "V") & year.isNotNull() & (model_name_key(F.col("modeltxt")) != ""))
        .select("odino", make_name_key(F.col("maketxt")).alias("_make"))
        .join(known, "_make", "left_semi")
        .select("odino")
        .filter(F.col("odino").isNotNull())
    )
    landed = distinct_by(ids, ["odino"]).agg(F.count(F.lit(1)).alias("bronze_complaints"))
    return landed.withColumn(
        "warehouse_complaints", scalar_of(facts, F.count(F.lit(1)))
    ).filter("bronze_complaints <> warehouse_complaints")


def incomplete_explosion(fitment: DataFrame, exploded: DataFrame) -> DataFrame:
    """A row when the exploded years are not exactly the years of all ranges."""
    actual = scalar_of(exploded, F.count(F.lit(1)))
    return range_row_count(fitment, "year_start", "year_end").withColumn("actual_rows", actual).filter(
        "expected_rows <> actual_rows"
    )


def several_vehicles_per_complaint(complaints: DataFrame) -> DataFrame:
    """Complaints that name more than one vehicle.

    The names shuffle once, on the complaint and as one text. The length in front of the model says where
    it ends, so different names give different texts.
    """
    vehicle = F.concat_ws("|", F.col("model_year"), F.length("model_norm"), "model_norm", "make")
    rows = complaints.filter(resolvable()).select("complaint_id", vehicle.alias("vehicle"))
    named = distinct_by(rows, ["complaint_id"])
    return named.groupBy("complaint_id").agg(F.count(F.lit(1)).alias("vehicles")).filter("vehicles > 1")


def broken_score_rules(gap: DataFrame) -> DataFrame:
    """Pairs whose status, coverage and score contradict each other."""
    covered, uncovered = F.col("coverage_status") == "covered", F.col("coverage_status") == "uncovered"
    return gap.filter(
        (uncovered != (F.col("parts_covering") == 0))
        | (covered & (F.col("opportunity_score") != 0))
        | (~covered & (F.col("demand_index") > 0) & (F.col("opportunity_score") <= 0))
        | (F.greatest("complaints_recent", "complaints_severe") > F.col("complaints_total"))
    )


def unmapped_citations(bridge: DataFrame, components: DataFrame, share: float = 0.01) -> DataFrame:
    """A row when too many citations fall outside the taxonomy."""
    counts = bridge.groupBy("component_key").agg(F.count(F.lit(1)).alias("n"))
    cited = counts.join(components.select("component_key", "part_category"), "component_key")
    return cited.agg(
        F.coalesce(F.sum(F.when(F.col("part_category") == "Unmapped", F.col("n"))), F.lit(0)).alias("unmapped"),
        F.sum("n").alias("total"),
    ).filter(F.col("unmapped") > F.lit(share) * F.col("total"))


def warehouse_tests(m: Tables, as_of_year: int) -> list:
    """The whole suite; `m` also holds the staged frames, bronze complaints and the aliases."""
    return column_tests(as_of_year) + [
        FrameTest(
            "complaints_reconcile_to_bronze",
            unreconciled_complaints(m["nhtsa_complaints"], m["make_aliases"], m["fct_complaint"]),
        ),
        FrameTest("coverage_status_consistent", broken_score_rules(m["mart_coverage_gap"])),
        FrameTest(
            "fitment_explosion_complete",
            incomplete_explosion(m["stg_catalog_fitment"], m["int_fitment_exploded"]),
        ),
        FrameTest("one_vehicle_per_complaint", several_vehicles_per_complaint(m["stg_complaints"])),
        FrameTest(
            "unmapped_components_below_threshold",
            unmapped_citations(m["fct_complaint_component"], m["dim_component"]),
            "warn",
        ),
    ]
