"""Dimensions, facts and marts (DIM-1..DIM-4, FCT-1..FCT-4, MART-1..MART-3, SNAP-1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldgap.functions.aggregates import max_by_present
from fieldgap.functions.scalars import banded, month_of, months_before
from fieldgap.functions.text import path_key, path_level, trim_spaces
from fieldgap.operators.collapse import collapse
from fieldgap.operators.conform import attach_conformed, conformance_rates
from fieldgap.operators.dedup import distinct_by, latest_per_key, packed, unpacked
from fieldgap.operators.gap import coverage_gap
from fieldgap.operators.incremental import (
    current_with_versions,
    first_versions,
    keyed_replace,
    next_history,
    rows_after,
    rows_of_touched_keys,
)
from fieldgap.operators.merge import full_outer_merge, lookup, scalar_of
from fieldgap.plans.intermediate import resolvable, vehicle_key
from fieldgap.plans.reference import AGE_BANDS, RECENT_MONTHS


# ------------------------------------------------------------------------ dimensions
def dim_vehicle(vehicles: DataFrame, as_of_year: int) -> DataFrame:
    """Vehicles with age, band and demand weight (DIM-1)."""
    age = F.greatest(F.lit(as_of_year) - F.col("model_year"), F.lit(0))
    bands = banded(F.col("vehicle_age_years"), [(top, name) for top, name, _ in AGE_BANDS])
    weights = banded(F.col("vehicle_age_years"), [(top, w) for top, _, w in AGE_BANDS])
    return vehicles.withColumn("vehicle_age_years", age).withColumns(
        {"age_band": bands, "aftermarket_age_weight": weights.cast("decimal(3,2)")}
    )


def dim_component(recalls: DataFrame, complaints: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Distinct component paths with their part category (DIM-2)."""
    cols = ["component_path", "nhtsa_system"]
    named = F.col("component_path").isNotNull()
    paths = recalls.filter(named).select(*cols).unionByName(complaints.filter(named).select(*cols)).distinct()
    mapped = lookup(
        paths,
        taxonomy,
        {"nhtsa_system": "nhtsa_system"},
        {"part_category": "part_category", "aftermarket_serviceable": "aftermarket_serviceable"},
        {"part_category": "Unmapped", "aftermarket_serviceable": False},
    )
    return mapped.select(
        path_key(F.col("component_path")).alias("component_key"),
        "component_path",
        "nhtsa_system",
        F.nullif(trim_spaces(path_level(F.col("component_path"), 2)), F.lit("")).alias("nhtsa_subsystem"),
        "part_category",
        "aftermarket_serviceable",
    )


def dim_recall_campaign(recalls: DataFrame) -> DataFrame:
    """One row per campaign; campaign-wide values are taken once (DIM-3).

    Ties are decided by the lowest record id. Out-of-scope makes count too.
    """
    row = F.col("recall_record_id")

    def longest(name: str) -> Column:
        return max_by_present(F.col(name), F.length(name), row)

    def newest(name: str) -> Column:
        return max_by_present(F.col(name), F.col("_loaded_at"), row)

    header = collapse(
        recalls,
        ["campaign_number"],
        {
            "manufacturer": newest("manufacturer"),
            "units_affected": F.max("campaign_units_affected"),
            "report_received_date": F.min("report_received_date"),
            "owner_notification_date": F.min("owner_notification_date"),
            "initiated_by": newest("initiated_by"),
            "do_not_drive": F.bool_or("do_not_drive"),
            "park_outside": F.bool_or("park_outside"),
            "defect_summary": longest("defect_summary"),
            "consequence_summary": longest("consequence_summary"),
            "remedy_summary": longest("remedy_summary"),
        },
    )
    # The distinct counts read narrow columns. Next to the texts they would expand every wide
    # row once per count.
    vehicles = recalls.groupBy("campaign_number").agg(
        F.count_distinct("make", "model_norm", "model_year").alias("vehicles_named")
    )
    components = recalls.groupBy("campaign_number").agg(
        F.count_distinct("component_path").alias("components_named")
    )
    return header.join(vehicles, "campaign_number").join(components, "campaign_number")


def part_history(history: DataFrame | None, parts: DataFrame, as_of: Column) -> DataFrame:
    """Price and status history of the parts master (SNAP-1)."""
    if history is None:
        return first_versions(parts, as_of)
    return next_history(history, parts, "part_number", ["list_price", "status"], as_of)


def dim_part(history: DataFrame) -> DataFrame:
    """Open version of each part with its version count (DIM-4)."""
    return current_with_versions(history, "part_number").select(
        "part_number",
        "brand",
        "part_type",
        "part_category",
        "description",
        F.col("list_price").cast("decimal(10,2)").alias("list_price"),
        F.col("status").alias("part_status"),
        F.col("introduced_date").cast("date").alias("introduced_date"),
        "version_count",
        "first_seen_at",
        F.col("valid_from").alias("current_version_from"),
    )


# ----------------------------------------------------------------------------- facts
def fct_complaint(
    complaints: DataFrame,
    conformance: DataFrame,
    current: DataFrame | None = None,
    renamed: DataFrame | None = None,
    drop_vanished: bool = False,
) -> DataFrame:
    """One row per complaint; severity is taken once per complaint (FCT-1).

    With `current`, only complaints that have a newer row are rebuilt and replaced. Names
    whose conformance changed since then are given as `renamed`; complaints that use them are
    rebuilt too. With `drop_vanished`, complaints that no delivered row names any more are
    removed. The wide rows shuffle once, on the complaint; cited components are counted on
    narrow rows, and names are conformed on the collapsed rows.
    """
    rows = complaints.filter(resolvable())
    if current is None:
        return _collapsed_complaints(rows, conformance)
    ids = rows_after(rows, current, "_loaded_at").select("complaint_id")
    if renamed is not None:
        names = renamed.select("make", F.col("source_model_norm").alias("model_norm"), "model_year")
        moved = rows.join(names, ["make", "model_norm", "model_year"], "left_semi").select("complaint_id")
        ids = ids.unionByName(moved)
    touched = rows.join(ids.distinct(), "complaint_id", "left_semi")
    kept = _still_delivered(current, rows) if drop_vanished else current
    return keyed_replace(kept, _collapsed_complaints(touched, conformance), ["complaint_id"])


def _still_delivered(current: DataFrame, rows: DataFrame) -> DataFrame:
    return current.join(rows.select("complaint_id").distinct(), "complaint_id", "left_semi")


def renamed_models(before: DataFrame, now: DataFrame) -> DataFrame:
    """Observed names that now resolve to another model than before."""
    return now.join(before, ["make", "source_model_norm", "model_year", "model_norm"], "left_anti")


def _vehicle_struct() -> Column:
    """All three vehicle columns from the same row, so they stay consistent."""
    return F.min(F.struct("make", "model_norm", "model_year"))


def _collapsed_complaints(rows: DataFrame, conformance: DataFrame) -> DataFrame:
    # Rows shuffle once, as they come: a complaint has few rows, so combining them per map task would
    # drop hardly any, and its sort of wide rows spills where a task reads many. Where they lie by complaint
    # in the order of their components, a component's first row counts it, without a shuffle of its
    # own. Columns go in the order in which the shuffled rows compress best: fixed width first, then the
    # most varied texts, which travel packed as one.
    wide = rows.select(
        "is_crash",
        "is_fire",
        "needed_medical_attention",
        "vehicle_towed",
        "injuries",
        "deaths",
        "_loaded_at",
        "received_date",
        "failure_date",
        "odometer_miles",
        "model_year",
        "complaint_id",
        "complaint_component_id",
        "narrative",
        "complaint_source",
        "owner_state",
        "make",
        "model_norm",
        F.col("component_path").alias("_component"),
    )
    texts = ["narrative", "complaint_source", "owner_state", "make", "model_norm"]
    before = F.lag("_component").over(Window.partitionBy("complaint_id").orderBy("_component"))
    first = F.col("_component").isNotNull() & ~F.col("_component").eqNullSafe(before)
    header = collapse(
        unpacked(packed(wide, texts).withColumn("_first_of_component", first), texts),
        ["complaint_id"],
        {
            "_v": _vehicle_struct(),
            "received_date": F.min("received_date"),
            "failure_date": F.min("failure_date"),
            "is_crash": F.bool_or("is_crash"),
            "is_fire": F.bool_or("is_fire"),
            "injuries": F.max("injuries"),
            "deaths": F.max("deaths"),
            "needed_medical_attention": F.bool_or("needed_medical_attention"),
            "vehicle_towed": F.bool_or("vehicle_towed"),
            "odometer_miles": F.max("odometer_miles"),
            "owner_state": F.min("owner_state"),
            "complaint_source": F.min("complaint_source"),
            "narrative": max_by_present(
                F.col("narrative"), F.length("narrative"), F.col("complaint_component_id")
            ),
            "_cited": F.count_if("_first_of_component"),
            "_loaded_at": F.max("_loaded_at"),
        },
    )
    # Rows without a complaint id are no complaint whose components could be counted.
    header = header.withColumn("components_cited", F.when(F.col("complaint_id").isNotNull(), F.col("_cited")))
    severe = F.col("is_crash") | F.col("is_fire") | (F.col("injuries") > 0) | (F.col("deaths") > 0)
    return attach_conformed(header.select("*", "_v.*"), conformance).select(
        "complaint_id",
        vehicle_key().alias("vehicle_key"),
        "received_date",
        "failure_date",
        "is_crash",
        "is_fire",
        "injuries",
        "deaths",
        severe.alias("is_severe"),
        "needed_medical_attention",
        "vehicle_towed",
        "odometer_miles",
        "owner_state",
        "complaint_source",
        "components_cited",
        "narrative",
        "_loaded_at",
    )


def fct_complaint_component(
    complaints: DataFrame, current: DataFrame | None = None, drop_vanished: bool = False
) -> DataFrame:
    """Bridge from complaints to the components they cite (FCT-2).

    Incrementally, all bridge rows of a touched complaint are replaced, so a component that
    a corrected complaint no longer cites does not stay behind.
    """
    rows = complaints.filter(resolvable() & F.col("component_path").isNotNull())

    def bridge(part: DataFrame) -> DataFrame:
        # All rows of a complaint land in one file, so later counts per complaint combine them there.
        keyed = part.select("_loaded_at", "complaint_id", path_key(F.col("component_path")).alias("component_key"))
        newest = latest_per_key(
            keyed.repartition("complaint_id"), ["complaint_id", "component_key"], [F.desc_nulls_last("_loaded_at")]
        )
        return newest.select("complaint_id", "component_key", "_loaded_at")

    if current is None:
        return bridge(rows)
    touched = rows_of_touched_keys(rows, current, "complaint_id", "_loaded_at")
    kept = _still_delivered(current, rows) if drop_vanished else current
    return keyed_replace(kept, bridge(touched), ["complaint_id"])


def fct_recall_vehicle_component(recalls: DataFrame, conformance: DataFrame) -> DataFrame:
    """Distinct campaign x vehicle x component (FCT-3)."""
    narrow = recalls.filter(resolvable()).select(
        "campaign_number", "make", "model_norm", "model_year", "component_path", "report_received_date"
    )
    return (
        attach_conformed(narrow, conformance)
        .select(
            "campaign_number",
            vehicle_key().alias("vehicle_key"),
            path_key(F.col("component_path")).alias("component_key"),
            "report_received_date",
        )
        .distinct()
    )


def fct_part_fitment(fitted: DataFrame, parts: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Part x vehicle x position, for parts with an open version (FCT-4)."""
    return (
        fitted.select("part_number", "vehicle_key", "position", "is_interchange")
        .join(parts.select("part_number"), "part_number", "left_semi")
        .join(vehicles.select("vehicle_key", F.col("in_vpic").alias("fitment_verified_in_vpic")), "vehicle_key")
        .select("part_number", "vehicle_key", "position", "is_interchange", "fitment_verified_in_vpic")
    )


# ----------------------------------------------------------------------------- marts
def _cited_categories(bridge: DataFrame, components: DataFrame) -> DataFrame:
    """Distinct (complaint, category) pairs; later counts need no DISTINCT.

    Pairs shuffle once, on the complaint, and lie there for the join with the complaints.
    """
    cited = bridge.join(components.select("component_key", "part_category"), "component_key")
    return distinct_by(cited.select("complaint_id", "part_category"), ["complaint_id"])


def mart_coverage_gap(
    complaints: DataFrame,
    bridge: DataFrame,
    recall_links: DataFrame,
    components: DataFrame,
    vehicles: DataFrame,
    fitments: DataFrame,
    parts: DataFrame,
    recent_months: int = RECENT_MONTHS,
) -> DataFrame:
    """Scored vehicle x serviceable category pairs with a demand signal (MART-1).

    "Recent" counts back from the newest complaint, so a data snapshot always scores alike.
    """
    served = components.filter("aftermarket_serviceable")
    anchor = scalar_of(complaints, F.max("received_date"))
    recent = F.col("received_date") > months_before(anchor, recent_months)
    complaint_signal = (
        complaints.select("complaint_id", "vehicle_key", "is_severe", recent.alias("is_recent"))
        .join(_cited_categories(bridge, served), "complaint_id")
        .groupBy("vehicle_key", "part_category")
        .agg(
            F.count(F.lit(1)).alias("complaints_total"),
            F.count_if("is_recent").alias("complaints_recent"),
            F.count_if("is_severe").alias("complaints_severe"),
        )
    )
    recall_signal = (
        recall_links.join(served.select("component_key", "part_category"), "component_key")
        .select("vehicle_key", "part_category", "campaign_number")
        .distinct()
        .groupBy("vehicle_key", "part_category")
        .agg(F.count("campaign_number").alias("recall_campaigns"))
    )
    # FCT-4 rows have a vehicle, and no pair has a NULL category. Said here, both readers of the
    # coverage have the same conditions and share its shuffles. Rows shuffle once, on the part, and lie
    # there for the join with the parts.
    fitted = fitments.filter("vehicle_key is not null").select("part_number", "vehicle_key")
    coverage = (
        distinct_by(fitted, ["part_number"])
        .join(
            parts.filter("part_status = 'Active' and part_category is not null").select("part_number", "part_category"),
            "part_number",
        )
        .groupBy("vehicle_key", "part_category")
        .agg(F.count(F.lit(1)).alias("parts_covering"))
    )
    signals = full_outer_merge(
        complaint_signal,
        recall_signal,
        ["vehicle_key", "part_category"],
        {"complaints_total": 0, "complaints_recent": 0, "complaints_severe": 0, "recall_campaigns": 0},
    )
    scored = coverage_gap(
        signals,
        coverage,
        vehicles.select(
            "vehicle_key", "make", "model_name", "model_year", "age_band", "aftermarket_age_weight"
        ),
        entity="vehicle_key",
        category="part_category",
        supply="parts_covering",
        demand_terms={"complaints_recent": 1.0, "complaints_severe": 2.0, "recall_campaigns": 1.5},
        weight="aftermarket_age_weight",
        median_name="category_median_parts",
    )
    return scored.select(
        "vehicle_key",
        "make",
        "model_name",
        "model_year",
        "age_band",
        "part_category",
        "complaints_total",
        "complaints_recent",
        "complaints_severe",
        "recall_campaigns",
        "parts_covering",
        "category_median_parts",
        "coverage_status",
        "demand_index",
        "opportunity_score",
        "category_rank",
    )


def mart_component_trends(
    complaints: DataFrame,
    bridge: DataFrame,
    recall_links: DataFrame,
    components: DataFrame,
    vehicles: DataFrame,
) -> DataFrame:
    """Complaints and recalls per month, make and category (MART-2)."""
    makes = vehicles.select("vehicle_key", "make")
    grain = ["month", "make", "part_category"]
    reported = (
        complaints.filter(F.col("received_date").isNotNull())
        .select("complaint_id", "vehicle_key", "is_severe", month_of(F.col("received_date")).alias("month"))
        .join(makes, "vehicle_key")
        .drop("vehicle_key")
        .join(_cited_categories(bridge, components), "complaint_id")
        .groupBy(*grain)
        .agg(F.count(F.lit(1)).alias("complaints"), F.count_if("is_severe").alias("severe_complaints"))
    )
    recalled = (
        recall_links.filter(F.col("report_received_date").isNotNull())
        .join(components.select("component_key", "part_category"), "component_key")
        .join(makes, "vehicle_key")
        .select(month_of(F.col("report_received_date")).alias("month"), "make", "part_category", "campaign_number")
        .distinct()
        .groupBy(*grain)
        .agg(F.count("campaign_number").alias("recall_campaigns"))
    )
    merged = full_outer_merge(
        reported, recalled, grain, {"complaints": 0, "severe_complaints": 0, "recall_campaigns": 0}
    )
    return merged.select(*grain, "complaints", "severe_complaints", "recall_campaigns")


def mart_data_conformance(
    recalls: DataFrame,
    complaints: DataFrame,
    reference: DataFrame,
    conformance: DataFrame,
    fitted: DataFrame,
    vehicles: DataFrame,
) -> DataFrame:
    """Match rates per source inside the reference's model years (MART-3).

    Rows are counted per vehicle name before the joins, so a popular name is one row.
    """
    first_year = scalar_of(reference, F.min("model_year"))
    last_year = scalar_of(reference, F.max("model_year"))
    inside = F.col("model_year").between(first_year, last_year)

    named = None
    for frame, tag in ((recalls, "nhtsa_recalls"), (complaints, "nhtsa_complaints")):
        part = frame.select(F.lit(tag).alias("source"), "make", "model_norm", "model_year")
        named = part if named is None else named.unionByName(part)
    named = named.groupBy("source", "make", "model_norm", "model_year").agg(F.count(F.lit(1)).alias("_n"))
    observed = attach_conformed(
        named.withColumn("resolvable", F.coalesce(resolvable(), F.lit(False))), conformance, how="left"
    ).select(
        "source",
        F.col("make").isNotNull().alias("in_scope"),
        "resolvable",
        inside.alias("in_reference_years"),
        "match_method",
        "_n",
    )
    cataloged = (
        fitted.groupBy("vehicle_key", "model_year")
        .agg(F.count(F.lit(1)).alias("_n"))
        .join(vehicles.select("vehicle_key", "in_vpic"), "vehicle_key", "left")
        .select(
            F.lit("catalog_fitment").alias("source"),
            F.lit(True).alias("in_scope"),
            F.lit(True).alias("resolvable"),
            inside.alias("in_reference_years"),
            F.when(F.col("in_vpic"), "exact").otherwise("unmatched").alias("match_method"),
            "_n",
        )
    )
    return conformance_rates(observed.unionByName(cataloged), weight="_n")
