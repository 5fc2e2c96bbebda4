"""End-user queries over the marts (Q-1..Q-26).

`m` maps table names to frames. Every ordered or limited result has a total order; ties that
the question leaves open are decided by the group columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldgap.functions import sql as sql_functions
from fieldgap.functions.aggregates import mean
from fieldgap.functions.scalars import all_of
from fieldgap.operators.merge import kpi_row, scalar_of
from fieldgap.operators.ranking import capped, keep_top_groups, on_domain, pivot_counts, top_k, with_share
from fieldgap.plans.reference import COVERAGE_STATUSES

Tables = Mapping[str, DataFrame]


def _rows():
    return F.count(F.lit(1))


# ---------------------------------------------------------------- ad-hoc SQL (P-14, T-5)
def ask(
    spark: SparkSession, sql: str, m: Tables, args: Sequence[object] = (), limit: int = 500
) -> tuple[DataFrame, DataFrame]:
    """Run a query over the tables with positional parameters, capped at `limit` rows.

    Tables are written as {name} in the text; the functions of `functions/sql.py` may be called.
    Returns the rows and a one-row frame that says whether more exist.
    """
    sql_functions.register(spark)
    return capped(spark.sql(sql, args=list(args), **m), limit)


# --------------------------------------------------------------------------- overview
def headline(m: Tables) -> DataFrame:
    """Q-1: one row of totals."""
    gap = m["mart_coverage_gap"].filter("complaints_recent > 0")
    return kpi_row(
        m["fct_complaint"].sparkSession,
        complaints=scalar_of(m["fct_complaint"], _rows()),
        campaigns=scalar_of(m["dim_recall_campaign"], _rows()),
        vehicles=scalar_of(m["dim_vehicle"].filter("in_vpic"), _rows()),
        parts=scalar_of(m["dim_part"].filter("part_status = 'Active'"), _rows()),
        fitments=scalar_of(m["fct_part_fitment"], _rows()),
        uncovered_pairs=scalar_of(gap, F.count_if(F.col("coverage_status") == "uncovered")),
        as_of=scalar_of(m["fct_complaint"], F.max("received_date")),
    )


def category_trend(m: Tables, k: int = 5, years: int = 5) -> DataFrame:
    """Q-2: monthly complaints of the top serviceable categories, without the current month.

    A complaint that cites several categories counts once in each of them.
    """
    trends = m["mart_component_trends"]
    served = m["dim_component"].filter("aftermarket_serviceable").select("part_category").distinct()
    top = keep_top_groups(trends.join(served, "part_category", "left_semi"), "part_category", "complaints", k)
    start = F.add_months(scalar_of(trends, F.max("month")), -12 * years)
    current = F.trunc(scalar_of(m["fct_complaint"], F.max("received_date")), "month")
    return (
        top.filter((F.col("month") >= start) & (F.col("month") < current))
        .groupBy("month", "part_category")
        .agg(F.sum("complaints").alias("complaints"))
        .orderBy("month", "part_category")
    )


def recent_demand_by_status(m: Tables) -> DataFrame:
    """Q-3: pairs and recent complaints per coverage status, all statuses listed, with shares."""
    sums = (
        m["mart_coverage_gap"]
        .filter("complaints_recent > 0")
        .groupBy("coverage_status")
        .agg(_rows().alias("pairs"), F.sum("complaints_recent").alias("complaints"))
    )
    full = on_domain(sums, "coverage_status", COVERAGE_STATUSES, ["pairs", "complaints"])
    shares = with_share(full, "complaints", "_share")
    return shares.select(
        "coverage_status", "pairs", "complaints", F.round(F.coalesce("_share", F.lit(0.0)), 4).alias("share")
    )


def biggest_opportunities(m: Tables, k: int = 15) -> DataFrame:
    """Q-4: the pairs with the highest score."""
    scored = m["mart_coverage_gap"].filter("opportunity_score > 0")
    order = [F.desc_nulls_last("opportunity_score"), "vehicle_key", "part_category"]
    return top_k(scored, order, k).select(
        "make", "model_name", "model_year", "part_category", "complaints_recent", "complaints_severe",
        "recall_campaigns", "parts_covering", "coverage_status", "opportunity_score",
    )


# ---------------------------------------------------------------------- coverage gaps
def _gap_filter(category, make, bands, statuses):
    return all_of(
        [
            F.col("complaints_total") + F.col("recall_campaigns") > 0,
            F.col("part_category") == category if category else None,
            F.col("make") == make if make else None,
            F.col("age_band").isin(*bands) if bands else None,
            F.col("coverage_status").isin(*statuses) if statuses else None,
        ]
    )


def ranked_gaps(
    m: Tables,
    category: str | None = None,
    make: str | None = None,
    bands: Sequence[str] = ("3-5 (early aftermarket)", "6-12 (aftermarket core)"),
    statuses: Sequence[str] = ("uncovered", "thin"),
) -> DataFrame:
    """Q-5: filtered pairs, best opportunity first."""
    return (
        m["mart_coverage_gap"]
        .filter(_gap_filter(category, make, bands, statuses))
        .orderBy(
            F.desc_nulls_last("opportunity_score"), F.desc_nulls_last("demand_index"),
            "vehicle_key", "part_category",
        )
        .select(
            "make", "model_name", "model_year", "age_band", "part_category", "complaints_total",
            "complaints_recent", "complaints_severe", "recall_campaigns", "parts_covering",
            "category_median_parts", "coverage_status", "demand_index", "opportunity_score",
        )
    )


def category_status_shares(
    m: Tables,
    category: str | None = None,
    make: str | None = None,
    bands: Sequence[str] = ("3-5 (early aftermarket)", "6-12 (aftermarket core)"),
) -> DataFrame:
    """Q-5: recent complaints per category with one column per status, least uncovered first."""
    sums = m["mart_coverage_gap"].filter(_gap_filter(category, make, bands, ())).groupBy("part_category").agg(
        *[
            F.sum(F.when(F.col("coverage_status") == s, F.col("complaints_recent")).otherwise(0)).alias(s)
            for s in COVERAGE_STATUSES
        ],
        F.sum("complaints_recent").alias("complaints"),
    )
    share = F.round(F.col("uncovered") / F.col("complaints"), 4).alias("uncovered_share")
    return (
        sums.filter("complaints > 0")
        .select("part_category", *COVERAGE_STATUSES, "complaints", share)
        .orderBy("uncovered_share", "part_category")
    )


# ------------------------------------------------------------------- one make / vehicle
def model_list(m: Tables, make: str) -> DataFrame:
    """Q-6: listed models of a make with their number of model years."""
    listed = m["dim_vehicle"].filter((F.col("make") == make) & F.col("in_vpic"))
    return listed.groupBy("model_name").agg(_rows().alias("n")).orderBy("model_name")


def complaints_by_model_year(m: Tables, make: str, model: str) -> DataFrame:
    """Q-6: model years of a model with complaints, including years without any."""
    listed = m["dim_vehicle"].filter(
        (F.col("make") == make) & (F.col("model_name") == model) & F.col("in_vpic")
    )
    joined = listed.join(m["fct_complaint"].select("vehicle_key", "complaint_id"), "vehicle_key", "left")
    return (
        joined.groupBy("model_year")
        .agg(F.count("complaint_id").alias("complaints"))
        .orderBy(F.desc("model_year"))
    )


def vehicle_key_of(m: Tables, make: str, model: str, year: int):
    """The key of one listed vehicle as a scalar subquery."""
    row = m["dim_vehicle"].filter(
        (F.col("make") == make) & (F.col("model_name") == model) & (F.col("model_year") == year) & F.col("in_vpic")
    )
    return scalar_of(row, F.min("vehicle_key"))


def vehicle_stats(m: Tables, make: str, model: str, year: int) -> DataFrame:
    """Q-7: totals of one vehicle."""
    here = F.col("vehicle_key") == vehicle_key_of(m, make, model, year)
    complaints = m["fct_complaint"].filter(here)
    return kpi_row(
        complaints.sparkSession,
        complaints=scalar_of(complaints, _rows()),
        severe=scalar_of(complaints, F.count_if("is_severe")),
        recalls=scalar_of(m["fct_recall_vehicle_component"].filter(here), F.count_distinct("campaign_number")),
        parts=scalar_of(m["fct_part_fitment"].filter(here), F.count_distinct("part_number")),
    )


def vehicle_gaps(m: Tables, make: str, model: str, year: int) -> DataFrame:
    """Q-8: demand and coverage per category of one vehicle."""
    here = F.col("vehicle_key") == vehicle_key_of(m, make, model, year)
    return (
        m["mart_coverage_gap"]
        .filter(here)
        .select(
            "part_category", "complaints_total", "complaints_severe", "recall_campaigns",
            "parts_covering", "coverage_status", "opportunity_score",
        )
        .orderBy(F.desc("complaints_total"), "part_category")
    )


def vehicle_recalls(m: Tables, make: str, model: str, year: int) -> DataFrame:
    """Q-8: campaigns that name one vehicle."""
    here = F.col("vehicle_key") == vehicle_key_of(m, make, model, year)
    links = m["fct_recall_vehicle_component"].filter(here).select("campaign_number")
    return (
        m["dim_recall_campaign"]
        .join(links, "campaign_number", "left_semi")
        .select(
            "campaign_number", "report_received_date", "manufacturer", "units_affected",
            "do_not_drive", "defect_summary",
        )
        .orderBy(F.desc_nulls_last("report_received_date"), "campaign_number")
    )


def vehicle_parts(m: Tables, make: str, model: str, year: int) -> DataFrame:
    """Q-8: parts that fit one vehicle."""
    here = F.col("vehicle_key") == vehicle_key_of(m, make, model, year)
    fits = m["fct_part_fitment"].filter(here).select("part_number", "position", "is_interchange")
    return (
        fits.join(m["dim_part"], "part_number")
        .select(
            "part_number", "part_type", "part_category", "position", "brand", "list_price",
            "part_status", "is_interchange",
        )
        .orderBy("part_category", "part_type", "position", "part_number")
    )


def vehicle_complaints(m: Tables, make: str, model: str, year: int, k: int = 25) -> DataFrame:
    """Q-8: newest complaints of one vehicle."""
    here = F.col("vehicle_key") == vehicle_key_of(m, make, model, year)
    rows = m["fct_complaint"].filter(here)
    return top_k(rows, [F.desc_nulls_last("received_date"), "complaint_id"], k).select(
        "received_date", "is_crash", "is_fire", "injuries", "odometer_miles", "narrative"
    )


# ------------------------------------------------------------------------ data quality
def _of_newest_run(log: DataFrame, run: str, ts: str) -> DataFrame:
    """Rows of the newest run in a log (J-16, T-4)."""
    return log.filter(F.col(run) == scalar_of(log, F.max_by(run, F.struct(ts, run))))


def latest_test_status(results: DataFrame) -> DataFrame:
    """Q-9: node counts per resource type and status of the newest build."""
    rows = _of_newest_run(results.filter("command = 'build'"), "invocation_id", "recorded_at")
    listed = ["success", "pass", "warn", "fail", "error"]
    known = F.coalesce(F.when(F.col("status").isin(listed), F.col("status")), F.lit("other"))
    return pivot_counts(rows.withColumn("status", known), "resource_type", "status", [*listed, "other"])


def failing_nodes(results: DataFrame) -> DataFrame:
    """Q-9: nodes of the newest build that need attention."""
    rows = _of_newest_run(results.filter("command = 'build'"), "invocation_id", "recorded_at")
    return rows.filter(~F.col("status").isin("success", "pass", "no-op")).select(
        "unique_id", "status", "failures", "message"
    )


def latest_feed_metrics(runs: DataFrame) -> DataFrame:
    """Q-10: metrics and reasons of the newest feed run."""
    return _of_newest_run(runs, "run_id", "run_at").select(
        "feed", "rows_in", "rows_valid", "rows_quarantined", "standardized", "deduplicated",
        "reason", "reason_count",
    )


def feed_summary(runs: DataFrame) -> DataFrame:
    """Q-10: one row per feed of the newest run."""
    return latest_feed_metrics(runs).drop("reason", "reason_count").dropDuplicates(["feed"])


def quarantine_sample(quarantined: DataFrame, k: int = 200) -> tuple[DataFrame, DataFrame]:
    """Q-10: the first rejected rows by all their columns, and whether there are more."""
    return capped(quarantined, k, [F.col(c) for c in quarantined.columns])


def conformance_table(m: Tables) -> DataFrame:
    """Q-11: match rates per source."""
    return m["mart_data_conformance"].select(
        "source", "rows_total", "rows_in_scope", "rows_in_reference_years", "matched_exact",
        "matched_rule", "matched_prefix", "exact_match_rate", "vpic_match_rate",
    ).orderBy("source")


def load_history(manifest: DataFrame, k: int = 50) -> tuple[DataFrame, DataFrame]:
    """Q-11: newest load attempts, and whether there are more."""
    rows, more = capped(manifest, k, [F.desc("loaded_at"), F.col("source"), F.col("batch_id")])
    return rows.select(
        "source", "status", "rows_loaded", "columns_seen", "columns_expected", "etag", "loaded_at"
    ), more


def run_history(runs: DataFrame, k: int = 30) -> tuple[DataFrame, DataFrame]:
    """Q-11: newest stage runs, and whether there are more."""
    rows, more = capped(runs, k, [F.desc("finished_at"), F.col("stage"), F.col("run_id")])
    return rows.select("run_id", "stage", "status", "seconds", "finished_at"), more


# -------------------------------------------------------------- question set (Q-12..Q-26)
def do_not_drive_campaigns(m: Tables) -> DataFrame:
    return m["dim_recall_campaign"].filter("do_not_drive").agg(_rows().alias("campaigns"))


def top_makes(m: Tables, year: int = 2024, k: int = 5) -> DataFrame:
    rows = m["fct_complaint"].filter(F.year("received_date") == year).groupBy("vehicle_key").agg(_rows().alias("n"))
    makes = rows.join(m["dim_vehicle"].select("vehicle_key", "make"), "vehicle_key")
    return top_k(
        makes.groupBy("make").agg(F.sum("n").alias("complaints")), [F.desc("complaints"), "make"], k
    )


def _one_vehicle(m: Tables, make: str, model_norm: str, year: int | None = None) -> DataFrame:
    wanted = (F.col("make") == make) & (F.col("model_norm") == model_norm)
    if year is not None:
        wanted = wanted & (F.col("model_year") == year)
    return m["dim_vehicle"].filter(wanted).select("vehicle_key")


def _cited(m: Tables, complaints: DataFrame) -> DataFrame:
    """Distinct (complaint, category) rows of the given complaints."""
    categories = m["dim_component"].select("component_key", "part_category")
    return (
        complaints.join(m["fct_complaint_component"].select("complaint_id", "component_key"), "complaint_id")
        .join(categories, "component_key")
        .drop("component_key")
        .distinct()
    )


def top_category_of_vehicle(
    m: Tables, make: str = "HONDA", model_norm: str = "CIVIC", year: int = 2018, k: int = 1
) -> DataFrame:
    rows = m["fct_complaint"].join(_one_vehicle(m, make, model_norm, year), "vehicle_key", "left_semi")
    counts = _cited(m, rows.select("complaint_id")).groupBy("part_category").agg(_rows().alias("complaints"))
    return top_k(counts, [F.desc("complaints"), "part_category"], k)


def fires_of_model(m: Tables, make: str = "FORD", model_norm: str = "F 150") -> DataFrame:
    rows = m["fct_complaint"].filter("is_fire").join(_one_vehicle(m, make, model_norm), "vehicle_key", "left_semi")
    return rows.agg(_rows().alias("fire_complaints"))


def recalls_per_year(m: Tables, first: int = 2020, last: int = 2024) -> DataFrame:
    year = F.year("report_received_date")
    rows = m["dim_recall_campaign"].filter(year.between(first, last))
    return rows.groupBy(year.alias("year")).agg(_rows().alias("campaigns")).orderBy("year")


def uncovered_categories(m: Tables, k: int = 5) -> DataFrame:
    rows = m["mart_coverage_gap"].filter("coverage_status = 'uncovered' and complaints_recent > 0")
    counts = rows.groupBy("part_category").agg(_rows().alias("uncovered_vehicles"))
    return top_k(counts, [F.desc("uncovered_vehicles"), "part_category"], k)


def average_price_by_category(m: Tables) -> DataFrame:
    active = m["dim_part"].filter("part_status = 'Active'")
    return (
        active.groupBy("part_category")
        .agg(mean(F.col("list_price"), 2).alias("avg_list_price"))
        .orderBy("part_category")
    )


def parts_for_vehicle(
    m: Tables, make: str = "TOYOTA", model_norm: str = "CAMRY", year: int = 2017
) -> DataFrame:
    fits = m["fct_part_fitment"].join(_one_vehicle(m, make, model_norm, year), "vehicle_key", "left_semi")
    active = m["dim_part"].filter("part_status = 'Active'").select("part_number")
    return fits.join(active, "part_number", "left_semi").agg(F.count_distinct("part_number").alias("parts"))


def top_opportunities_in_category(m: Tables, category: str = "Fuel System", k: int = 10) -> DataFrame:
    rows = m["mart_coverage_gap"].filter(F.col("part_category") == category)
    return top_k(rows, [F.desc_nulls_last("opportunity_score"), "vehicle_key"], k).select(
        "make", "model_name", "model_year"
    )


def largest_recall(m: Tables, since: str = "2020-01-01") -> DataFrame:
    rows = m["dim_recall_campaign"].filter(F.col("report_received_date") >= F.lit(since).cast("date"))
    order = [F.desc_nulls_last("units_affected"), "campaign_number"]
    return top_k(rows, order, 1).select("campaign_number", "units_affected")


def top_state_for_category(
    m: Tables, category: str = "Brakes", year: int = 2023, k: int = 1
) -> DataFrame:
    rows = m["fct_complaint"].filter(
        (F.year("received_date") == year) & F.col("owner_state").isNotNull()
    )
    cited = _cited(m, rows.select("complaint_id", "owner_state")).filter(F.col("part_category") == category)
    counts = cited.groupBy("owner_state").agg(_rows().alias("complaints"))
    return top_k(counts, [F.desc("complaints"), "owner_state"], k)


def vehicles_not_listed(m: Tables) -> DataFrame:
    return m["dim_vehicle"].filter("not in_vpic").agg(_rows().alias("vehicles"))


def crash_share_by_make(m: Tables, at_least: int = 5000, k: int = 1) -> DataFrame:
    rows = m["fct_complaint"].groupBy("vehicle_key").agg(_rows().alias("n"), F.count_if("is_crash").alias("crashes"))
    makes = rows.join(m["dim_vehicle"].select("vehicle_key", "make"), "vehicle_key").groupBy("make").agg(
        F.sum("n").alias("n"), F.sum("crashes").alias("crashes")
    )
    shares = makes.filter(F.col("n") >= at_least).select(
        "make", F.round(F.col("crashes") / F.col("n"), 4).alias("crash_share")
    )
    return top_k(shares, [F.desc("crash_share"), "make"], k)


def recent_by_age_band(m: Tables, category: str = "Electrical & Ignition") -> DataFrame:
    rows = m["mart_coverage_gap"].filter(F.col("part_category") == category)
    return rows.groupBy("age_band").agg(F.sum("complaints_recent").alias("complaints")).orderBy("age_band")


def severe_by_model(m: Tables, make: str = "TESLA") -> DataFrame:
    rows = m["fct_complaint"].filter("is_severe").groupBy("vehicle_key").agg(_rows().alias("n"))
    names = m["dim_vehicle"].filter(F.col("make") == make).select("vehicle_key", "model_name")
    return (
        rows.join(names, "vehicle_key")
        .groupBy("model_name")
        .agg(F.sum("n").alias("severe_complaints"))
        .orderBy(F.desc("severe_complaints"), "model_name")
    )
