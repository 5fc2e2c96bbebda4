"""Contracts of the two supplier feeds (DQ-2..DQ-7, W-4)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldgap.functions.scalars import iso_date, number_or, year_or
from fieldgap.functions.text import collapse_spaces, fully_matches, unfused
from fieldgap.operators.contract import Check, apply_contract, feed_metrics, quarantined_rows, valid_rows
from fieldgap.operators.dedup import flag_repeats
from fieldgap.plans.reference import (
    FITMENT_FEED_COLUMNS,
    PART_FEED_COLUMNS,
    PART_STATUSES,
    canonical_makes,
    serviceable_categories,
)
from fieldgap.sources.feeds import ORDINAL

# Fixed values of the feed contract.
PART_NUMBER_PATTERN = r"[A-Z]{2,4}[0-9]{5,6}"
FIRST_MODEL_YEAR = 1980
YEARS_AHEAD = 2


@dataclass(frozen=True)
class JudgedFeed:
    """A feed with the outcome of every row, and the three frames derived from it."""

    judged: DataFrame
    valid: DataFrame
    quarantined: DataFrame
    metrics: DataFrame


def judge_parts(raw: DataFrame) -> JudgedFeed:
    """Parts contract. Later copies of a part number are rejected even when the first is bad."""
    keyed = raw.select(
        F.struct(*PART_FEED_COLUMNS).alias("_raw"),
        F.regexp_replace("part_number", r"\A[\s\p{Z}]+|[\s\p{Z}]+\z", "").alias("part_number"),
        *[c for c in PART_FEED_COLUMNS if c != "part_number"],
        ORDINAL,
    ).withColumn("_price", unfused(number_or(F.col("list_price"), -1)))
    marked = flag_repeats(keyed, ["part_number"], ORDINAL, "_repeat")
    number = F.coalesce("part_number", F.lit(""))
    judged = apply_contract(
        marked,
        [
            Check("malformed_part_number", ~fully_matches(number, PART_NUMBER_PATTERN)),
            Check("unknown_part_category", ~F.col("part_category").isin(*serviceable_categories())),
            Check("invalid_price", F.col("_price") <= 0),
            Check("invalid_status", ~F.col("status").isin(*PART_STATUSES)),
            Check("duplicate_part_number", F.col("_repeat")),
        ],
    )
    valid = valid_rows(judged).select(
        "part_number",
        "brand",
        "part_type",
        "part_category",
        "description",
        F.col("_price").alias("list_price"),
        "status",
        iso_date(F.col("introduced_date")).alias("introduced_date"),
        "superseded_by",
    )
    return JudgedFeed(
        judged, valid, quarantined_rows(judged, PART_FEED_COLUMNS), feed_metrics(judged, "parts")
    )


def judge_fitment(
    raw: DataFrame, valid_parts: DataFrame, aliases: DataFrame, as_of_year: int
) -> JudgedFeed:
    """Fitment contract: standardise, check, then drop exact repeats among the valid rows."""
    make_raw = F.coalesce("make", F.lit(""))
    model_raw = F.coalesce("model", F.lit(""))
    shaped = raw.select(
        F.struct(*FITMENT_FEED_COLUMNS).alias("_raw"),
        F.regexp_replace("part_number", r"\A[\s\p{Z}]+|[\s\p{Z}]+\z", "").alias("part_number"),
        make_raw.alias("_make_raw"),
        F.upper(collapse_spaces(make_raw)).alias("_make_clean"),
        model_raw.alias("_model_raw"),
        collapse_spaces(model_raw).alias("model"),
        unfused(year_or(F.col("year_start"), -1)).alias("year_start"),
        year_or(F.col("year_end"), -1).alias("year_end"),
        F.coalesce("position", F.lit("N/A")).alias("position"),
        "note",
        ORDINAL,
    )
    names = aliases.select(F.col("raw_make").alias("_alias"), "canonical_make")
    known = valid_parts.select(F.col("part_number").alias("_known_part")).distinct()
    joined = (
        shaped.join(names, F.col("_make_clean") == F.col("_alias"), "left")
        .join(known, F.col("part_number") == F.col("_known_part"), "left")
        .withColumn("make", F.coalesce("canonical_make", "_make_clean"))
    )
    last_year = as_of_year + YEARS_AHEAD

    def off(year: str):
        return ~F.col(year).between(FIRST_MODEL_YEAR, last_year)

    known_years = (F.col("year_start") >= 0) & (F.col("year_end") >= 0)
    checked = apply_contract(
        joined,
        [
            Check("unknown_make", ~F.col("make").isin(*canonical_makes())),
            Check("missing_model", F.length("model") == 0),
            Check("invalid_year", off("year_start") | off("year_end")),
            Check("orphan_part_number", F.col("part_number").isNotNull() & F.col("_known_part").isNull()),
            Check("reversed_year_range", known_years & (F.col("year_start") > F.col("year_end"))),
        ],
    ).withColumns(
        {
            "make_standardized": F.col("make") != F.col("_make_raw"),
            "model_standardized": F.col("model") != F.col("_model_raw"),
        }
    )
    key = ["part_number", "make", "model", "year_start", "year_end", "position"]
    judged = flag_repeats(checked, key, ORDINAL, "_repeat", among=F.size("_reasons") == 0)
    valid = valid_rows(judged.filter("not _repeat")).select(
        *FITMENT_FEED_COLUMNS, "make_standardized", "model_standardized"
    )
    metrics = feed_metrics(
        judged,
        "fitment",
        repeated=F.col("_repeat"),
        standardized=F.col("make_standardized") | F.col("model_standardized"),
    )
    return JudgedFeed(judged, valid, quarantined_rows(judged, FITMENT_FEED_COLUMNS), metrics)
