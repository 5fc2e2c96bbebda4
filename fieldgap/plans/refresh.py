"""One run over the whole warehouse: land, validate, model, test (SRC-14..SRC-17, INC-7, INC-8).

Every model is written once and read back from Parquet by its consumers, so lineage is cut at
each table: a lost executor only repeats work of the model being written.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from fieldgap.operators.checks import run_checks
from fieldgap.plans import intermediate, marts, reference, staging
from fieldgap.plans.catalog import judge_fitment, judge_parts
from fieldgap.plans.reference import (
    COMPLAINT_FILES,
    FITMENT_FEED_COLUMNS,
    PART_FEED_COLUMNS,
    RECALL_FILES,
    canonical_makes,
    component_taxonomy,
    make_aliases,
    model_rules,
)
from fieldgap.plans.suite import warehouse_tests
from fieldgap.sources.documents import read_documents, reference_models
from fieldgap.sources.feeds import read_feed
from fieldgap.sources.landing import LandingResult, land_flat_files
from fieldgap.sources.positional import content_fingerprint, read_lines
from fieldgap.sources.store import WRITERS, Warehouse, utc_now


class DataTestError(RuntimeError):
    """Tests of error severity failed; the models they looked at are not current."""


#: One part per run, current together with the tables that the run published.
CATALOG_RUNS = "meta.catalog_dq_runs"
RESULT_SCHEMA = (
    "invocation_id string, command string, unique_id string, resource_type string, status string, "
    "failures bigint, message string, recorded_at timestamp, seconds double"
)
RUN_SCHEMA = "run_id string, stage string, status string, seconds double, message string, finished_at timestamp"


@dataclass(frozen=True)
class Inputs:
    """Where one refresh finds its inputs; anything left out is not refreshed."""

    as_of_year: int
    flat_files: Mapping[str, str] = field(default_factory=dict)
    reference_years: str | None = None
    reference_types: str | None = None
    parts_feed: str | None = None
    fitment_feed: str | None = None

    def check(self) -> None:
        """Paired inputs are given together."""
        for pair in (("reference_years", "reference_types"), ("parts_feed", "fitment_feed")):
            given = [name for name in pair if getattr(self, name)]
            if len(given) == 1:
                raise ValueError(f"{given[0]} is given without its partner of {pair}")


def land(spark: SparkSession, wh: Warehouse, inputs: Inputs, force: bool = False) -> list[LandingResult]:
    return land_flat_files(spark, wh, RECALL_FILES + COMPLAINT_FILES, inputs.flat_files, force)


def load_reference(spark: SparkSession, wh: Warehouse, inputs: Inputs) -> None:
    models = reference_models(
        read_documents(spark, inputs.reference_years),
        read_documents(spark, inputs.reference_types),
        canonical_makes(),
    )
    wh.replace("bronze.vpic_models", models.withColumn("_loaded_at", F.lit(utc_now())))


def publish_catalog(spark: SparkSession, wh: Warehouse, raw_parts: DataFrame, raw_fitment: DataFrame, as_of_year: int) -> None:
    """Validate both feeds and publish bronze, quarantine and run metrics in one commit."""
    run_id, now = uuid.uuid4().hex[:12], utc_now()
    stamp, run = F.lit(now), F.lit(run_id)
    parts = judge_parts(raw_parts)
    paths = wh.write_versions(
        {
            "bronze.catalog_parts": parts.valid.withColumn("_loaded_at", stamp),
            "quarantine.catalog_parts": parts.quarantined.withColumn("_run_id", run),
        }
    )
    # The fitment contract looks valid numbers up in what was written, which nobody else sees yet.
    valid_parts = spark.read.parquet(paths["bronze.catalog_parts"])
    fitment = judge_fitment(raw_fitment, valid_parts, make_aliases(spark), as_of_year)
    paths |= wh.write_versions(
        {
            "bronze.catalog_fitment": fitment.valid.withColumn("_loaded_at", stamp),
            "quarantine.catalog_fitment": fitment.quarantined.withColumn("_run_id", run),
        }
    )
    metrics = parts.metrics.unionByName(fitment.metrics).withColumns({"run_id": run, "run_at": stamp})
    paths |= wh.write_versions({CATALOG_RUNS: metrics.coalesce(1)}, part=run_id)
    wh.commit(paths, part={CATALOG_RUNS: run_id})


def build_models(
    spark: SparkSession,
    wh: Warehouse,
    as_of_year: int,
    full_refresh: bool = False,
    drop_vanished: bool = False,
) -> dict[str, DataFrame]:
    """Rebuild every model in dependency order, make all current and return the frames."""
    m, paths = write_models(spark, wh, as_of_year, full_refresh, drop_vanished)
    wh.commit(paths)
    return m


def rules_text() -> str:
    """All rules and reference lists as one comparable text."""
    rules = {k: sorted(map(repr, v)) if isinstance(v, set | frozenset) else repr(v) for k, v in vars(reference).items() if k.isupper()}
    return json.dumps(rules, sort_keys=True)


def delivery_state(spark: SparkSession, paths: Sequence[str], *parameters: object) -> tuple[int, str]:
    """Number of lines and a fingerprint of files, rules and parameters.

    A line counts with its place, since of repeated part numbers the first one stays. Places depend
    on how Spark splits files, so another session may see a change where there is none; never the
    other way round.
    """

    def look(path: str) -> Row:
        place = F.struct("_metadata.file_block_start", F.monotonically_increasing_id())
        lines = read_lines(spark, path).select("value", place.alias("place"))
        return content_fingerprint(lines, ("value", "place")).first()

    with ThreadPoolExecutor(max_workers=WRITERS) as pool:
        found = list(pool.map(look, paths))
    state = json.dumps([[f.fingerprint for f in found], rules_text(), *parameters], default=str)
    return sum(int(f.rows_seen) for f in found), hashlib.sha256(state.encode()).hexdigest()


def load_if_changed(
    spark: SparkSession, wh: Warehouse, source: str, paths: Sequence[str], parameters: Sequence[object],
    tables: Sequence[str], load: Callable[[], None], force: bool,
) -> None:
    """Run `load` unless the manifest says that just this was loaded and its tables are there."""
    rows, state = delivery_state(spark, paths, *parameters)
    latest = wh.latest_loads()
    known = None if latest is None else latest.filter(F.col("source") == source).first()
    unchanged = not force and known is not None and known.sha256 == state and set(tables) <= set(wh.tables())
    if not unchanged:
        load()
    status = "unchanged" if unchanged else "loaded"
    wh.record_loads([(uuid.uuid4().hex[:12], source, ",".join(paths), None, None, state, rows, None, None, status, utc_now())])


def build_fingerprint(wh: Warehouse, as_of_year: int) -> str:
    """What models depend on: versions of bronze tables, parameters, rules and reference lists."""
    state = json.dumps([wh.versions("bronze"), as_of_year, rules_text()])
    return hashlib.sha256(state.encode()).hexdigest()


def write_models(
    spark: SparkSession,
    wh: Warehouse,
    as_of_year: int,
    full_refresh: bool = False,
    drop_vanished: bool = False,
    outcomes: dict[str, tuple[str, float, str]] | None = None,
) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Write every model as a version that is not current yet; returns frames and paths.

    `outcomes` takes (status, seconds, message) of each model.
    """
    staged: dict[str, str] = {}
    aliases, taxonomy, rules = make_aliases(spark), component_taxonomy(spark), model_rules(spark)
    bronze = {
        name: wh.read(f"bronze.{name}")
        for name in ("nhtsa_recalls", "nhtsa_complaints", "vpic_models", "catalog_parts", "catalog_fitment")
    }
    m: dict[str, DataFrame] = {"make_aliases": aliases, **bronze}

    def put(layer: str, **frames: DataFrame) -> None:
        paths = wh.write_versions({f"{layer}.{name}": df for name, df in frames.items()}, outcomes=outcomes)
        staged.update(paths)
        m.update({table.split(".", 1)[1]: spark.read.parquet(path) for table, path in paths.items()})

    def current(table: str) -> DataFrame | None:
        return None if full_refresh else wh.read_or_none(table)

    put(
        "staging",
        stg_recalls=staging.staged_recalls(bronze["nhtsa_recalls"], aliases),
        stg_complaints=staging.staged_complaints(bronze["nhtsa_complaints"], aliases),
        stg_reference=staging.staged_reference(bronze["vpic_models"]),
        stg_catalog_parts=staging.staged_parts(bronze["catalog_parts"]),
        stg_catalog_fitment=staging.staged_fitment(bronze["catalog_fitment"]),
    )
    recalls, complaints, years = m["stg_recalls"], m["stg_complaints"], m["stg_reference"]
    conformed_before = current("intermediate.int_model_conformance")
    put(
        "intermediate",
        int_model_conformance=intermediate.model_conformance(recalls, complaints, years, rules),
        int_fitment_exploded=intermediate.fitment_years(m["stg_catalog_fitment"]),
    )
    conformance, fitted = m["int_model_conformance"], m["int_fitment_exploded"]
    renamed = None if conformed_before is None else marts.renamed_models(conformed_before, conformance)
    put(
        "snapshots",
        snap_catalog_parts=marts.part_history(
            wh.read_or_none("snapshots.snap_catalog_parts"), bronze["catalog_parts"], F.lit(utc_now())
        ),
    )
    put(
        "intermediate",
        int_vehicles=intermediate.vehicle_universe(years, recalls, complaints, conformance, fitted),
    )
    put(
        "marts",
        dim_vehicle=marts.dim_vehicle(m["int_vehicles"], as_of_year),
        dim_component=marts.dim_component(recalls, complaints, taxonomy),
        dim_recall_campaign=marts.dim_recall_campaign(recalls),
        dim_part=marts.dim_part(m["snap_catalog_parts"]),
        fct_complaint=marts.fct_complaint(
            complaints, conformance, current("marts.fct_complaint"), renamed, drop_vanished
        ),
        fct_complaint_component=marts.fct_complaint_component(
            complaints, current("marts.fct_complaint_component"), drop_vanished
        ),
        fct_recall_vehicle_component=marts.fct_recall_vehicle_component(recalls, conformance),
    )
    put("marts", fct_part_fitment=marts.fct_part_fitment(fitted, m["dim_part"], m["dim_vehicle"]))
    put(
        "marts",
        mart_coverage_gap=marts.mart_coverage_gap(
            m["fct_complaint"],
            m["fct_complaint_component"],
            m["fct_recall_vehicle_component"],
            m["dim_component"],
            m["dim_vehicle"],
            m["fct_part_fitment"],
            m["dim_part"],
        ),
        mart_component_trends=marts.mart_component_trends(
            m["fct_complaint"],
            m["fct_complaint_component"],
            m["fct_recall_vehicle_component"],
            m["dim_component"],
            m["dim_vehicle"],
        ),
        mart_data_conformance=marts.mart_data_conformance(
            recalls, complaints, years, conformance, fitted, m["int_vehicles"]
        ),
    )
    return m, staged


def record_models(wh: Warehouse, outcomes: Mapping[str, tuple[str, float, str]], invocation: str) -> None:
    """Append one row per written model and snapshot, with its time, to the log of the build (DQ-16)."""
    now = utc_now()
    rows = [
        (invocation, "build", table, "snapshot" if table.startswith("snapshots.") else "model", status, None, message, now, seconds)
        for table, (status, seconds, message) in sorted(outcomes.items())
    ]
    if rows:
        wh.append("meta.test_results", wh.spark.createDataFrame(rows, RESULT_SCHEMA).coalesce(1))


def check_models(wh: Warehouse, m: Mapping[str, DataFrame], as_of_year: int, invocation: str) -> DataFrame:
    """Run the suite once, append its outcome to the log of the build and return the build's rows."""
    now = utc_now()
    results = run_checks(m, warehouse_tests(m, as_of_year)).select(
        F.lit(invocation).alias("invocation_id"),
        F.lit("build").alias("command"),
        F.col("test").alias("unique_id"),
        F.lit("test").alias("resource_type"),
        "status",
        "failures",
        F.lit("").alias("message"),
        F.lit(now).alias("recorded_at"),
        F.lit(None).cast("double").alias("seconds"),
    )
    wh.append("meta.test_results", results.coalesce(1))
    return wh.log("meta.test_results", RESULT_SCHEMA).filter(F.col("invocation_id") == invocation)


def require_passed(results: DataFrame) -> None:
    """Raise if a test of error severity failed; the log has at most one row per test."""
    failed = sorted(r.unique_id for r in results.filter("status in ('fail', 'error')").select("unique_id").collect())
    if failed:
        raise DataTestError(f"{len(failed)} data tests failed: {', '.join(failed)}")


class _Stages:
    """Times each stage and appends one row per stage to the run log (SRC-16)."""

    def __init__(self, spark: SparkSession, wh: Warehouse):
        self.spark, self.wh, self.run_id = spark, wh, uuid.uuid4().hex[:12]

    def __call__(self, stage: str, work: Callable[[], object]) -> object:
        started, status, message = time.monotonic(), "success", ""
        try:
            return work()
        except Exception as err:
            status, message = "failed", str(err)
            raise
        finally:
            row = (self.run_id, stage, status, round(time.monotonic() - started, 3), message, utc_now())
            frame = self.spark.createDataFrame([row], RUN_SCHEMA).coalesce(1)
            self.wh.append("meta.pipeline_runs", frame)


def refresh(
    spark: SparkSession,
    wh: Warehouse,
    inputs: Inputs,
    full_refresh: bool = False,
    skip_unchanged: bool = True,
    run_tests: bool = True,
    drop_vanished: bool = False,
) -> list[LandingResult]:
    """Land what is given, rebuild and test. Returns the landing outcome per flat file.

    Models are rebuilt whenever the landed versions, the parameters or the reference lists differ
    from those of the last build, so a run that failed on the way is made up for by the next one; a
    build without tests does not count where tests are asked for. Models become current together,
    after their tests.
    """
    inputs.check()
    stage = _Stages(spark, wh)
    landed = stage("land", lambda: land(spark, wh, inputs, force=full_refresh))
    if inputs.reference_years and inputs.reference_types:
        documents = [inputs.reference_years, inputs.reference_types]

        def reference_stage() -> None:
            load_if_changed(
                spark, wh, "reference", documents, [], ["bronze.vpic_models"],
                lambda: load_reference(spark, wh, inputs), full_refresh,
            )

        stage("reference", reference_stage)
    if inputs.parts_feed and inputs.fitment_feed:
        supplied = [inputs.parts_feed, inputs.fitment_feed]

        def publish() -> None:
            raw_parts = read_feed(spark, inputs.parts_feed, PART_FEED_COLUMNS)
            raw_fitment = read_feed(spark, inputs.fitment_feed, FITMENT_FEED_COLUMNS)
            publish_catalog(spark, wh, raw_parts, raw_fitment, inputs.as_of_year)

        def catalog_stage() -> None:
            held = ["bronze.catalog_parts", "bronze.catalog_fitment"]
            load_if_changed(spark, wh, "catalog", supplied, [inputs.as_of_year], held, publish, full_refresh)

        stage("catalog", catalog_stage)
    fingerprint = build_fingerprint(wh, inputs.as_of_year)
    if skip_unchanged and not full_refresh and wh.is_built(fingerprint, tested=run_tests):
        return landed
    outcomes: dict[str, tuple[str, float, str]] = {}
    try:
        m, paths = stage("models", lambda: write_models(spark, wh, inputs.as_of_year, full_refresh, drop_vanished, outcomes))
    finally:
        record_models(wh, outcomes, stage.run_id)
    if run_tests:
        stage("tests", lambda: require_passed(check_models(wh, m, inputs.as_of_year, stage.run_id)))
    wh.commit(paths)
    wh.record_build(fingerprint, tested=run_tests)
    return landed
